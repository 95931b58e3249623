"""Shared helpers of the training-data operators."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from weakref import WeakKeyDictionary

import pyarrow as pa
import pyarrow.compute
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Documents handled at once inside a Python worker; bounds its memory whatever Arrow batch arrives.
ROWS_AT_ONCE = 512
#: Characters handled at once inside a Python worker, one longer document excepted.
CHARS_AT_ONCE = 4_000_000

#: Upper-case ASCII to lower case, on bytes.
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
#: Additionally all ASCII bytes that are neither digits nor letters become spaces, so that bytes.split() yields alphanumeric words.
ALNUM_LOWER = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in LOWER)


def utf8(text: str | None) -> bytes:
    """UTF-8 of a text; null counts as empty."""
    return (text or "").encode("utf-8", "replace")


def space_words(text: str | None) -> list[bytes]:
    """Words [^\\x20\\x09-\\x0D]+ as UTF-8 (bytes.split() splits on exactly these six characters)."""
    return utf8(text).split()


def alnum_words(text: str | None) -> list[bytes]:
    """Lower-cased words [^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+ as UTF-8."""
    return utf8(text).translate(ALNUM_LOWER).split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share; one of its own only in local mode, where there is one machine."""
    context = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not found:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="foliant-checkpoints-"))
        found = context.getCheckpointDir()
    return found.rstrip("/")


@contextmanager
def batches_of(spark: SparkSession, rows: int) -> Iterator[None]:
    """Bounds the rows of Arrow batches in what is computed meanwhile, for wide rows; 0 leaves them as they are."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    try:
        if rows:
            spark.conf.set(key, str(rows))
        yield
    finally:
        spark.conf.set(key, before)


def written(df: DataFrame, name: str, parts: int = 0) -> DataFrame:
    """Cut the lineage: write to the shared folder and read back, so that lost executors cost no recomputation.

    `parts` bounds the number of files, for tables known to be small.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    (df.coalesce(parts) if parts else df).write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    _FOLDERS[out] = path
    return out


#: Folders of the tables that `written` returned.
_FOLDERS: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def discard(*tables: DataFrame) -> None:
    """Delete tables that `written` returned and that no frame needs any more."""
    for df in tables:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(_FOLDERS.pop(df))
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


class Held:
    """Frames held on the executors' disks while they are used more than once.

    What a lost executor held is computed again, from the tables that were written before.
    """

    def __init__(self) -> None:
        self.frames: list[DataFrame] = []

    def __call__(self, df: DataFrame) -> DataFrame:
        self.frames.append(df.persist(StorageLevel.DISK_ONLY))
        return self.frames[-1]

    def release(self) -> None:
        while self.frames:
            self.frames.pop().unpersist()


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, lengthened until df has no such column."""
    taken = {c.lower() for c in df.columns}
    return [next(n for n in (name + "_" * k for k in range(len(taken) + 1)) if n.lower() not in taken) for name in names]


def slices(batch: pa.RecordBatch, text: str = "text", rows: int = ROWS_AT_ONCE) -> Iterator[pa.RecordBatch]:
    """Cut an Arrow batch into pieces of bounded rows and characters."""
    sizes = pa.compute.binary_length(batch.column(batch.schema.get_field_index(text))).to_pylist()
    start = total = 0
    for i, n in enumerate(sizes):
        if i > start and (i - start >= rows or total + (n or 0) > CHARS_AT_ONCE):
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += n or 0
    if start < len(sizes):
        yield batch.slice(start)


def arrow_schema(ddl: str) -> pa.Schema:
    """Arrow schema of a DDL string (needs a session, so not inside a worker)."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(ddl))


def map_rows(df: DataFrame, schema: str, fn: Callable[[pa.RecordBatch], dict], text: str = "text") -> DataFrame:
    """mapInArrow over slices; fn returns the columns of its output by name."""
    out = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text):
                columns = fn(part)
                yield pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in out], schema=out)

    return df.mapInArrow(run, schema)


def extend(df: DataFrame, schema: str, fn: Callable[[pa.RecordBatch], dict], text: str = "text", drop: tuple[str, ...] = (), rows: int = ROWS_AT_ONCE) -> DataFrame:
    """Keep the columns of df and add those of `schema`; where names clash, the new column takes the old one's place."""
    from pyspark.sql.types import StructType

    added = StructType.fromDDL(schema)
    old = [f for f in df.schema if f.name not in set(added.names) | set(drop)]
    out = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text, rows):
                columns = fn(part)
                kept = [part.column(part.schema.get_field_index(f.name)) for f in old]
                yield pa.RecordBatch.from_arrays([*kept, *(pa.array(columns[f.name], f.type) for f in out)], names=[*(f.name for f in old), *out.names])

    return df.mapInArrow(run, StructType([*old, *added]))


def ends(items: Iterator) -> Iterator[tuple[object, bool]]:
    """Each item, and whether it is the last; holds one item in advance."""
    items = iter(items)
    for held in items:
        for item in items:
            yield held, False
            held = item
        yield held, True


def column(batch: pa.RecordBatch, name: str) -> list:
    return batch.column(batch.schema.get_field_index(name)).to_pylist()


def crc_mod(column: str, n: int):
    """crc32 of a number's text modulo n, null for null."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % n
