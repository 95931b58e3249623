"""Paper lists, acquisition and page sources."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..functions.text import strip, strip_version

#: Fixed value: where a paper's document is by default.
DOCUMENT_URL = "https://arxiv.org/pdf/"


def parse_lines(lines: DataFrame) -> DataFrame:
    """Paper rows from (paper_ord, line): blank lines go, the rest keep their order. full_id is the line as it stands."""
    line = strip(F.col("line"))
    paper = F.when(line.startswith("arXiv:"), F.substring(line, 7, 1_000_000)).otherwise(line)
    return lines.where(F.length(line) > 0).select(
        "paper_ord",
        paper.alias("arxiv_id"),
        line.alias("full_id"),
        F.concat(F.lit(DOCUMENT_URL), paper, F.lit(".pdf")).alias("pdf_url"),
        F.lit("not_visited").alias("status"),
        F.lit(None).cast("int").alias("image_count"),
        F.lit(None).cast("string").alias("error_message"),
    )


def read_papers(spark: SparkSession, path: str) -> DataFrame:
    """A text file of papers, one a line, in order. A path that isn't there raises Spark's error."""
    return parse_lines(number_lines(spark, path))


class PaperListSource(DataSource):
    """`paperlist`: (paper_ord, line) of a local text file, as a registered format.

    For `spark.read.format("paperlist").load(path)`; `read_papers` reads from any store.
    """

    @classmethod
    def name(cls) -> str:
        return "paperlist"

    def schema(self) -> str:
        return "paper_ord bigint, line string"

    def reader(self, schema) -> DataSourceReader:
        return _PaperListReader(self.options["path"])


class _PaperListReader(DataSourceReader):
    def __init__(self, path: str) -> None:
        self.path = path.removeprefix("file://")

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(0)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        with open(self.path, encoding="utf-8") as f:
            for i, line in enumerate(f):
                yield i, line.rstrip("\n")


def number_lines(spark: SparkSession, path: str) -> DataFrame:
    """The same from any store: the file is read whole and split, so that its order is sure."""
    return spark.read.text(path, wholetext=True).select(F.posexplode(F.split("value", "\n"))).select(F.col("pos").cast("long").alias("paper_ord"), F.col("col").alias("line"))


# -- acquisition


def metadata_url(atom: DataFrame) -> DataFrame:
    """Document links from Atom answers (arxiv_id, body): the link titled pdf, else one made from the entry's id, else null."""
    entry = F.regexp_extract("body", r"(?s)<entry>.*?</entry>", 0)
    link = F.regexp_extract(F.regexp_extract(entry, r'<link\b[^>]*\btitle="pdf"[^>]*>', 0), r'\bhref="([^"]+)"', 1)
    own = strip_version(F.regexp_extract(entry, r"<id>[^<]*/abs/([^<]+)</id>", 1))
    url = F.when(link != "", link).when(own != "", F.concat(F.lit(DOCUMENT_URL), own, F.lit(".pdf")))
    return atom.withColumn("url", url)


def next_action(http_status, content_type, attempt, retries: int = 3):
    """What follows an answer: done, failed (404, or no attempts left), retry at once (other answer or type), back_off (no answer)."""
    last = attempt >= retries
    return (
        F.when(http_status.isNull() & last, "failed")
        .when(http_status.isNull(), "back_off")
        .when(http_status == 404, "failed")
        .when((http_status == 200) & F.lower(F.coalesce(content_type, F.lit(""))).contains("pdf"), "done")
        .when(last, "failed")
        .otherwise("retry")
    )


def back_off(attempt: int, delay: float = 3.0) -> float:
    return delay * 2**attempt


class RateLimit:
    """At least `delay` seconds between calls; the clock and sleep can be given for tests."""

    def __init__(self, delay: float = 3.0, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep) -> None:
        self.delay, self.clock, self.sleep, self.last = delay, clock, sleep, None

    def wait(self) -> None:
        now = self.clock()
        if self.last is not None and now - self.last < self.delay:
            self.sleep(self.delay - (now - self.last))
        self.last = self.clock()


def download(papers: DataFrame, fetch: Callable[[str], tuple[int, str, bytes]], delay: float = 3.0, retries: int = 3, cached: DataFrame | None = None) -> DataFrame:
    """Documents of papers: arxiv_id, status, content, error_message. `fetch(url)` gives status, content type and bytes, or raises.

    One task asks, at the rate allowed; papers in `cached` (arxiv_id, content) aren't asked for.
    A 404 fails at once, other answers are retried at once, exceptions after a growing pause.
    """
    todo = papers if cached is None else papers.join(cached.select("arxiv_id"), "arxiv_id", "left_anti")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        limit = RateLimit(delay)
        for pdf in frames:
            rows = []
            for paper, url in zip(pdf["arxiv_id"], pdf["pdf_url"], strict=True):
                content, error = None, None
                for attempt in range(retries):
                    limit.wait()
                    try:
                        status, kind, body = fetch(url)
                    except Exception as e:  # noqa: BLE001 - any failure of a fetch counts as one
                        error = str(e)
                        if attempt + 1 < retries:
                            time.sleep(back_off(attempt, delay))
                        continue
                    if status == 404:
                        error = "not found"
                        break
                    if status == 200 and "pdf" in (kind or "").lower():
                        content, error = body, None
                        break
                    error = f"status {status}, {kind}"
                rows.append((paper, "failed" if content is None else "processed", content, error))
            yield pd.DataFrame(rows, columns=["arxiv_id", "status", "content", "error_message"])

    got = todo.select("arxiv_id", "pdf_url").coalesce(1).mapInPandas(run, "arxiv_id string, status string, content binary, error_message string")
    if cached is None:
        return got
    known = papers.select("arxiv_id").join(cached, "arxiv_id").select("arxiv_id", F.lit("processed").alias("status"), "content", F.lit(None).cast("string").alias("error_message"))
    return known.unionByName(got)


# -- documents


def read_binary(spark: SparkSession, path: str, pattern: str = "*.pdf") -> DataFrame:
    """Documents or images as (arxiv_id, content); the id is the file's name without its ending."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path)
    return files.select(F.regexp_extract("path", r"([^/]+)\.[^./]+$", 1).alias("arxiv_id"), "path", "content")


def parse_pages(documents: DataFrame, parse: Callable[[bytes], list[str]]) -> DataFrame:
    """Page texts from documents with an injected parser; a document that can't be parsed yields one row with an error."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            rows = []
            for paper, content in zip(pdf["arxiv_id"], pdf["content"], strict=True):
                try:
                    rows += [(paper, i + 1, t, None) for i, t in enumerate(parse(content))]
                except Exception as e:  # noqa: BLE001 - one bad document must not end the job
                    rows.append((paper, None, None, str(e)))
            out = pd.DataFrame(rows, columns=["arxiv_id", "page", "text", "error"])
            yield out.astype({"page": "Int32"})

    return documents.select("arxiv_id", "content").mapInPandas(run, "arxiv_id string, page int, text string, error string")


def text_blocks(spans: DataFrame) -> DataFrame:
    """Text blocks from (arxiv_id, page, block, line, span, kind, text): kind 0 only; spans joined, lines broken, ends stripped."""
    lines = spans.where("kind = 0").groupBy("arxiv_id", "page", "block", "line").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("span", "text"))), lambda s: s["text"]), "").alias("text"))
    blocks = lines.groupBy("arxiv_id", "page", "block").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line", "text"))), lambda s: s["text"]), "\n").alias("text"))
    return blocks.select("arxiv_id", "page", "block", strip(F.col("text")).alias("text"))


def labelled_images(spark: SparkSession, path: str) -> DataFrame:
    """Training images with the name of their folder as label, and the label's rank by alphabet."""
    rows = read_binary(spark, path, "*.{png,jpg,jpeg}").withColumn("label", F.regexp_extract("path", r"([^/]+)/[^/]+$", 1))
    classes = rows.select("label").distinct().withColumn("one", F.lit(1))
    ranks = classes.groupBy("one").agg(F.array_sort(F.collect_list("label")).alias("all")).select(F.posexplode("all").alias("target", "label"))
    return rows.join(ranks, "label")
