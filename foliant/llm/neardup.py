"""MinHash near-duplicates: banded minima, signature verification, exact confirmation, components.

1. Every text becomes the set of its hashed word shingles, a fingerprint of the set and a
   signature of universal-hash minima. Texts of equal sets are one node from here on.
2. Bands of the signature are bucketed by a sort over ranges of (bucket, node), so that a large bucket
   spreads over tasks; buckets of one node fall away as they stream by.
3. Each bucket is cut into blocks. A block's minima, place by place the most frequent ones, are its consensus;
   the node nearest to it stands for the block, and every node is compared with that one alone. Where a
   bucket has several blocks, the nodes that stand for them are a bucket of their own, and so on. Pairs whose
   signatures agree often enough are confirmed on their full sets. All this is linear in a bucket's nodes.
4. Links are joined by alternating large-star and small-star.
5. Buckets that still hold different components get their nodes' full sets, and every pair of
   nodes of different components whose signatures agree often enough is confirmed right there: the nodes outside a
   bucket's largest component against all others. Only links that join components come out. So a group of thousands
   of near copies yields few rows, yet no pair that could join two components goes untested.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER, arrow_schema, batches_of, column, discard, fresh, map_rows, utf8, written

#: Minima in a signature.
HASHES = 252
#: Chance, at most, that a pair just similar enough shares no band.
MISS = 1e-6
#: Standard deviations below the threshold at which estimates still lead to a confirmation.
SLACK = 4.9
#: Nodes of a bucket for which one node stands.
BLOCK = 2048
#: Nodes, and shingles in their sets, of either side in a group where all pairs across components are tested.
SET_BLOCK, SET_ITEMS = 512, 4_000_000
#: Tasks over which the nodes of a large bucket spread where it is joined.
SALTS = 16
#: Rows of narrow tables in a file; of signatures; of sets; of pairs that are still to be made or confirmed.
EDGES, SIGNS_A_FILE, SETS_A_FILE, PAIRS_A_FILE = 500_000, 25_000, 5_000, 20_000
#: Rows of an Arrow batch where they hold texts, signatures or sets.
WIDE = 1000


@dataclass(frozen=True)
class Similarity:
    """Shingles of `words` words; linked from `part` / `whole` Jaccard similarity."""

    words: int = 5
    part: int = 80
    whole: int = 100

    @property
    def threshold(self) -> float:
        return self.part / self.whole

    @property
    def rows(self) -> int:
        """Minima in a band: as many as keep the chance of a miss within MISS."""
        return max(r for r in range(1, 16) if r == 1 or (1 - self.threshold**r) ** (HASHES // r) <= MISS)

    @property
    def least(self) -> float:
        t = self.threshold
        return t - SLACK * (t * (1 - t) / HASHES) ** 0.5

    def linked(self, inter: int, union: int) -> bool:
        return self.whole * inter >= self.part * union


def _hash_family() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.Generator(np.random.PCG64(20240229))
    return rng.integers(0, 2**63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1), rng.integers(0, 2**63, HASHES, dtype=np.uint64)


_A, _B = _hash_family()
_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]


def shingles(text: str | None, n: int, known: dict[bytes, int]) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's n-word shingles; of its whole sequence if it has fewer words."""
    hashes = []
    for w in utf8(text).translate(LOWER).split():
        h = known.get(w)
        if h is None:
            h = known[w] = xxhash.xxh3_64_intdigest(w)
        hashes.append(h)
    if not hashes:
        return np.zeros(0, np.uint64)
    x = np.array(hashes, np.uint64)
    size = min(n, len(x))
    out = np.full(len(x) - size + 1, size, np.uint64)
    for k in range(size):
        out = (out ^ (x[k : k + len(out)] * _MIX[0])) * _MIX[1]
        out ^= out >> np.uint64(31)
    return np.unique((out * _MIX[2]) ^ (out >> np.uint64(29)))


def signature(items: np.ndarray) -> np.ndarray:
    """16 bits of each minimum of (a x + b) mod 2^64 >> 32 over the set."""
    best = np.full(HASHES, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(items), 512):
        part = items[at : at + 512]
        np.minimum(best, (_A[:, None] * part[None, :] + _B[:, None]).min(1), out=best)
    low = best >> np.uint64(32)
    return ((low ^ (low >> np.uint64(16))) & np.uint64(0xFFFF)).astype("<u2")


def _band_keys(sig: np.ndarray, rows: int) -> list[int]:
    n = HASHES // rows
    return [xxhash.xxh3_64_intdigest(sig[b * rows : (b + 1) * rows].tobytes(), seed=b) - (1 << 63) for b in range(n)]


def signed(docs: DataFrame, similarity: Similarity, text: str = "text") -> DataFrame:
    """One row per document: doc_id, key, n_shingles, fp (null if empty), sig, bands. key is a hash of id and text."""

    def run(batch) -> dict:
        out: dict = {"n_shingles": [], "fp": [], "sig": [], "bands": []}
        known: dict[bytes, int] = {}
        for t in column(batch, "text"):
            s = shingles(t, similarity.words, known)
            sig = signature(s) if len(s) else None
            out["n_shingles"].append(len(s))
            out["fp"].append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
            out["sig"].append(sig.tobytes() if len(s) else None)
            out["bands"].append(_band_keys(sig, similarity.rows) if len(s) else None)
        return out | {"doc_id": batch.column(0), "key": batch.column(1)}

    rows = docs.select("doc_id", F.xxhash64("doc_id", text).alias("key"), F.col(text).alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_rows(rows, f"doc_id {kind}, key long, n_shingles long, fp binary, sig binary, bands array<long>", run)


def _shared_buckets(bands: DataFrame, by_range: bool) -> DataFrame:
    """(bucket, band, node, block, cut) of buckets with two nodes or more; a block is BLOCK nodes of one task.

    By range, a bucket may run over several tasks; then its rows are marked as cut. Tasks say which
    buckets they begin and end with, two rows a task.
    """
    names = ["bucket", "band", "node", "block", "edge"]
    size = BLOCK

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId() << 32
        held: tuple[int, int, int, int] | None = None  # the last row, its number in its bucket
        paired = False  # whether the held row has a neighbour before it
        first = None  # the task's first bucket

        def rows(*columns: np.ndarray, edge: bool = False) -> pa.RecordBatch:
            b, d, i, n = (np.asarray(c, np.int64) for c in columns)
            return pa.RecordBatch.from_arrays([*(pa.array(x, pa.int64()) for x in (b, d, i, task + n // size)), pa.array([edge] * len(b), pa.bool_())], names)

        for batch in batches:
            b, d, i = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(3))
            if not len(b):
                continue
            first = int(b[0]) if first is None else first
            if held is not None:
                b, d, i = (np.concatenate([[h], x]) for h, x in zip(held, (b, d, i), strict=False))
            new = np.append(True, (b[1:] != b[:-1]) | (i[1:] != i[:-1]))
            b, d, i = b[new], d[new], i[new]
            before = np.append(False, b[1:] == b[:-1])
            starts = np.flatnonzero(~before)
            n = np.arange(len(b)) - np.repeat(starts, np.diff(np.append(starts, len(b))))
            if held is not None:
                before[0] = paired
                n[: starts[1] if len(starts) > 1 else len(b)] += held[3]
            # rows of the first bucket stay even if alone: the task before may have more of it
            keep = before | np.append(before[1:] & (b[1:] == b[:-1]), False) | (b == first)
            held, paired = (b[-1], d[-1], i[-1], int(n[-1])), bool(before[-1])
            keep[-1] = False
            yield rows(*(x[keep] for x in (b, d, i, n)))
        if held is not None:
            yield rows(*([x] for x in held))
            yield rows(*zip(*((x, 0, 0, 0) for x in {first, int(held[0])}), strict=True), edge=True)

    dealt = bands.repartitionByRange("bucket", "node") if by_range else bands.repartition("bucket")
    return dealt.sortWithinPartitions("bucket", "node").mapInArrow(run, "bucket long, band long, node long, block long, edge boolean")


def _members(bands: DataFrame, by_range: bool, parts: int) -> DataFrame:
    """(bucket, band, node, block, cut) of buckets with two nodes or more, and of at most two with one a task."""
    found = written(_shared_buckets(bands, by_range), "neardup-buckets", parts)
    edges = F.broadcast(found.where("edge").groupBy("bucket").count().where("count > 1").select("bucket", F.lit(True).alias("cut")))  # two rows a task at most
    return found.where("not edge").join(edges, "bucket", "left").select("bucket", "band", "node", "block", F.coalesce("cut", F.lit(False)).alias("cut"))


def _by_block(members: DataFrame, signatures: DataFrame) -> DataFrame:
    """Members with their signatures, in groups of a block each, as `_groups` reads them."""
    rows = members.join(signatures, "node").select("bucket", F.col("block").alias("lo"), F.lit(0).cast("long").alias("hi"), F.col("cut").cast("long").alias("own"), "band", "node", "sig")
    return rows.repartition("bucket", "lo").sortWithinPartitions("bucket", "lo", "hi", "node")


def _near(blocks: DataFrame, similarity: Similarity) -> DataFrame:
    """(bucket, band, a, b): each block's central node a with the nodes b whose signatures agree with its often enough; and (bucket, band, a, null) where a bucket may have more blocks."""
    least, size = int(np.ceil(similarity.least * HASHES)), BLOCK
    schema = "bucket long, band long, a long, b long"
    out = arrow_schema(schema)

    def central(sigs: np.ndarray) -> int:
        """The signature nearest to the most frequent minima."""
        if len(sigs) < 3:
            return 0
        ordered = np.sort(sigs, 0)
        runs = np.zeros(ordered.shape, np.int32)
        for i in range(1, len(ordered)):  # how often a minimum came before, place by place
            runs[i] = (runs[i - 1] + 1) * (ordered[i] == ordered[i - 1])
        mode = ordered[runs.argmax(0), np.arange(HASHES)]
        return int((sigs == mode).sum(1).argmax())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[tuple] = []
        for g in _each_group(batches, 1):
            m = central(g.sigs)
            near = np.flatnonzero(g.agreements(m, np.arange(len(g.nodes))) >= least)
            a = int(g.nodes[m])
            found += [(g.bucket, g.band, a, b) for b in g.nodes[near].tolist() if b != a]
            if g.own[0] or len(g.nodes) >= size or g.lo & 0xFFFFFFFF:
                found.append((g.bucket, g.band, a, None))
            if len(found) > 50_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found, strict=True)], schema=out)
                found = []
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found, strict=True)], schema=out)

    return blocks.mapInArrow(run, schema)


def _candidates(members: DataFrame, signatures: DataFrame, similarity: Similarity) -> DataFrame:
    """(a, b) to confirm, once each, written: nodes and the central node of their block; of the blocks' central nodes likewise."""
    found, level = [], members
    while True:
        m = level.count()
        found.append(written(_near(_by_block(level, signatures), similarity), "neardup-near", m // PAIRS_A_FILE + 1))
        # central nodes of blocks: a node for BLOCK nodes, and two a task
        above = found[-1].where("b is null").select("bucket", "band", F.col("a").alias("node")).distinct()
        shared = above.groupBy("bucket").count().where("count > 1").select("bucket")
        above = written(above.join(shared, "bucket", "left_semi"), "neardup-central", m // EDGES + 1)
        if above.isEmpty():
            break
        level = _members(above, False, m // EDGES + 1)
    pairs = reduce(DataFrame.unionByName, (f.where("b is not null").select(F.least("a", "b").alias("x"), F.greatest("a", "b").alias("y"), "a") for f in found))
    # a pair may come from both its nodes; either may stand for the block
    pairs = pairs.groupBy("x", "y").agg(F.min("a").alias("a")).select("a", F.when(F.col("a") == F.col("x"), F.col("y")).otherwise(F.col("x")).alias("b"))
    out = written(pairs, "neardup-pairs", members.count() // PAIRS_A_FILE + 1)
    discard(*found)
    return out


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Tables of whole groups of equal (bucket, lo, hi), many at a time."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(3)]
        first = tuple(k[0] for k in keys)
        last = tuple(k[-1] for k in keys)
        if held and tuple(held[-1].column(k)[-1].as_py() for k in range(3)) != first:
            yield pa.Table.from_batches(held)
            held = []
        if first == last:
            held.append(batch)
            continue
        edge = int(np.flatnonzero((keys[0] != last[0]) | (keys[1] != last[1]) | (keys[2] != last[2]))[-1]) + 1
        yield pa.Table.from_batches([*held, batch.slice(0, edge)])
        held = [batch.slice(edge)]
    if held:
        yield pa.Table.from_batches(held)


@dataclass
class _Group:
    """One group: its nodes, their signatures, and which earlier nodes a node is to be compared with."""

    table: pa.Table
    sigs: np.ndarray
    nodes: np.ndarray
    own: np.ndarray
    across: bool
    bucket: int
    lo: int
    band: int

    def agreements(self, i: int, at: np.ndarray) -> np.ndarray:
        return (self.sigs[at] == self.sigs[i]).sum(1)

    def before(self, i: int) -> np.ndarray:
        """Nodes before i; in a group of two blocks, those of the other block."""
        return np.flatnonzero(self.own[:i] != self.own[i]) if self.across else np.arange(i)


def _each_group(batches: Iterator[pa.RecordBatch], least: int = 2) -> Iterator[_Group]:
    for t in _groups(batches):
        bucket, lo, hi, own, band, node = (t.column(k).to_numpy() for k in range(6))
        edges = np.flatnonzero(np.append(True, (bucket[1:] != bucket[:-1]) | (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1]))).tolist()
        sigs = np.frombuffer(b"".join(t.column("sig").to_pylist()), "<u2").reshape(len(node), HASHES)
        for x, y in zip(edges, [*edges[1:], len(node)], strict=True):
            if y - x >= least:
                yield _Group(t.slice(x, y - x), sigs[x:y], node[x:y], own[x:y], bool(lo[x] != hi[x]), int(bucket[x]), int(lo[x]), int(band[x]))


def _pairs(found: list[tuple[int, int]]) -> pa.RecordBatch:
    a, b = (np.array([p[k] for p in found], np.int64) for k in (0, 1))
    return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])


def _with_bucket(rows: DataFrame, of_bucket: DataFrame, how: str = "inner") -> DataFrame:
    """Rows of nodes joined with what there is for their buckets; the nodes of a large bucket spread over SALTS tasks."""
    salts = F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))
    spread = of_bucket.withColumn("salt", F.explode(salts))
    return rows.withColumn("salt", F.pmod(F.xxhash64("node"), F.lit(SALTS))).join(spread, ["bucket", "salt"], how).drop("salt")


def _dealt(placed: DataFrame, signatures: DataFrame, sets: DataFrame) -> DataFrame:
    """Nodes of buckets that hold several components, with their signatures and sets, dealt out to groups.

    A bucket's largest component is one side, all other nodes the other. Both are cut into blocks of bounded
    nodes and shingles, by a hash; the other side's blocks meet all blocks, those of the largest component
    meet no block of their own side. Small buckets are one group.
    """
    rows = placed.join(sets.select("node", (F.octet_length("items") / 8).alias("size")), "node")
    sums = rows.groupBy("bucket", "component").agg(F.count("*").alias("n"), F.sum("size").alias("s"))
    of_bucket = sums.groupBy("bucket").agg(F.max_by("component", F.struct("n", "component")).alias("main"), F.sum("n").alias("n_all"), F.sum("s").alias("s_all"), F.max_by("n", F.struct("n", "component")).alias("n_main"), F.max_by("s", F.struct("n", "component")).alias("s_main"))
    blocks = lambda n, size: F.greatest(F.ceil(n / SET_BLOCK), F.ceil(size / SET_ITEMS), F.lit(1))
    n, s = F.col("n_all"), F.col("s_all")
    of_bucket = of_bucket.select(
        "bucket", "main", ((n <= SET_BLOCK) & (s <= SET_ITEMS)).alias("one"),
        blocks(F.col("n_main"), F.col("s_main")).alias("mains"), blocks(n - F.col("n_main"), s - F.col("s_main")).alias("others"),
    )
    inside = F.col("component") == F.col("main")
    number = lambda k: F.pmod(F.xxhash64("node", "bucket"), F.col(k))
    own = F.when(F.col("one"), F.lit(0)).when(inside, F.col("others") + number("mains")).otherwise(number("others"))
    last = F.when(F.col("one"), F.lit(0)).when(inside, F.col("others") - 1).otherwise(F.col("others") + F.col("mains") - 1)
    dealt = _with_bucket(rows, of_bucket).withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), last.cast("long"))))
    dealt = dealt.select("bucket", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "own", "band", "node", "component")
    dealt = dealt.join(signatures.join(sets, "node"), "node").select("bucket", "lo", "hi", "own", "band", "node", "component", "sig", "items")
    return dealt.repartition("bucket", "lo", "hi").sortWithinPartitions("bucket", "lo", "hi", "node")


def _bridges(groups: DataFrame, similarity: Similarity) -> DataFrame:
    """Links a < b between different components, confirmed on full sets; enough of them to join all that a group's links join.

    A pair is tested in the first band that it shares, unless other links of the group have
    joined its components before.
    """
    least, rows = int(np.ceil(similarity.least * HASHES)), similarity.rows
    used = HASHES // rows * rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[tuple[int, int]] = []
        for g in _each_group(batches):
            comp = g.table.column("component").to_numpy()
            if (comp == comp[0]).all():
                continue
            items = [np.frombuffer(x.as_buffer(), np.uint64) for x in g.table.column("items")]
            _, group = np.unique(comp, return_inverse=True)
            for i in range(1, len(g.nodes)):
                at = g.before(i)
                at = at[group[at] != group[i]]
                if not len(at):
                    continue
                agree = g.agreements(i, at)
                at, agree = at[agree >= least], agree[agree >= least]
                if not len(at):
                    continue
                same = (g.sigs[at, :used] == g.sigs[i, :used]).reshape(len(at), -1, rows).all(2)
                first = same.argmax(1) == g.band
                for j in at[first][np.argsort(-agree[first], kind="stable")].tolist():
                    if group[j] != group[i]:
                        inter = _shared(items[i], items[j])
                        if similarity.linked(inter, len(items[i]) + len(items[j]) - inter):
                            found.append((int(g.nodes[j]), int(g.nodes[i])))
                            group[group == group[j]] = group[i]
        yield _pairs(found)

    return groups.mapInArrow(run, "a long, b long").distinct()


def _shared(p: np.ndarray, q: np.ndarray) -> int:
    """Number of common items of two sorted sets."""
    if len(p) > len(q):
        p, q = q, p
    at = np.minimum(np.searchsorted(q, p), len(q) - 1)
    return int(np.count_nonzero(q[at] == p))


def _sets(docs: DataFrame, nodes: DataFrame, similarity: Similarity, text: str, parts: int) -> DataFrame:
    """(node, items) for distinct nodes, from their texts.

    Hashes of the nodes, 2^20 rows at most, are broadcast to drop other texts before the join.
    """
    nodes = written(nodes, "neardup-nodes", parts)
    short = F.pmod("node", F.lit(1 << 20)).cast("int").alias("short")
    rows = docs.select(F.xxhash64("doc_id", text).alias("node"), F.col(text).alias("text"))
    maybe = rows.withColumn("short", short).join(F.broadcast(nodes.select(short).distinct()), "short", "left_semi").drop("short")

    def run(batch) -> dict:
        known: dict[bytes, int] = {}
        return {"node": batch.column(0), "items": [shingles(t, similarity.words, known).tobytes() for t in column(batch, "text")]}

    sets = map_rows(maybe.join(nodes.hint("merge"), "node", "left_semi").dropDuplicates(["node"]), "node long, items binary", run)
    out = written(sets, "neardup-sets", nodes.count() // SETS_A_FILE + 1)
    discard(nodes)
    return out


def _confirmed(docs: DataFrame, pairs: DataFrame, similarity: Similarity, text: str) -> DataFrame:
    """The pairs whose full sets are similar enough, written.

    The set of a pair's first node isn't put beside each second one's: it comes once, before the sets of all its
    second nodes. A node is the first of at most BLOCK pairs for each of its bands and levels.
    """
    n = pairs.count()
    sets = _sets(docs, pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), similarity, text, n // EDGES + 1)
    firsts = sets.join(pairs.select(F.col("a").alias("node")).distinct().hint("merge"), "node", "left_semi").select(F.col("node").alias("a"), F.lit(None).cast("long").alias("b"), "items")
    seconds = pairs.hint("merge").join(sets.withColumnRenamed("node", "b"), "b").select("a", "b", "items")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = np.zeros(0, np.uint64)
        for batch in batches:
            keep = []
            for b, x in zip(batch.column(1).to_pylist(), batch.column(2), strict=True):
                found = np.frombuffer(x.as_buffer(), np.uint64)
                if b is None:
                    first = found.copy()
                    keep.append(False)
                else:
                    inter = _shared(first, found)
                    keep.append(similarity.linked(inter, len(first) + len(found) - inter))
            kept = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(k).filter(kept) for k in (0, 1)], ["a", "b"])

    rows = firsts.unionByName(seconds).repartition("a").sortWithinPartitions("a", F.col("b").asc_nulls_first())
    out = written(rows.mapInArrow(run, "a long, b long"), "neardup-links", n // PAIRS_A_FILE + 1)
    discard(sets)
    return out


def components(links: DataFrame) -> DataFrame:
    """(node, component) of all nodes that have a link (a, b); component is the smallest node reachable.

    Alternates large-star and small-star until nothing changes; each round is written to the
    shared folder, in files of about EDGES links.
    """
    parts = links.count() // EDGES + 1
    edges = written(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "stars", parts)
    known = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(F.struct("v", "m"), F.struct(F.col("u").alias("v"), "m"))).alias("e")).select(F.col("e.v").alias("u"), F.col("e.m").alias("v"))
        before, edges = edges, written(small.where("u <> v").distinct(), "stars", parts)
        discard(before)
        state = edges.agg(F.count("u"), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")), F.lit(0))).first()
        if state == known:
            break
        known = state
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


def classes(docs: DataFrame, similarity: Similarity | None = None, text: str = "text") -> DataFrame:
    """One row per document: doc_id, key, n_shingles, component_id (smallest id reachable), kept.

    Links hold between documents whose sets of distinct shingles are similar enough; equal sets
    are linked. A text of fewer words than a shingle is one shingle. A null text, or one without words, has no set, is linked with
    nothing and is its own component. Rows with a null id take part, but name no component; a
    component of such rows only has a null id. kept says that the row's id is its component's (null
    ids: that the component is null), so repeated rows are kept or dropped alike. Documents of one
    id and different texts stay apart unless their texts are linked.
    """
    with batches_of(docs.sparkSession, WIDE):
        signs, of_fp = _classes(docs, similarity or Similarity(), text)
    out = signs.select("doc_id", "key", "n_shingles", "fp").join(of_fp, "fp", "left")
    component = F.when(F.col("fp").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "key", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def _classes(docs: DataFrame, similarity: Similarity, text: str) -> tuple[DataFrame, DataFrame]:
    """Signatures of all documents, and the component of each fingerprint; both written.

    Every step is a table in the shared folder, of files sized by its rows.
    """
    signs = written(signed(docs, similarity, text), "neardup-signs")
    n = signs.count()
    nodes = written(signs.where("fp is not null").groupBy("fp").agg(F.min("key").alias("node"), F.min("doc_id").alias("first")), "neardup-fps", n // EDGES + 1)
    # one row a node; a repeated row has the same key, and the same signature
    of_nodes = signs.where("fp is not null").select("fp", F.col("key").alias("node"), "sig", "bands").join(nodes.select("fp", "node").hint("merge"), ["fp", "node"], "left_semi")
    of_nodes = written(of_nodes, "neardup-of-nodes", n // SIGNS_A_FILE + 1)
    bands = of_nodes.select("node", F.posexplode("bands").alias("band", "bucket")).select("bucket", F.col("band").cast("long"), "node")
    members = written(_members(bands, True, n * (HASHES // similarity.rows) // EDGES + 1), "neardup-members", n * (HASHES // similarity.rows) // EDGES + 1)
    m = members.count()
    # the members of shared buckets only: a small part of all signatures goes on
    signatures = of_nodes.select("node", "sig").join(members.select("node").distinct().hint("merge"), "node", "left_semi").dropDuplicates(["node"])
    signatures = written(signatures, "neardup-sigs", n // SIGNS_A_FILE + 1)
    near = _candidates(members, signatures, similarity)
    links = _confirmed(docs, near, similarity, text)
    found = components(links)
    placed = members.select("bucket", "band", "node").join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    # a bucket inside one component needs no second look, nor does one of two nodes: its one pair was tested
    mixed = placed.groupBy("bucket").agg(F.min("component").alias("x"), F.max("component").alias("y"), F.count("*").alias("n")).where("x <> y and n > 2").select("bucket")
    placed = written(_with_bucket(placed, mixed, "left_semi"), "neardup-placed", m // EDGES + 1)
    sets = _sets(docs, placed.select("node").distinct(), similarity, text, m // EDGES + 1)
    more = written(_bridges(_dealt(placed, signatures, sets), similarity), "neardup-more", placed.count() // PAIRS_A_FILE + 1)
    if not more.isEmpty():
        found = components(links.unionByName(more))
    roots = nodes.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    named = roots.groupBy("component").agg(F.min("first").alias("component_id"))
    of_fp = written(roots.join(named, "component").select("fp", "component_id"), "neardup-classes", n // EDGES + 1)
    discard(nodes, of_nodes, members, signatures, near, links, placed, sets, more)
    return signs, of_fp


def deduplicate(docs: DataFrame, similarity: Similarity | None = None, text: str = "text") -> DataFrame:
    """The documents with their own columns, one of each class: the one of smallest id, repeated rows once.

    Rows with a null id are kept once per class of such rows. Texts without words are all kept, repeated rows of them once.
    """
    found = classes(docs, similarity, text)
    parts = docs.count() // EDGES + 1
    flags = written(found.select("key", F.col("component_id").alias("c"), "n_shingles", "kept"), "neardup-flags", parts)
    # of rows with a null id, or of one id and several linked texts, one key stands for the class
    apart = F.when(F.col("n_shingles") == 0, F.col("key")).when(F.col("c").isNull(), F.col("key")).alias("apart")
    one = written(flags.where("kept").groupBy("c", apart).agg(F.min("key").alias("key")).select("key"), "neardup-kept", parts)
    # rows whose key is kept and comes once stay without a shuffle: only those that share a short hash, of 2^20
    # at most, with a dropped or repeated key are looked up
    key, short = fresh(docs, "key", "short")
    shortened = lambda c: F.pmod(c, F.lit(1 << 20)).cast("int").alias(short)
    counts = flags.groupBy("key").agg(F.count("*").alias("n")).join(one.select("key", F.lit(True).alias("kept")).hint("merge"), "key", "left")
    doubtful = F.broadcast(written(counts.where("kept is null or n > 1").select(shortened("key")).distinct(), "neardup-doubtful", 1))
    rows = docs.withColumn(key, F.xxhash64("doc_id", text)).withColumn(short, shortened(key))
    sure = rows.join(doubtful, short, "left_anti").select(*docs.columns)
    looked_up = rows.join(doubtful, short, "left_semi").join(one.withColumnRenamed("key", key).hint("merge"), key, "left_semi").dropDuplicates([key]).select(*docs.columns)
    return sure.unionByName(looked_up)
