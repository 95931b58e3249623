"""The whole run, phase one alone, and validation alone."""

from __future__ import annotations

import argparse
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import dataset as D
from ..operators import link
from ..operators.figures import filename
from ..operators.quality import export_rules, fix, summary, validate
from ..sources.datasets import export, read_dataset
from ..vocab import Vocabulary, gates, topics


@dataclass(frozen=True)
class Inputs:
    """Tables of parsed papers. `score` adds (filename, circuit probability), `recognise` adds visual_gates; both are injected."""

    papers: DataFrame  # paper_ord, arxiv_id, full_id, status, image_count
    figures: DataFrame  # arxiv_id, page_number, figure_index, extraction_method
    pages: DataFrame
    blocks: DataFrame
    score: Callable[[DataFrame], DataFrame]
    recognise: Callable[[DataFrame], DataFrame] | None = None


def accepted_figures(i: Inputs, figures: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Figures with names and scores that reach the threshold, before any text is linked to them."""
    named = i.score(figures.withColumn("filename", filename()))
    return D.scored(named, F.col("circuit_prob")).where(F.col("score") >= threshold)


def collect_circuits(i: Inputs, target: int = 250, wave: int = 64, gate_terms: Vocabulary | None = None, topic_terms: Vocabulary | None = None, persist: Callable[[DataFrame, int], DataFrame] | None = None, held: list[DataFrame] | None = None) -> tuple[DataFrame, DataFrame]:
    """(circuits in order, papers with status and count) until `target` circuits are found.

    A limit can't stop stages before it, so papers are scored in waves of growing size, in
    order, until enough figures are accepted; then the cut is exact, also inside a paper. Only a
    count per wave comes to the driver. `persist` may store a wave's accepted figures; without it they are
    cached, and put on `held` for the caller to release.
    """
    done, have, low = None, 0, 0
    bounds = i.papers.agg(F.min("paper_ord"), F.max("paper_ord")).first()
    low, last = (bounds[0] or 0), bounds[1]
    number = 0
    while last is not None and low <= last and have < target:
        part = i.papers.where(F.col("paper_ord").between(low, low + wave - 1))
        found = accepted_figures(i, i.figures.join(part.select("arxiv_id", "paper_ord"), "arxiv_id"))
        found = persist(found, number) if persist else found.cache()
        if held is not None and not persist:
            held.append(found)
        have += found.count()
        done = found if done is None else done.unionByName(found)
        low, wave, number = low + wave, 2 * wave, number + 1
    if done is None:
        raise ValueError("there are no papers")
    counts = i.papers.join(done.groupBy("arxiv_id").agg(F.count("*").alias("n_accepted")), "arxiv_id", "left").fillna(0, ["n_accepted"])
    stops = D.ordered_stop(counts, target)
    kept = done.drop("paper_ord").join(stops.where("visited").select("arxiv_id", "paper_ord", "collected"), "arxiv_id")
    nth = D.running_total(kept.withColumn("one", F.lit(1)).withColumn("at", F.col("paper_ord") * 100_000 + F.col("figure_index")), "at", "one", "before")
    kept = nth.where(F.col("before") < target).drop("one", "before", "collected")
    texts = link.figure_texts(kept, i.pages, i.blocks)
    if i.recognise:
        texts = i.recognise(texts)
    else:
        texts = texts.withColumn("visual_gates", F.array().cast("array<string>"))
    order = kept.select("filename", F.col("at").alias("ord"))
    circuits = D.entries(texts, gate_terms or gates(), topic_terms or topics()).join(order, "filename")
    # a failed paper keeps its status, and its count of 0
    status = F.when(F.col("status") == "failed", "failed").when(F.col("visited"), "processed").otherwise("not_visited")
    tracked = stops.withColumn("image_count", F.when(F.col("visited"), F.coalesce("collected", F.lit(0)).cast("int"))).withColumn("status", status)
    return circuits, tracked.drop("visited", "collected", "n_accepted")


def run(i: Inputs, disk: DataFrame, directory: str, target: int = 250) -> dict[str, str]:
    """Collect, check, clean if need be, and export; the cleaned rows are the ones exported."""
    held: list[DataFrame] = []
    try:
        circuits, papers = collect_circuits(i, target, held=held)
        cleaned, _ = fix(export_rules(circuits), disk, gates())
        totals = papers.agg(F.count_if(F.col("status") == "processed").alias("p")).first()["p"]
        return export(cleaned, D.statistics(cleaned, totals, i.figures.count()), directory)
    finally:
        for df in held:
            df.unpersist()


def run_phase_one(i: Inputs, limit: int = 100) -> DataFrame:
    """Figures of whole papers until `limit` are found; may overshoot; nothing is linked, scored or exported."""
    counts = i.papers.join(i.figures.groupBy("arxiv_id").agg(F.count("*").alias("n_figures")), "arxiv_id", "left").fillna(0, ["n_figures"])
    return i.figures.join(D.whole_paper_stop(counts, limit).select("arxiv_id", "paper_ord"), "arxiv_id")


def run_validation(spark: SparkSession, dataset: str, images: DataFrame, show: int = 10) -> bool:
    """Check a dataset file against the images there are; prints a summary and the first findings; writes nothing."""
    found = validate(read_dataset(spark, dataset), images, gates(), "json").cache()
    line = summary(found).first()
    print(f"valid: {line['is_valid']}, errors: {line['n_errors']}, warnings: {line['n_warnings']}")
    for r in found.orderBy("severity", "filename", "error_type").limit(show).collect():
        print(f"  {r['severity']}: {r['filename']}: {r['message']}")
    return line["is_valid"]


def stored_inputs(spark: SparkSession, tables: str) -> Inputs:
    """Inputs from Parquet tables in a folder: papers, figures, pages, blocks, and scores (filename, circuit_prob) of a scorer that ran before.

    A figure without a score counts as an error. `visual_gates` of a table `tokens` (filename, visual_gates) are taken if there is one.
    """
    read = lambda name: spark.read.parquet(f"{tables}/{name}.parquet")
    scores = read("scores").select("filename", F.col("circuit_prob").cast("double").alias("circuit_prob"))
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{tables}/tokens.parquet")
    there = folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)
    recognise = (lambda df: df.join(read("tokens").select("filename", "visual_gates"), "filename", "left")) if there else None
    return Inputs(read("papers"), read("figures"), read("pages"), read("blocks"), lambda df: df.join(scores, "filename", "left"), recognise)


def main(argv: list[str] | None = None) -> int:
    """The whole run (to a target of figures), phase one alone, or validation of a dataset file."""
    from ..session import session

    p = argparse.ArgumentParser(description=main.__doc__)
    p.add_argument("--target", "-t", type=int, default=250, help="figures to collect")
    p.add_argument("--test", action="store_true", help="collect 5")
    p.add_argument("--phase-one", type=int, metavar="N", help="only write the figures of whole papers until N are found")
    p.add_argument("--validate-only", "-v", metavar="DATASET")
    p.add_argument("--tables", help="folder of papers, figures, pages, blocks and scores as Parquet")
    p.add_argument("--images", help="folder of PNG files")
    p.add_argument("--out", help="folder of the results")
    a = p.parse_args(argv)
    needed = ("images",) if a.validate_only else ("tables", "out") if a.phase_one else ("tables", "out", "images")
    for name in needed:
        if getattr(a, name) is None:
            p.error(f"--{name} is needed")
    spark = session()
    if a.phase_one:
        run_phase_one(stored_inputs(spark, a.tables), a.phase_one).write.mode("overwrite").parquet(f"{a.out}/figures")
        return 0
    images = spark.read.format("binaryFile").option("pathGlobFilter", "*.png").load(a.images).select(F.regexp_extract("path", r"([^/]+)$", 1).alias("filename"))
    if a.validate_only:
        return 0 if run_validation(spark, a.validate_only, images) else 1
    for name, path in run(stored_inputs(spark, a.tables), images, a.out, 5 if a.test else a.target).items():
        print(f"{name}: {path}")
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
