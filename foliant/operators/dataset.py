"""The dataset: acceptance, entries, ordered stop, counts, statistics and rankings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.match import clean_terms, confidence, find_in_sources
from ..functions.topics import identify_topic
from ..vocab import Vocabulary

#: Rows of a bucket in a running total.
BUCKET = 100_000


def accepted(scores: DataFrame, threshold: float = 0.5) -> Column:
    """Whether a score reaches the threshold; null scores don't."""
    return F.coalesce(scores["score"] >= threshold, F.lit(False))


def scored(figures: DataFrame, probability: Column, threshold: float = 0.5) -> DataFrame:
    """A scorer's probability as (score, is_circuit, class_label); a null one is an error and scores 0."""
    p = F.coalesce(probability, F.lit(0.0))
    label = F.when(probability.isNull(), "error").when(p >= threshold, "circuit").otherwise("non_circuit")
    return figures.withColumns({"score": p, "is_circuit": p >= threshold, "class_label": label})


def entries(rows: DataFrame, gates: Vocabulary, topics: Vocabulary) -> DataFrame:
    """Accepted figures with texts and recognised entities (`visual_gates`) become dataset rows.

    Descriptions fall back to the caption, positions to the caption's extent, and to [[]] without one.
    """
    sources = find_in_sources(F.col("caption"), F.col("contexts"), F.lit(""), gates)
    out = rows.withColumn("__s", sources).withColumn("__t", identify_topic(F.col("caption"), F.col("contexts"), topics))
    every = F.array_union(F.coalesce("visual_gates", F.array().cast("array<string>")), F.array_union("__s.from_caption", "__s.from_context"))
    has = F.coalesce(F.length("caption"), F.lit(0)) > 0
    pair = F.transform("text_positions", lambda p: F.array(p["start"], p["end"]))
    fallback = F.when(has, F.array(F.array(F.lit(0), F.length("caption")))).otherwise(F.array(F.array().cast("array<int>")))
    return out.select(
        "filename",
        "arxiv_id",
        "page_number",
        F.col("figure_index").alias("figure_number"),
        clean_terms(every, gates).alias("quantum_gates"),
        F.col("__t.algorithm").alias("quantum_problem"),
        F.when(F.size("descriptions") > 0, F.col("descriptions")).when(has, F.array("caption")).otherwise(F.array().cast("array<string>")).alias("descriptions"),
        F.when(F.size("text_positions") > 0, pair).otherwise(fallback).alias("text_positions"),
        F.col("score").alias("confidence_score"),
        F.struct(
            "extraction_method",
            confidence(F.col("__s")).alias("gate_confidence"),
            F.col("__t.confidence").alias("algorithm_confidence"),
            F.col("__t.source").alias("algorithm_source"),
            F.col("score").alias("cnn_score"),
        ).alias("metadata"),
    )


def running_total(df: DataFrame, order: str, value: str, name: str, bucket: int = BUCKET) -> DataFrame:
    """Sum of `value` over all rows of smaller `order` (an integer), without one task for all rows.

    Rows are summed per bucket of the order; only bucket totals, one row each, meet in one task.
    """
    b = F.floor(F.col(order) / bucket)
    totals = df.groupBy(b.alias("__b")).agg(F.sum(value).alias("__t"))
    before = totals.select("__b", F.coalesce(F.sum("__t").over(Window.orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__before"))
    inside = Window.partitionBy("__b").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    out = df.withColumn("__b", b).withColumn("__in", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    return out.join(before, "__b").withColumn(name, F.col("__before") + F.col("__in")).drop("__b", "__in", "__before")


def ordered_stop(papers: DataFrame, target: int, order: str = "paper_ord", accepted_: str = "n_accepted") -> DataFrame:
    """Papers are visited until `target` figures are collected: visited, collected (the last one cut)."""
    out = running_total(papers, order, accepted_, "__sum")
    return out.withColumn("visited", F.col("__sum") < target).withColumn("collected", F.when(F.col("visited"), F.least(F.col(accepted_), F.lit(target) - F.col("__sum"))).cast("long")).drop("__sum")


def whole_paper_stop(papers: DataFrame, limit: int, order: str = "paper_ord", figures: str = "n_figures") -> DataFrame:
    """Papers whose predecessors hold fewer than `limit` figures, each whole: may overshoot."""
    return running_total(papers, order, figures, "__sum").where(F.col("__sum") < limit).drop("__sum")


def first_rows(df: DataFrame, n: int, *order: str) -> DataFrame:
    return df.orderBy(*order).limit(n)


def image_count_cell(status: Column, count: Column) -> Column:
    """A paper's count as written: empty if not visited, else its count or 0."""
    return F.when(status == "not_visited", F.lit(None).cast("int")).otherwise(F.coalesce(count, F.lit(0)))


def paper_statistics(papers: DataFrame) -> DataFrame:
    """One row: total, processed, with_images, total_images, not_visited."""
    n = F.col("image_count")
    return papers.agg(
        F.count("*").alias("total"),
        F.count_if(F.col("status") == "processed").alias("processed"),
        F.count_if(n > 0).alias("with_images"),
        F.coalesce(F.sum(n), F.lit(0)).cast("long").alias("total_images"),
        F.count_if(F.col("status") == "not_visited").alias("not_visited"),
    )


def distribution(values: DataFrame, name: str, order: str) -> DataFrame:
    """(name, n, first): counts of a column's values and where each comes first."""
    return values.where(F.col(name).isNotNull()).groupBy(name).agg(F.count("*").alias("n"), F.min(order).alias("first"))


def gate_distribution(circuits: DataFrame, order: str) -> DataFrame:
    return distribution(circuits.select(order, F.posexplode("quantum_gates").alias("__p", "gate")).select(F.struct(order, "__p").alias("at"), "gate"), "gate", "at")


def top(counts: DataFrame, k: int) -> DataFrame:
    """The k most frequent; ties by first occurrence."""
    return counts.orderBy(F.desc("n"), "first").limit(k)


def statistics(circuits: DataFrame, papers_processed: int = 0, images: int = 0, skip_empty_topics: bool = False) -> DataFrame:
    """One row of totals, distributions (maps) and means."""
    n_gates, n_text = F.size("quantum_gates"), F.size("descriptions")
    totals = circuits.agg(
        F.count("*").alias("total_circuits_found"),
        F.countDistinct(F.coalesce("arxiv_id", F.lit(""))).alias("papers_with_circuits"),
        F.coalesce(F.sum(n_gates) / F.count("*"), F.lit(0.0)).alias("avg_gates_per_circuit"),
        F.coalesce(F.sum(n_text) / F.count("*"), F.lit(0.0)).alias("avg_descriptions_per_image"),
    )
    gates = circuits.select(F.explode("quantum_gates").alias("k")).groupBy("k").count()
    topics = circuits.where(F.col("quantum_problem") != "" if skip_empty_topics else F.lit(True)).groupBy(F.coalesce("quantum_problem", F.lit("")).alias("k")).count()
    as_map = lambda df, name: df.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("k", "count")))).alias(name))
    # three frames of one row each; the distributions are bounded by the vocabularies
    out = totals.crossJoin(as_map(gates, "gate_distribution")).crossJoin(as_map(topics, "algorithm_distribution"))
    return out.select(
        F.lit(papers_processed).cast("long").alias("total_papers_processed"),
        F.lit(images).cast("long").alias("total_images_extracted"),
        "total_circuits_found",
        "papers_with_circuits",
        "gate_distribution",
        "algorithm_distribution",
        "avg_gates_per_circuit",
        "avg_descriptions_per_image",
    )


def token_counts(tokens: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """Counts of recognised tokens (column token) that are terms."""
    from ..functions.match import normalise_term

    return tokens.withColumn("gate", normalise_term(F.col("token"), vocabulary)).where("gate is not null").groupBy("gate").agg(F.count("*").alias("n"))


def training_summary(epochs: DataFrame) -> DataFrame:
    """Mean loss and accuracy per (epoch, phase) from (epoch, phase, loss_sum, correct, rows), and the best validated epoch."""
    out = epochs.groupBy("epoch", "phase").agg((F.sum("loss_sum") / F.sum("rows")).alias("loss"), (F.sum("correct") / F.sum("rows")).alias("accuracy"))
    best = out.where("phase = 'val'").agg(F.max_by("epoch", F.struct("accuracy", -F.col("epoch"))).alias("best"))
    return out.crossJoin(best).withColumn("is_best", F.col("epoch") == F.col("best")).drop("best")
