"""Dataset files: JSON, counts, statistics, report, images."""

from __future__ import annotations

from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.arrays import let
from ..schemas import ENTRY, STATISTICS

EXAM = "37"


def read_dataset(spark: SparkSession, path: str) -> DataFrame:
    """Rows of a dataset file, a JSON object filename -> entry, with each entry's raw text as `json`."""
    texts = spark.read.text(path, wholetext=True).select(F.explode(F.from_json("value", "map<string,string>")).alias("filename", "json"))
    return texts.withColumn("entry", F.from_json("json", ENTRY)).select("filename", "entry.*", "json")


def dataset_members(entries: DataFrame, order: str = "ord") -> DataFrame:
    """The members of the JSON object of all entries, a row each: first (its place), filename, value (`"name":{...}`).

    Of equal filenames the last counts, at the place of the first. By place and filename, joined by
    commas and in braces, they are the dataset; each in braces is a dataset of one entry.
    """
    fields = ["arxiv_id", "page_number", "figure_number", "quantum_gates", "quantum_problem", "descriptions", "text_positions"]
    last = entries.groupBy("filename").agg(F.min(order).alias("first"), F.max_by(F.struct(*fields), order).alias("entry"))
    json = F.to_json(F.create_map("filename", "entry"), {"ignoreNullFields": "false"})
    return last.select("first", "filename", let(json, lambda j: F.substring(j, F.lit(2), F.length(j) - 2)).alias("value"))


def dataset_json(entries: DataFrame, order: str = "ord") -> DataFrame:
    """One row `value`: the JSON object of all entries, for datasets that one row can hold (2 GB)."""
    rows = F.transform(F.array_sort(F.collect_list(F.struct("first", "filename", "value"))), lambda r: r["value"])
    return dataset_members(entries, order).agg(F.concat(F.lit("{"), F.array_join(rows, ","), F.lit("}")).alias("value"))


def entry_lines(entries: DataFrame, order: str = "ord") -> DataFrame:
    """The same as a table, for datasets of any size: filename and the entry's JSON text, last of equal names."""
    fields = ["arxiv_id", "page_number", "figure_number", "quantum_gates", "quantum_problem", "descriptions", "text_positions"]
    return entries.groupBy("filename").agg(F.to_json(F.max_by(F.struct(*fields), order), {"ignoreNullFields": "false"}).alias("json"))


def write_text(df: DataFrame, path: str) -> None:
    """A frame of text rows as a single file in a folder."""
    df.select("value").coalesce(1).write.mode("overwrite").text(path)


def write_dataset(entries: DataFrame, path: str, order: str = "ord") -> None:
    """The JSON object of all entries as a single file in a folder, a line each member.

    One task writes the file, from rows that stream by in order; none holds the dataset.
    """
    braces = entries.sparkSession.range(2).select((F.col("id") * 2).alias("part"), F.lit(None).alias("first"), F.lit(None).alias("filename"), F.when(F.col("id") == 0, "{").otherwise("}").alias("value"))
    rows = dataset_members(entries, order).select(F.lit(1).cast("long").alias("part"), "first", "filename", "value").unionByName(braces)
    number = F.row_number().over(Window.orderBy("part", "first", "filename"))
    write_text(rows.select("part", "value", number.alias("n")).select(F.concat(F.when((F.col("part") == 1) & (F.col("n") > 2), ",").otherwise(""), F.col("value")).alias("value")), path)


def statistics_json(stats: DataFrame) -> DataFrame:
    return stats.select(F.to_json(F.struct(*stats.columns)).alias("value"))


def read_statistics(spark: SparkSession, path: str) -> DataFrame:
    """Statistics with declared maps: inference would make a struct field of every name."""
    return spark.read.text(path, wholetext=True).select(F.from_json("value", STATISTICS).alias("s")).select("s.*")


def counts_table(papers: DataFrame) -> DataFrame:
    """(arxiv_id, image_count) as written, by paper order; the id is the full one."""
    from ..operators.dataset import image_count_cell

    return papers.select("paper_ord", F.col("full_id").alias("arxiv_id"), image_count_cell(F.col("status"), F.col("image_count")).alias("image_count"))


def write_counts(papers: DataFrame, path: str) -> None:
    counts_table(papers).coalesce(1).sortWithinPartitions("paper_ord").drop("paper_ord").write.mode("overwrite").csv(path, header=True, nullValue="")


def report(circuits: DataFrame, stats: DataFrame, order: str = "ord", exam: str = EXAM, generated: str | None = None) -> DataFrame:
    """One row `value`: totals, the 15 most frequent gates, the 10 most frequent topics, the first 3 entries."""
    from ..operators.dataset import distribution, gate_distribution, top

    rule = F.lit("=" * 60)
    ranked = lambda counts, name: F.coalesce(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("k"), "first", F.col(name).alias("name")))), lambda r: F.concat(F.lit("\n  "), r["name"], F.lit(": "), (-r["k"]).cast("string"))), ""), F.lit(""))
    gates = top(gate_distribution(circuits, order), 15).agg(ranked(None, "gate").alias("gates"))
    topics = top(distribution(circuits.select(order, "quantum_problem"), "quantum_problem", order), 10).agg(ranked(None, "quantum_problem").alias("topics"))
    entry = F.concat(
        F.lit("\n\nFilename: "), F.col("filename"), F.lit("\n  arXiv ID: "), F.col("arxiv_id"),
        F.lit("\n  Page: "), F.col("page_number").cast("string"), F.lit(", Figure: "), F.col("figure_number").cast("string"),
        F.lit("\n  Gates: "), F.array_join(F.slice("quantum_gates", 1, 5), ", "), F.lit("\n  Problem: "), F.col("quantum_problem"),
    )
    first = circuits.orderBy(order).limit(3).select(order, entry.alias("e")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, "e"))), lambda r: r["e"]), "").alias("samples"))
    when = F.lit(generated) if generated else F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss")
    two = lambda c: F.format_string("%.2f", F.col(c))
    lines = [
        rule, F.lit("QUANTUM CIRCUIT DATASET SUMMARY REPORT"), F.lit(f"Exam ID: {exam}"), F.concat(F.lit("Generated: "), when), rule, F.lit(""),
        F.concat(F.lit("Total Images: "), F.col("total_circuits_found").cast("string")),
        F.concat(F.lit("Papers with Circuits: "), F.col("papers_with_circuits").cast("string")),
        F.concat(F.lit("Average Gates per Circuit: "), two("avg_gates_per_circuit")),
        F.concat(F.lit("Average Descriptions per Image: "), two("avg_descriptions_per_image")),
        F.lit(""), F.concat(F.lit("Gate Distribution:"), F.col("gates")), F.lit(""), F.concat(F.lit("Algorithm Distribution:"), F.col("topics")),
        F.lit(""), rule, F.lit("Sample Entries:"), F.concat(rule, F.coalesce("samples", F.lit(""))),
    ]
    return stats.crossJoin(gates).crossJoin(topics).crossJoin(first).select(F.concat_ws("\n", *lines).alias("value"))


def write_images(figures: DataFrame, directory: str, folder: Column | None = None) -> None:
    """PNG files named by figure, in a folder each if one is given. `directory` is a path or URI that all executors share.

    Files are written whole, task by task; a task that runs again writes the same files. Null images are left out.
    """

    def save(rows) -> None:
        store, root = fs.FileSystem.from_uri(directory) if "://" in directory else (fs.LocalFileSystem(), directory)
        made: set[str] = set()
        for r in rows:
            place = f"{root}/{r['folder']}" if r["folder"] else root
            if place not in made:
                store.create_dir(place, recursive=True)
                made.add(place)
            with store.open_output_stream(f"{place}/{r['filename']}") as out:
                out.write(bytes(r["image"]))

    rows = figures.where("image is not null").select("filename", "image", (F.lit("") if folder is None else folder).alias("folder"))
    rows.foreachPartition(save)


def decision() -> Column:
    """accepted or rejected, by score."""
    return F.when(F.coalesce(F.col("score") >= 0.5, F.lit(False)), "accepted").otherwise("rejected")


def write_by_decision(scored: DataFrame, path: str) -> None:
    """Accepted and rejected figures as tables, a folder each; `write_images(scored, path, decision())` writes them as files."""
    scored.withColumn("decision", decision()).write.mode("overwrite").partitionBy("decision").parquet(path)


def export(circuits: DataFrame, stats: DataFrame | None, directory: str, exam: str = EXAM, order: str = "ord") -> dict[str, str]:
    """Dataset, statistics (if given) and report; returns their paths."""
    from ..operators.quality import export_rules

    paths = {"dataset": f"{directory}/dataset_{exam}.json"}
    write_dataset(export_rules(circuits), paths["dataset"], order)
    if stats is not None:
        paths["statistics"] = f"{directory}/statistics_{exam}.json"
        write_text(statistics_json(stats), paths["statistics"])
        paths["report"] = f"{directory}/summary_report_{exam}.txt"
        write_text(report(circuits, stats, order, exam), paths["report"])
    return paths


