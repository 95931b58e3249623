"""Validation and cleaning of the dataset."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.match import clean_terms, is_term
from ..functions.text import clean_text, strip
from ..functions.topics import UNKNOWN
from ..vocab import Vocabulary

# Fields and the types that a value of theirs may have.
FIELDS = {
    "arxiv_id": "str",
    "page_number": "int",
    "figure_number": "int",
    "quantum_gates": "list",
    "quantum_problem": "str",
    "descriptions": "list",
    "text_positions": "list",
}
_TYPES = {"str": r"^STRING$", "int": r"^(BIGINT|BOOLEAN|INT|SMALLINT|TINYINT|DECIMAL\(\d+,0\))$", "list": r"^ARRAY<"}
ID_FORMAT = r"^(\d{4}\.\d{4,5}|[a-z-]+/\d{7})$"


def finding(kind: str, severity: str, message: Column | str, field: str | None = None) -> Column:
    return F.struct(F.lit(kind).alias("error_type"), F.lit(severity).alias("severity"), (F.lit(message) if isinstance(message, str) else message).alias("message"), F.lit(field).cast("string").alias("field"))


def _some(*checks: tuple[Column, Column]) -> Column:
    return F.filter(F.array(*(F.when(c, f) for c, f in checks)), lambda x: x.isNotNull())


def schema_findings(json: Column) -> Column:
    """Missing fields and wrong types of an entry's JSON text; a null value has the wrong type, true and false count as integers."""
    value = F.try_parse_json(json)
    checks = []
    for name, kind in FIELDS.items():
        got = F.try_variant_get(value, f"$.{name}", "variant")
        checks.append((got.isNull(), finding("missing_field", "error", f"Missing required field: {name}", name)))
        checks.append((got.isNotNull() & ~F.schema_of_variant(got).rlike(_TYPES[kind]), finding("wrong_type", "error", f"Wrong type for {name}: expected {kind}", name)))
    return _some(*checks)


def id_findings(paper: Column, filename: Column) -> Column:
    given = F.coalesce(F.length(paper), F.lit(0)) > 0
    return _some(
        (given & ~paper.rlike(ID_FORMAT), finding("invalid_format", "warning", F.concat(F.lit("Invalid arXiv ID format: "), paper), "arxiv_id")),
        (given & ~F.contains(filename, paper), finding("mismatch", "warning", "arXiv ID doesn't match filename", "arxiv_id")),
    )


def page_findings(page: Column) -> Column:
    page = F.coalesce(page, F.lit(0))
    return _some(
        (page < 1, finding("invalid_value", "error", F.concat(F.lit("Invalid page number: "), page.cast("string")), "page_number")),
        (page > 100, finding("suspicious_value", "warning", F.concat(F.lit("Unusually high page number: "), page.cast("string")), "page_number")),
    )


def gate_findings(gates: Column, vocabulary: Vocabulary) -> Column:
    gates = F.coalesce(gates, F.array().cast("array<string>"))
    unknown = F.transform(F.filter(gates, lambda g: ~is_term(g, vocabulary)), lambda g: finding("unknown_gate", "warning", F.concat(F.lit("Unknown gate name: "), g), "quantum_gates"))
    return F.concat(_some((F.size(gates) == 0, finding("empty_list", "warning", "No quantum gates listed", "quantum_gates"))), unknown)


def description_findings(descriptions: Column, positions: Column) -> Column:
    descriptions = F.coalesce(descriptions, F.array().cast("array<string>"))
    positions = F.coalesce(positions, F.array().cast("array<array<int>>"))

    def of(p: Column, i: Column) -> Column:
        at = i.cast("string")
        return F.when(F.coalesce(F.size(p), F.lit(-1)) != 2, finding("invalid_format", "error", F.concat(F.lit("Invalid position format at index "), at), "text_positions")).when(
            p[0] > p[1], finding("invalid_range", "error", F.concat(F.lit("Invalid position range: start > end at index "), at), "text_positions")
        )

    mismatch = F.concat(F.lit("Mismatch: "), F.size(descriptions).cast("string"), F.lit(" descriptions, "), F.size(positions).cast("string"), F.lit(" positions"))
    return F.concat(
        _some((F.size(descriptions) == 0, finding("empty_list", "warning", "No descriptions provided", "descriptions")), (F.size(descriptions) != F.size(positions), finding("length_mismatch", "error", mismatch, "text_positions"))),
        F.filter(F.transform(positions, of), lambda x: x.isNotNull()),
    )


def entry_findings(entries: DataFrame, vocabulary: Vocabulary, json: str | None = None) -> DataFrame:
    """All per-entry findings in long form: filename, error_type, severity, message, field. `json` names the raw text, if there is one."""
    c = F.col
    parts = [schema_findings(c(json))] if json else []
    parts += [id_findings(c("arxiv_id"), c("filename")), page_findings(c("page_number")), gate_findings(c("quantum_gates"), vocabulary), description_findings(c("descriptions"), c("text_positions"))]
    return entries.select("filename", F.explode(F.concat(*parts)).alias("f")).select("filename", "f.*")


def _file_findings(names: DataFrame, kind: str, severity: str, text: str) -> DataFrame:
    f = finding(kind, severity, F.concat(F.lit(text), F.col("filename")))
    return names.select("filename", f.alias("f")).select("filename", "f.*")


def missing_files(entries: DataFrame, disk: DataFrame) -> DataFrame:
    return _file_findings(entries.select("filename").join(disk, "filename", "left_anti"), "missing_file", "error", "Image file not found: ")


def orphan_findings(entries: DataFrame, disk: DataFrame) -> DataFrame:
    """Files without an entry (warning) and entries without a file (error): two anti-joins."""
    names = entries.select("filename")
    orphans = _file_findings(disk.select("filename").join(names, "filename", "left_anti"), "orphan_file", "warning", "Image file not in dataset: ")
    missing = _file_findings(names.join(disk, "filename", "left_anti"), "missing_file", "error", "Dataset entry without image file: ")
    return orphans.unionByName(missing)


def validate(entries: DataFrame, disk: DataFrame, vocabulary: Vocabulary, json: str | None = None) -> DataFrame:
    """All findings; an entry without a file is reported twice, once as such and once by the comparison with the folder."""
    return reduce(DataFrame.unionByName, [missing_files(entries, disk), entry_findings(entries, vocabulary, json), orphan_findings(entries, disk)])


def summary(findings: DataFrame) -> DataFrame:
    """One row: is_valid, n_errors, n_warnings."""
    s = F.col("severity")
    return findings.agg(F.count_if(s == "error").alias("n_errors"), F.count_if(s == "warning").alias("n_warnings")).withColumn("is_valid", F.col("n_errors") == 0)


def aligned_positions(positions: Column, descriptions: Column) -> Column:
    """As many positions as descriptions: padded with [0, 0] or cut."""
    n = F.size(descriptions)
    return F.slice(F.concat(positions, F.array_repeat(F.array(F.lit(0), F.lit(0)), n)), F.lit(1), n)


def clean(entries: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """Normalised gates, defaults for missing fields, aligned positions, cleaned descriptions."""
    texts = F.coalesce("descriptions", F.array().cast("array<string>"))
    return entries.withColumns(
        {
            "quantum_gates": clean_terms(F.coalesce("quantum_gates", F.array().cast("array<string>")), vocabulary),
            "quantum_problem": F.coalesce("quantum_problem", F.lit(UNKNOWN)),
            "text_positions": aligned_positions(F.coalesce("text_positions", F.array().cast("array<array<int>>")), texts),
            "descriptions": F.transform(texts, clean_text),
        }
    )


def longest_kept(descriptions: Column) -> Column:
    """Export rule: distinct descriptions, longest first (equal lengths in order), without those inside a kept one."""
    numbered = F.transform(F.array_distinct(descriptions), lambda d, i: F.struct((-F.length(d)).alias("l"), i.alias("i"), d.alias("d")))
    ordered = F.transform(F.array_sort(numbered), lambda s: s["d"])
    return F.aggregate(ordered, F.array().cast("array<string>"), lambda kept, d: F.when(F.exists(kept, lambda k: F.contains(k, d)), kept).otherwise(F.concat(kept, F.array(d))))


def longest_in_order(descriptions: Column) -> Column:
    """Cleaning rule: distinct descriptions in order, without those inside a longer one."""
    distinct = F.array_distinct(descriptions)
    return F.filter(distinct, lambda d: ~F.exists(distinct, lambda o: F.contains(o, d) & (F.length(d) < F.length(o))))


def export_rules(entries: DataFrame) -> DataFrame:
    """A blank topic becomes "unknown", descriptions are reduced; positions stay as they are."""
    blank = F.coalesce(F.length(strip(F.col("quantum_problem"))), F.lit(0)) == 0
    return entries.withColumn("quantum_problem", F.when(blank, "unknown").otherwise(F.col("quantum_problem"))).withColumn("descriptions", longest_kept(F.coalesce("descriptions", F.array().cast("array<string>"))))


def normalise_entries(entries: DataFrame, caption: str = "figure_caption") -> DataFrame:
    """Blank descriptions become the caption, if any, else the rest are reduced; a blank topic becomes "not identify"."""
    texts = F.coalesce("descriptions", F.array().cast("array<string>"))
    blank = F.forall(texts, lambda d: F.coalesce(F.length(strip(d)), F.lit(0)) == 0)
    own = F.when(F.coalesce(F.length(caption), F.lit(0)) > 0, F.array(caption)).otherwise(F.array().cast("array<string>"))
    empty = F.coalesce(F.length(strip(F.col("quantum_problem"))), F.lit(0)) == 0
    return entries.withColumn("descriptions", F.when(blank, own).otherwise(longest_in_order(texts))).withColumn("quantum_problem", F.when(empty, "not identify").otherwise(F.col("quantum_problem")))


def fix(entries: DataFrame, disk: DataFrame, vocabulary: Vocabulary) -> tuple[DataFrame, DataFrame]:
    """Validate, clean if there are errors, validate again: (entries, findings). The cleaned entries are final."""
    found = validate(entries, disk, vocabulary)
    if found.where("severity = 'error'").limit(1).count() == 0:
        return entries, found
    cleaned = clean(entries, vocabulary)
    return cleaned, validate(cleaned, disk, vocabulary)
