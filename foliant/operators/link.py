"""Linking figures to captions, paragraphs and descriptions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T

_FIGURE = r"(?i)Fig(?:ure)?\.?\s*(\d+)"


def full_text(pages: DataFrame) -> DataFrame:
    """One text a paper: `[PAGE n]`, a line break and the page's text, pages joined by line breaks. Offsets refer to it."""
    rows = F.array_sort(F.collect_list(F.struct("page", F.coalesce("text", F.lit("")).alias("text"))))
    joined = F.array_join(F.transform(rows, lambda r: F.concat(F.lit("[PAGE "), r["page"].cast("string"), F.lit("]\n"), r["text"])), "\n")
    return pages.groupBy("arxiv_id").agg(joined.alias("full_text"))


def page_text(pages: DataFrame, wanted: DataFrame) -> DataFrame:
    """Texts of wanted (arxiv_id, page): pages below 1 mean the first, a page that isn't there is ''."""
    asked = wanted.withColumn("__page", F.greatest(F.col("page"), F.lit(1)))
    texts = pages.select("arxiv_id", F.col("page").alias("__page"), "text")
    return asked.join(texts, ["arxiv_id", "__page"], "left").drop("__page").withColumn("text", F.coalesce("text", F.lit("")))


def paragraphs(blocks: DataFrame, texts: DataFrame) -> DataFrame:
    """Paragraphs with offsets and types: arxiv_id, para_ord, text, page, start, end, type."""
    grouped = blocks.groupBy("arxiv_id").agg(F.array_sort(F.collect_list(F.struct("block_ord", "page", "text"))).alias("blocks"))
    rows = grouped.join(texts, "arxiv_id").select("arxiv_id", F.posexplode(T.track_offsets("full_text", "blocks")).alias("para_ord", "p"))
    return rows.select("arxiv_id", "para_ord", "p.*")


def captions(texts: DataFrame) -> DataFrame:
    """Captions of full texts: arxiv_id, cap_ord (discovery order), figure_number, caption_text, start, end, page."""
    return texts.select("arxiv_id", F.posexplode(T.captions(F.col("full_text"))).alias("cap_ord", "c")).select("arxiv_id", "cap_ord", "c.*")


def references(texts: DataFrame) -> DataFrame:
    """References to figures; a place that several patterns match counts for each."""
    return texts.select("arxiv_id", F.posexplode(T.references(F.col("full_text"))).alias("ref_ord", "r")).select("arxiv_id", "ref_ord", "r.*")


def captions_by_page(found: DataFrame) -> DataFrame:
    """(arxiv_id, page) -> caption texts in discovery order."""
    rows = F.transform(F.array_sort(F.collect_list(F.struct("cap_ord", "caption_text"))), lambda c: c["caption_text"])
    return found.groupBy("arxiv_id", "page").agg(rows.alias("captions"))


def _first(captions_: DataFrame, keys: list[str], name: str) -> DataFrame:
    """The first caption for each value of the keys, as a struct column."""
    return captions_.groupBy(*keys).agg(F.min_by(F.struct("cap_ord", "figure_number", "caption_text", "page", "start", "end"), "cap_ord").alias(name))


def link_captions(figures: DataFrame, captions_: DataFrame, use_page: bool = True) -> DataFrame:
    """Figures with `caption_info`, by priority: the first caption of the figure's number (and page, if known), else the first on its page.

    Two equi-joins and a coalesce; no join on alternatives. Without `use_page` only the number
    counts, on any page. figure_index is taken for the printed number.
    """
    if not use_page:
        first = _first(captions_, ["arxiv_id", "figure_number"], "caption_info").withColumnRenamed("figure_number", "figure_index")
        return figures.join(first, ["arxiv_id", "figure_index"], "left")
    by_both = _first(captions_, ["arxiv_id", "figure_number", "page"], "__both").select("arxiv_id", F.col("figure_number").alias("figure_index"), F.col("page").alias("page_number"), "__both")
    by_number = _first(captions_, ["arxiv_id", "figure_number"], "__number").select("arxiv_id", F.col("figure_number").alias("figure_index"), "__number")
    by_page = _first(captions_, ["arxiv_id", "page"], "__page").select("arxiv_id", F.col("page").alias("page_number"), "__page")
    out = figures.join(by_both, ["arxiv_id", "figure_index", "page_number"], "left").join(by_number, ["arxiv_id", "figure_index"], "left").join(by_page, ["arxiv_id", "page_number"], "left")
    fallback = F.when(F.col("page_number").isNull(), F.col("__number")).when(F.col("page_number") != 0, F.col("__page"))
    return out.withColumn("caption_info", F.coalesce("__both", fallback)).drop("__both", "__number", "__page")


def link_paragraphs(figures: DataFrame, paragraphs_: DataFrame) -> DataFrame:
    """Figures with `refs`: the paragraphs that name the figure's number, in order, whole.

    The numbers a paragraph names are extracted once and joined by equality. The caption's own
    paragraph is among them.
    """
    named = paragraphs_.withColumn("number", F.explode(F.array_distinct(F.regexp_extract_all("text", F.lit(_FIGURE), 1))))
    keyed = figures.select("arxiv_id", "figure_index").distinct().withColumn("number", F.col("figure_index").cast("string"))
    rows = keyed.join(named, ["arxiv_id", "number"]).groupBy("arxiv_id", "figure_index").agg(F.array_sort(F.collect_list(F.struct("para_ord", "text", "page", "start", "end"))).alias("refs"))
    kind = "array<struct<para_ord:int,text:string,page:int,start:int,end:int>>"
    return figures.join(rows, ["arxiv_id", "figure_index"], "left").withColumn("refs", F.coalesce("refs", F.array().cast(kind)))


def of_numbers(figures: DataFrame, work: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Figures with what `work` adds to (arxiv_id, figure_index), done once for each pair that occurs.

    A number's paragraphs grow with its paper, and the figures of the number with the table: neither the
    texts nor the work on them are repeated a figure.
    """
    found = work(figures.select("arxiv_id", "figure_index").distinct()).withColumnsRenamed({"arxiv_id": "__paper", "figure_index": "__number"})
    same = F.col("arxiv_id").eqNullSafe(F.col("__paper")) & F.col("figure_index").eqNullSafe(F.col("__number"))
    return figures.join(found, same, "left").drop("__paper", "__number")


def contexts(figures: DataFrame, captions_: DataFrame, texts: DataFrame, window: int = 500) -> DataFrame:
    """Figures (with `refs`) and their `contexts`: the text around the caption of the number, on any page, then the paragraphs."""
    side = window // 2
    own = figures.withColumnRenamed("caption_info", "__own")
    found = link_captions(own, captions_, use_page=False).withColumnRenamed("caption_info", "__c").join(texts, "arxiv_id", "left")
    low = F.greatest(F.lit(0), F.col("__c.start") - side)
    high = F.least(F.length("full_text"), F.col("__c.end") + side)
    around = F.when(F.col("__c").isNotNull(), F.array(F.substring(F.col("full_text"), low + 1, high - low))).otherwise(F.array().cast("array<string>"))
    return found.withColumn("contexts", F.concat(around, F.transform("refs", lambda r: r["text"]))).drop("__c", "full_text").withColumnRenamed("__own", "caption_info")


def descriptions(linked: DataFrame, least: int = 20) -> DataFrame:
    """`descriptions` and `text_positions` of figures with `caption_info` and `refs`: the caption, however short, then paragraphs of more than `least` characters when cleaned."""
    row = lambda body, start, end: F.struct(T.clean_description(body).alias("text"), F.struct(start.alias("start"), end.alias("end")).alias("position"))
    c = F.col("caption_info")
    kind = "array<struct<text:string,position:struct<start:int,end:int>>>"
    own = F.when(F.length(c["caption_text"]) > 0, F.array(row(c["caption_text"], c["start"], c["end"]))).otherwise(F.array().cast(kind))
    others = F.filter(F.transform("refs", lambda r: row(r["text"], r["start"], r["end"])), lambda d: F.length(d["text"]) > least)
    out = linked.withColumn("__d", F.concat(own, others))
    return out.withColumn("descriptions", F.transform("__d", lambda d: d["text"])).withColumn("text_positions", F.transform("__d", lambda d: d["position"])).drop("__d")


def figure_texts(figures: DataFrame, pages: DataFrame, blocks: DataFrame) -> DataFrame:
    """Caption, contexts, descriptions and positions of every figure."""
    texts = full_text(pages)
    caps, paras = captions(texts), paragraphs(blocks, texts)
    linked = link_paragraphs(link_captions(figures, caps), paras)
    out = descriptions(contexts(linked, caps, texts))
    return out.withColumn("caption", F.coalesce("caption_info.caption_text", F.lit(""))).drop("caption_info", "refs")


def sections(texts: DataFrame) -> DataFrame:
    return texts.select("arxiv_id", F.posexplode(T.sections(F.col("full_text"))).alias("sec_ord", "s")).select("arxiv_id", "sec_ord", "s.*")


def section_of(positions: DataFrame, sections_: DataFrame) -> DataFrame:
    """As-of join: positions (arxiv_id, position) with the title of the last section that starts at or before them, else null.

    Sections and positions are ordered together and the last title is carried on, so a paper's
    rows meet once, not in pairs.
    """
    a = sections_.select("arxiv_id", F.col("start").alias("position"), F.struct("sec_ord", "title").alias("s"), F.lit(None).cast("boolean").alias("asked"), F.lit(0).alias("side"))
    b = positions.select("arxiv_id", "position", F.lit(None).cast(a.schema["s"].dataType).alias("s"), F.lit(True).alias("asked"), F.lit(1).alias("side"))
    w = Window.partitionBy("arxiv_id").orderBy("position", "side", F.col("s.sec_ord")).rowsBetween(Window.unboundedPreceding, 0)
    out = a.unionByName(b).withColumn("title", F.last("s", ignorenulls=True).over(w)["title"])
    return out.where("asked").select("arxiv_id", "position", "title")
