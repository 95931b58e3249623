"""More queries over the driver's tables: validation, cleaning, figures, texts of figures; each with its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geometry as G
from ..functions import match as M
from ..operators import dataset as D
from ..operators import figures as FG
from ..operators import link as L
from ..operators import quality as Q
from ..vocab import gates
from . import synthetic as Y
from .queries import _CAPS_SQL, _CIRCUITS_SQL, _FIGURES_SQL, _LOOKUP, _TOKENS, _boxes, _caps, _circuits, _figures, _sq, query, table

# -- validation and cleaning

_PAPER = "CASE o_orderkey % 5 WHEN 0 THEN concat('24', CAST(10 + o_orderkey % 3 AS VARCHAR(2)), '.', CAST(10000 + o_custkey AS VARCHAR(9))) WHEN 1 THEN 'quant-ph/0001001' WHEN 2 THEN concat('2401.', CAST(o_custkey % 500 AS VARCHAR(9))) WHEN 3 THEN '' ELSE '2410.08073v2' END"


@query(f"""
WITH p AS (SELECT o_orderkey AS k, {_PAPER} AS paper FROM orders), f AS (SELECT paper, concat(CASE WHEN k % 7 = 0 THEN 'x' ELSE paper END, '_1_2.png') AS file FROM p WHERE paper <> '')
SELECT 'invalid_format' AS error_type, 'Invalid arXiv ID format: ' || paper AS message, count(*) AS n FROM f WHERE NOT regexp_full_match(paper, '\\d{{4}}\\.\\d{{4,5}}|[a-z-]+/\\d{{7}}') GROUP BY paper
UNION ALL SELECT 'mismatch', 'arXiv ID doesn''t match filename', count(*) FROM f WHERE NOT contains(file, paper)
""")
def id_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").selectExpr("o_orderkey AS k", f"{_PAPER} AS paper")
    file = F.concat(F.when(F.col("k") % 7 == 0, "x").otherwise(F.col("paper")), F.lit("_1_2.png"))
    found = rows.select(F.explode(Q.id_findings(F.col("paper"), file)).alias("f")).select("f.*")
    return found.groupBy("error_type", "message").agg(F.count("*").alias("n"))


_ENTRIES = (
    '{"arxiv_id": "2401.00001", "page_number": 3, "figure_number": 1, "quantum_gates": ["H"], "quantum_problem": "x", "descriptions": [], "text_positions": []}',
    '{"arxiv_id": null, "page_number": "3", "figure_number": true, "quantum_gates": {"H": 1}, "quantum_problem": "x", "descriptions": "d", "text_positions": [[1, 2]]}',
    '{"page_number": 1.5, "quantum_gates": [], "more": 1}',
    "{}",
)


@query(f"""
WITH e AS (SELECT CAST({Y._case('doc_id', _ENTRIES)} AS JSON) AS j FROM labels),
f AS (SELECT j, unnest(['arxiv_id', 'page_number', 'figure_number', 'quantum_gates', 'quantum_problem', 'descriptions', 'text_positions']) AS field, unnest(['str', 'int', 'int', 'list', 'str', 'list', 'list']) AS kind FROM e),
t AS (SELECT field, kind, json_type(j, '$.' || field) AS got FROM f)
SELECT field, CASE WHEN got IS NULL THEN 'missing_field' ELSE 'wrong_type' END AS error_type, count(*) AS n FROM t
WHERE got IS NULL OR NOT list_contains(CASE kind WHEN 'str' THEN ['VARCHAR'] WHEN 'int' THEN ['UBIGINT', 'BIGINT', 'BOOLEAN'] ELSE ['ARRAY'] END, got) GROUP BY ALL
""")
def schema_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "labels").selectExpr(f"{Y._case('doc_id', _ENTRIES)} AS json")
    return rows.select(F.explode(Q.schema_findings(F.col("json"))).alias("f")).groupBy("f.field", "f.error_type").agg(F.count("*").alias("n"))


@query(f"""
WITH {Y.cte('captions')}, {_CIRCUITS_SQL}, f AS (
    SELECT CAST(page_number < 1 AS INT) + CAST(len(descriptions) > 2 AS INT) AS e, CAST(page_number > 100 AS INT) + CAST(len(quantum_gates) = 0 AS INT) + CAST(len(descriptions) = 0 AS INT) AS w FROM circuits
)
SELECT CAST(sum(e) AS BIGINT) AS n_errors, CAST(sum(w) AS BIGINT) AS n_warnings, sum(e) = 0 AS is_valid FROM f
""")
def findings_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.summary(Q.entry_findings(_circuits(spark, sf_dir), gates()))


_TWO = [Y._case(f"(p_partkey * {k} + p_size)", tuple(_TOKENS)) for k in (1, 5)]


def _normal_sql(token: str) -> str:
    cleaned = f"trim(regexp_replace(regexp_replace(lower(trim({token})), '\\s+gate$', ''), '\\s+', ' ', 'g'))"
    return f"coalesce({_LOOKUP}[{cleaned}], {_LOOKUP}[translate({cleaned}, '-_', '  ')])"


@query(f"""
WITH t AS (SELECT p_partkey AS id, {_TWO[0]} AS a, {_TWO[1]} AS b FROM part)
SELECT id, array_to_string(list_sort(list_distinct(list_filter([{_normal_sql('a')}, {_normal_sql('b')}], lambda x: x IS NOT NULL))), ',') AS cleaned FROM t
""")
def gate_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "part").selectExpr("p_partkey AS id", f"array({_TWO[0]}, {_TWO[1]}) AS tokens")
    return rows.select("id", F.array_join(M.clean_terms(F.col("tokens"), gates()), ",").alias("cleaned"))


@query(f"""
WITH {Y.cte('captions')}, {_CIRCUITS_SQL}, c AS (SELECT ord, CASE WHEN ord % 4 = 0 THEN '  ' ELSE quantum_problem END AS topic, CASE WHEN ord % 5 = 0 THEN [' ', ''] ELSE descriptions || [substr(descriptions[1], 1, 9)] END AS d, 'caption ' || ord AS caption FROM circuits WHERE len(descriptions) > 0),
u AS (SELECT *, len(list_filter(d, lambda x: trim(x) <> '')) = 0 AS blank, list_distinct(d) AS dd FROM c)
SELECT ord, CASE WHEN trim(topic) = '' THEN 'not identify' ELSE topic END AS topic, CASE WHEN trim(topic) = '' THEN 'unknown' ELSE topic END AS exported,
    CASE WHEN blank THEN 1 ELSE len(list_filter(dd, lambda x: NOT list_bool_or(list_transform(dd, lambda o: contains(o, x) AND length(x) < length(o))))) END AS n_descriptions
FROM u
""")
def entries_normalised(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _circuits(spark, sf_dir).where(F.size("descriptions") > 0)
    shorter = F.concat("descriptions", F.array(F.substring(F.col("descriptions")[0], 1, 9)))
    rows = rows.withColumn("descriptions", F.when(F.col("ord") % 5 == 0, F.array(F.lit(" "), F.lit(""))).otherwise(shorter))
    rows = rows.withColumn("quantum_problem", F.when(F.col("ord") % 4 == 0, "  ").otherwise(F.col("quantum_problem"))).withColumn("figure_caption", F.concat(F.lit("caption "), F.col("ord").cast("string")))
    exported = F.col("quantum_problem").alias("exported")
    both = Q.normalise_entries(rows).select("ord", F.col("quantum_problem").alias("topic"), F.size("descriptions").cast("long").alias("n_descriptions"))
    return both.join(Q.export_rules(rows).select("ord", exported), "ord")


@query("""
WITH e AS (SELECT CAST(l_linenumber AS INT) AS epoch, CASE WHEN l_returnflag = 'A' THEN 'val' ELSE 'train' END AS phase, CAST(floor(l_extendedprice) AS BIGINT) AS loss_sum, l_suppkey % 4 AS correct, 4 AS rows FROM lineitem),
m AS (SELECT epoch, phase, sum(loss_sum) / sum(rows) AS loss, sum(correct) / sum(rows) AS accuracy FROM e GROUP BY ALL)
SELECT epoch, phase, round(loss, 6) AS loss, round(accuracy, 9) AS accuracy, epoch = (SELECT arg_max(epoch, accuracy) FROM m WHERE phase = 'val') AS is_best FROM m
""")
def training_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    epochs = table(spark, sf_dir, "lineitem").selectExpr("CAST(l_linenumber AS INT) AS epoch", "CASE WHEN l_returnflag = 'A' THEN 'val' ELSE 'train' END AS phase", "CAST(floor(l_extendedprice) AS BIGINT) AS loss_sum", "l_suppkey % 4 AS correct", "4 AS rows")
    return D.training_summary(epochs).select("epoch", "phase", F.round("loss", 6).alias("loss"), F.round("accuracy", 9).alias("accuracy"), "is_best")


# -- figures


@query(f"""
WITH {Y.cte('boxes')}, found AS (
    SELECT ord, 0 AS item_ord, x0, x0 + w AS x1, y0 + h AS y1 FROM boxes WHERE ord % 3 <> 0
    UNION ALL SELECT ord, 0, x0, x0 + w, y0 + h FROM boxes WHERE ord % 3 = 0
    UNION ALL SELECT ord, 1, x0, x0 + 1, y0 + h FROM boxes WHERE ord % 6 = 0
)
SELECT ord AS fig_ord, item_ord, x0, x1, y1 FROM found
""")
def drawing_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boxes of drawings with a rect, or else of their items; items without an area fall away."""
    b = F.col("bbox")
    items = F.array(b, G.box(b["x0"], b["y0"], F.when(F.col("fig_ord") % 6 == 0, b["x0"] + 1).otherwise(b["x0"]), b["y1"]))
    rows = _boxes(spark, sf_dir).select("fig_ord", F.when(F.col("fig_ord") % 3 != 0, b).alias("rect"), items.alias("items"))
    return FG.drawing_boxes(rows).select("fig_ord", "item_ord", "rect.x0", "rect.x1", "rect.y1")


@query(f"""
WITH {Y.cte('boxes')}, picked AS (
    SELECT *, row_number() OVER (PARTITION BY paper, page ORDER BY ord) AS n FROM boxes WHERE ord % 3 <> 1 AND (ord % 10) / 10.0 >= 0.5
), grown AS (SELECT *, greatest(0.0, x0 - 5) AS a, greatest(0.0, y0 - 5) AS b, least(500.0, x0 + w + 5) AS c, least(700.0, y0 + h + 5) AS d FROM picked)
SELECT CAST(paper AS VARCHAR) AS arxiv_id, page AS page_number, CAST(n AS INT) AS figure_index, CAST(c - a AS INT) AS width, CAST(d - b AS INT) AS height, round(a * 72 / 150, 6) AS x0, round(d * 72 / 150, 6) AS y1
FROM grown WHERE c - a BETWEEN 100 AND 3000 AND d - b BETWEEN 50 AND 2000
""")
def layout_figures(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _boxes(spark, sf_dir).select(
        F.col("arxiv_id").cast("string").alias("arxiv_id"), F.col("page_number").alias("page"), F.col("fig_ord").alias("blk_ord"),
        F.when(F.col("fig_ord") % 3 == 1, "Text").otherwise("Figure").alias("type"), ((F.col("fig_ord") % 10) / 10).alias("score"),
        F.col("bbox.x0").alias("x_1"), F.col("bbox.y0").alias("y_1"), F.col("bbox.x1").alias("x_2"), F.col("bbox.y1").alias("y_2"),
    )
    sizes = rows.select("arxiv_id", "page").distinct().withColumn("page_w", F.lit(500.0)).withColumn("page_h", F.lit(700.0))
    found = FG.layout_figures(rows, sizes)
    return found.select("arxiv_id", "page_number", "figure_index", "width", "height", F.round("bbox.x0", 6).alias("x0"), F.round("bbox.y1", 6).alias("y1"))


@query(f"""
WITH {Y.cte('boxes')}, images AS (SELECT paper, page, ord, ord % 40 AS xref, w * 4 AS width, h * 3 AS height FROM boxes),
places AS (SELECT paper, page, ord % 60 AS xref, arg_min(x0, ord) AS x0, arg_min(y0 + h, ord) AS y1 FROM boxes WHERE ord % 2 = 0 GROUP BY ALL)
SELECT i.ord AS img_ord, coalesce(p.x0, 0.0) AS x0, coalesce(p.y1, height) AS y1 FROM images i LEFT JOIN places p ON p.paper = i.paper AND p.page = i.page AND p.xref = i.xref
WHERE width BETWEEN 100 AND 3000 AND height BETWEEN 50 AND 2000 AND width / height BETWEEN 0.2 AND 8.0 AND width * height >= 10000
""")
def embedded_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _boxes(spark, sf_dir)
    keys = [F.col("arxiv_id").cast("string").alias("arxiv_id"), F.col("page_number").alias("page")]
    images = rows.select(*keys, F.col("fig_ord").alias("img_ord"), (F.col("fig_ord") % 40).alias("xref"), (F.col("w") * 4).alias("width"), (F.col("h") * 3).alias("height"))
    boxes = rows.where(F.col("fig_ord") % 2 == 0).select(*keys, (F.col("fig_ord") % 60).alias("xref"), F.col("fig_ord").alias("box_ord"), "bbox")
    return FG.embedded_images(images, boxes).select("img_ord", "bbox.x0", "bbox.y1")


@query(f"""
WITH {Y.cte('boxes')}, figs AS (SELECT * FROM boxes WHERE ord % 4 = 0), texts AS (SELECT *, CASE WHEN ord % 8 = 1 THEN 'Fig. ' || ord WHEN ord % 8 = 3 THEN 'figure ' || ord ELSE 'Text ' || ord END AS t FROM boxes WHERE ord % 4 <> 0),
below AS (
    SELECT f.paper, f.page, f.ord, list(t ORDER BY t.ord) AS found FROM figs f JOIN texts t ON t.paper = f.paper AND t.page = f.page
    WHERE starts_with(lower(t), 'fig') AND t.y0 - (f.y0 + f.h) > 0 AND t.y0 - (f.y0 + f.h) < 150 AND abs((t.x0 + t.x0 + t.w) / 2 - (f.x0 + f.x0 + f.w) / 2) < f.w * 0.8 GROUP BY ALL
), pages AS (SELECT paper, page, 'all of page ' || page AS c FROM boxes WHERE page % 2 = 0 GROUP BY ALL)
SELECT f.ord AS blk_ord, array_to_string(coalesce(found, CASE WHEN c IS NULL THEN [] ELSE [c] END), ';') AS candidates FROM figs f LEFT JOIN below b ON b.paper = f.paper AND b.page = f.page AND b.ord = f.ord LEFT JOIN pages p ON p.paper = f.paper AND p.page = f.page
""")
def layout_captions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Captions right below layout figures, else all captions of the page."""
    rows = _boxes(spark, sf_dir).select("arxiv_id", F.col("page_number").alias("page"), F.col("fig_ord").alias("blk_ord"), F.col("bbox").alias("box"))
    k = F.col("blk_ord")
    word = F.when(k % 8 == 1, "Fig. ").when(k % 8 == 3, "figure ").otherwise("Text ")
    texts = rows.where(k % 4 != 0).withColumn("text", F.concat(word, k.cast("string")))
    by_page = rows.where("page % 2 = 0").select("arxiv_id", "page").distinct().withColumn("captions", F.array(F.concat(F.lit("all of page "), F.col("page").cast("string"))))
    found = FG.caption_candidates(rows.where(k % 4 == 0), texts, by_page)
    return found.select("blk_ord", F.array_join("caption_candidates", ";").alias("candidates"))


@query(f"""
WITH RECURSIVE {Y.cte('boxes')}, b AS (SELECT *, x0 + w AS x1, y0 + h AS y1, w * h AS area, row_number() OVER (PARTITION BY paper, page ORDER BY w * h DESC, ord) AS r FROM boxes),
steps AS (
    SELECT paper, page, CAST(0 AS BIGINT) AS r, CAST([] AS STRUCT(ord BIGINT, x0 DOUBLE, y0 DOUBLE, x1 DOUBLE, y1 DOUBLE, area DOUBLE)[]) AS kept FROM (SELECT DISTINCT paper, page FROM b)
    UNION ALL
    SELECT s.paper, s.page, b.r, CASE WHEN coalesce(list_bool_or(list_transform(kept, lambda k:
            greatest(0.0, least(k.x1, b.x1) - greatest(k.x0, b.x0)) * greatest(0.0, least(k.y1, b.y1) - greatest(k.y0, b.y0)) > 0.5 * least(k.area, b.area))), false)
        THEN kept ELSE list_append(kept, {{'ord': b.ord, 'x0': b.x0, 'y0': b.y0, 'x1': b.x1, 'y1': b.y1, 'area': b.area}}) END
    FROM steps s JOIN b ON b.paper = s.paper AND b.page = s.page AND b.r = s.r + 1
)
SELECT paper AS arxiv_id, page AS page_number, unnest(list_transform(arg_max(kept, r), lambda k: k.ord)) AS fig_ord FROM steps GROUP BY paper, page
""")
def bbox_nms(spark: SparkSession, sf_dir: str) -> DataFrame:
    boxes = _boxes(spark, sf_dir).select("arxiv_id", "page_number", "fig_ord", "bbox")
    return FG.suppressed(boxes, ["arxiv_id", "page_number"], ["fig_ord"]).select("arxiv_id", "page_number", "fig_ord")


# -- texts of figures


@query(f"""
WITH {_CAPS_SQL} SELECT arxiv_id, page, md5(string_agg(caption_text, ';' ORDER BY cap_ord)) AS captions_md5, count(*) AS n FROM caps GROUP BY ALL
""")
def captions_by_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = L.captions_by_page(_caps(spark, sf_dir))
    return found.select("arxiv_id", "page", F.md5(F.array_join("captions", ";").cast("binary")).alias("captions_md5"), F.size("captions").cast("long").alias("n"))


@query("""
WITH p AS (SELECT CAST(page_id % 40 AS VARCHAR) AS arxiv_id, CAST(page_id // 40 AS INT) + 1 AS page, html AS text FROM pages),
w AS (SELECT o_orderkey AS k, CAST(o_custkey % 45 AS VARCHAR) AS arxiv_id, CAST(o_orderkey % 9 AS INT) - 1 AS page FROM orders)
SELECT k, w.page, md5(coalesce(text, '')) AS text_md5 FROM w LEFT JOIN p ON p.arxiv_id = w.arxiv_id AND p.page = greatest(w.page, 1)
""")
def page_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").selectExpr("CAST(page_id % 40 AS STRING) AS arxiv_id", "CAST(page_id DIV 40 AS INT) + 1 AS page", "html AS text")
    wanted = table(spark, sf_dir, "orders").selectExpr("o_orderkey AS k", "CAST(o_custkey % 45 AS STRING) AS arxiv_id", "CAST(o_orderkey % 9 AS INT) - 1 AS page")
    return L.page_text(pages, wanted).select("k", "page", F.md5(F.col("text").cast("binary")).alias("text_md5"))


_PARA = "concat(CASE o_orderkey % 3 WHEN 0 THEN 'see  Fig. ' WHEN 1 THEN ' Figure' ELSE 'no ' END, CAST(o_orderkey % 13 AS VARCHAR(9)), CASE WHEN o_orderkey % 4 = 0 THEN '' ELSE ' [PAGE 2] and what it shows' END)"


@query(f"""
WITH {_FIGURES_SQL}, {_CAPS_SQL},
paras AS (SELECT CAST(o_custkey % 100 AS VARCHAR) AS arxiv_id, o_orderkey AS para_ord, {_PARA} AS text FROM orders),
named AS (SELECT DISTINCT arxiv_id, para_ord, text, unnest(regexp_extract_all(text, '(?i)Fig(?:ure)?\\.?\\s*(\\d+)', 1)) AS number FROM paras),
cleaned AS (SELECT *, trim(regexp_replace(regexp_replace(text, '\\[PAGE \\d+\\]', '', 'g'), '\\s+', ' ', 'g')) AS d FROM named),
r AS (SELECT arxiv_id, number, list(d ORDER BY para_ord) FILTER (length(d) > 20) AS d, list(para_ord ORDER BY para_ord) FILTER (length(d) > 20) AS p, count(*) AS n, list(text ORDER BY para_ord) AS refs FROM cleaned GROUP BY ALL),
c AS (SELECT arxiv_id, figure_number, arg_min(caption_text, cap_ord) AS caption FROM caps GROUP BY ALL)
SELECT f.fig_ord, md5(array_to_string(CASE WHEN caption IS NULL THEN [] ELSE [caption] END || coalesce(r.d, []), ';')) AS descriptions_md5,
    CAST(CASE WHEN caption IS NULL THEN 0 ELSE 1 END + coalesce(len(r.p), 0) AS INT) AS n_positions,
    md5(array_to_string(CASE WHEN caption IS NULL THEN [] ELSE ['0123456789'] END || coalesce(r.refs, []), ';')) AS contexts_md5
FROM figs f LEFT JOIN c ON c.arxiv_id = f.arxiv_id AND c.figure_number = f.figure_index LEFT JOIN r ON r.arxiv_id = f.arxiv_id AND r.number = CAST(f.figure_index AS VARCHAR)
""")
def figure_descriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Captions and paragraphs as descriptions with positions, and as contexts around the caption."""
    paras = table(spark, sf_dir, "orders").selectExpr("CAST(o_custkey % 100 AS STRING) AS arxiv_id", "CAST(o_orderkey AS INT) AS para_ord", f"{_PARA} AS text", "1 AS page", "0 AS start", "1 AS end")
    caps = _caps(spark, sf_dir).withColumns({"start": F.lit(251), "end": F.lit(257)})
    texts = caps.select("arxiv_id").distinct().withColumn("full_text", F.lit("x" + "0123456789" + "y" * 600))
    # the caption stands at 251; 250 characters on either side of it, less the first
    around = F.transform("contexts", lambda t: F.when(F.length(t) > 400, F.substring(t, 1, 10)).otherwise(t))

    def digests(numbers: DataFrame) -> DataFrame:
        linked = L.link_paragraphs(L.link_captions(numbers, caps, use_page=False), paras)
        found = L.contexts(L.descriptions(linked), caps, texts)
        return found.select("arxiv_id", "figure_index", F.md5(F.array_join("descriptions", ";").cast("binary")).alias("descriptions_md5"), F.size("text_positions").alias("n_positions"), F.md5(F.array_join(around, ";").cast("binary")).alias("contexts_md5"))

    return L.of_numbers(_figures(spark, sf_dir), digests).select("fig_ord", "descriptions_md5", "n_positions", "contexts_md5")


# -- places


def _places(rows: str, keys: str, text: str, pattern: str) -> str:
    """Every match in the rows' texts: keys, i, hit, start_at."""
    size = lambda what: f"coalesce(list_sum(list_transform({what}, lambda x: length(x))), 0)"
    return f"""(SELECT {keys}, i, hits[i] AS hit, CAST({size('gaps[1 : i]')} + {size('hits[1 : i - 1]')} AS INT) AS start_at
        FROM (SELECT {keys}, string_split_regex({text}, {pattern}) AS gaps, regexp_extract_all({text}, {pattern}) AS hits FROM {rows}), unnest(range(1, len(hits) + 1)) AS t(i))"""


@query(f"""
WITH {Y.cte('captions')}, terms AS (SELECT unnest([{', '.join(_sq(c) for c, _ in gates().terms())}]) AS gate, unnest([{', '.join(_sq(t) for _, t in gates().terms())}]) AS term),
texts AS (SELECT * FROM (SELECT DISTINCT caption FROM captions) JOIN (SELECT gate, '(?i)\\b' || regexp_escape(term) || '(?:\\s+gate)?\\b' AS p FROM terms) ON regexp_matches(caption, p)),
found AS {_places('texts', 'caption, gate, p', 'caption', 'p')}
SELECT id, gate, start_at, start_at + CAST(length(hit) AS INT) AS end_at, hit AS matched FROM captions JOIN found USING (caption)
""")
def gate_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every match of every term, with offsets."""
    rows = Y.frame(spark, sf_dir, "captions").select("id", F.explode(M.locate_terms(F.col("caption"), gates())).alias("m"))
    return rows.select("id", F.col("m.canonical").alias("gate"), F.col("m.start").alias("start_at"), F.col("m.end").alias("end_at"), F.col("m.text").alias("matched"))


# -- captions and references of full texts

_FULL_SQL = f"""
{Y.cte('captions')}, page_texts AS (
    SELECT CAST(id // 100 AS VARCHAR) AS arxiv_id, CAST((id // 10) % 10 + 1 AS INT) AS page,
        string_agg('Fig. ' || id % 7 || ': ' || caption || chr(10) || 'As shown in Figure ' || id % 5 || ', ' || coalesce(c1, 'nothing') || chr(10), '' ORDER BY id) AS t
    FROM captions GROUP BY ALL
), full_texts AS (SELECT arxiv_id, string_agg('[PAGE ' || page || ']' || chr(10) || t, chr(10) ORDER BY page) AS full_text FROM page_texts GROUP BY arxiv_id),
marks AS (SELECT arxiv_id, start_at + length(hit) AS mark_end, CAST(regexp_extract(hit, '\\d+') AS INT) AS page FROM {_places('full_texts', 'arxiv_id', 'full_text', _sq('\\[PAGE \\d+\\]'))})"""


def _found_sql(patterns: tuple[str, ...]) -> str:
    """Matches of all patterns with the page of the last marker before them."""
    parts = " UNION ALL ".join(f"SELECT arxiv_id, {k} AS pattern, i, hit, start_at, start_at + CAST(length(hit) AS INT) AS end_at FROM {_places('full_texts', 'arxiv_id', 'full_text', _sq(p))}" for k, p in enumerate(patterns))
    return f"hits AS ({parts}), found AS (SELECT *, CAST(regexp_extract(hit, '\\d+') AS INT) AS figure_number, coalesce((SELECT arg_max(page, mark_end) FROM marks m WHERE m.arxiv_id = h.arxiv_id AND mark_end <= start_at + 50), 1) AS page FROM hits h)"


# a line goes on if the next one begins with no letter: the same as the pattern's look-ahead
_LINES = r"[.:]\s*[^\n]+(?:\n[^A-Za-z\n][^\n]*)*"


def _caption_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One text a hundred captions, pages of ten."""
    rows = Y.frame(spark, sf_dir, "captions")
    line = F.concat(F.lit("Fig. "), (F.col("id") % 7).cast("string"), F.lit(": "), "caption", F.lit("\nAs shown in Figure "), (F.col("id") % 5).cast("string"), F.lit(", "), F.coalesce("c1", F.lit("nothing")), F.lit("\n"))
    pages = rows.groupBy(F.floor(F.col("id") / 100).cast("string").alias("arxiv_id"), (F.floor(F.col("id") / 10) % 10 + 1).cast("int").alias("page"))
    # the texts are small beside the work on them, and grouping leaves them in as few tasks as their bytes need
    return Y.spread(L.full_text(pages.agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("id", line.alias("t")))), lambda r: r["t"]), "").alias("text"))))


@query(f"""
WITH {_FULL_SQL}, {_found_sql((r'(?i)Figure\s+(\d+)' + _LINES, r'(?i)Fig\.?\s+(\d+)' + _LINES))}
SELECT arxiv_id, figure_number, page, start_at, end_at, regexp_replace(hit, '^\\s+|\\s+$', '', 'g') AS caption_text
FROM (SELECT *, row_number() OVER (PARTITION BY arxiv_id, figure_number, page ORDER BY pattern, i) AS r FROM found) WHERE r = 1
""")
def caption_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.captions(_caption_texts(spark, sf_dir)).select("arxiv_id", "figure_number", "page", F.col("start").alias("start_at"), F.col("end").alias("end_at"), "caption_text")


@query(f"""
WITH {_FULL_SQL}, {_found_sql((r'(?:[Ss]ee\s+)?[Ff]ig(?:ure)?\.?\s*(\d+)', r'[Ff]ig(?:ure)?\.?\s*(\d+)\s+shows', r'[Aa]s\s+shown\s+in\s+[Ff]ig(?:ure)?\.?\s*(\d+)', r'[Ii]n\s+[Ff]ig(?:ure)?\.?\s*(\d+)', r'\([Ff]ig(?:ure)?\.?\s*(\d+)\)'))}
SELECT f.arxiv_id, figure_number, page, start_at, end_at,
    regexp_replace(regexp_replace(substr(full_text, greatest(0, start_at - 100) + 1, least(length(full_text), end_at + 200) - greatest(0, start_at - 100)), '^\\s+|\\s+$', '', 'g'), '\\s+', ' ', 'g') AS context
FROM found f JOIN full_texts t ON t.arxiv_id = f.arxiv_id
""")
def reference_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.references(_caption_texts(spark, sf_dir)).select("arxiv_id", "figure_number", "page", F.col("start").alias("start_at"), F.col("end").alias("end_at"), "context")
