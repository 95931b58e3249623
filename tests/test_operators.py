import numpy as np
import pytest
from pyspark.sql import functions as F

from foliant.operators import dataset as D
from foliant.operators import figures as FG
from foliant.operators import link as L
from foliant.operators import quality as Q
from foliant.schemas import BOX
from foliant.vocab import gates, topics


def boxes(spark, rows):
    return spark.createDataFrame([("p", 1, i, tuple(map(float, b)) if b else None) for i, b in enumerate(rows)], f"arxiv_id string, page_number int, fig_ord int, bbox {BOX}")


def test_suppression_keeps_the_larger(spark):
    df = boxes(spark, [(1, 1, 5, 5), (0, 0, 10, 10), (50, 50, 60, 60), None])
    kept = FG.suppressed(df, ["arxiv_id", "page_number"], ["fig_ord"])
    assert sorted(r["fig_ord"] for r in kept.collect()) == [1, 2, 3]


def plain_suppression(rows):
    area = lambda b: (b[2] - b[0]) * (b[3] - b[1])
    kept = []
    for i in sorted(range(len(rows)), key=lambda i: (-area(rows[i]), i)):
        b = rows[i]
        if not any(max(0, min(b[2], k[2]) - max(b[0], k[0])) * max(0, min(b[3], k[3]) - max(b[1], k[1])) / min(area(b), area(k)) > 0.5 for k in (rows[j] for j in kept)):
            kept.append(i)
    return sorted(kept)


def test_suppression_agrees_with_a_plain_version(spark):
    rng = np.random.default_rng(1)
    xy, wh = rng.integers(0, 80, (150, 2)), rng.integers(1, 40, (150, 2))
    rows = [tuple(map(float, r)) for r in np.hstack([xy, xy + wh])]
    kept = FG.suppressed(boxes(spark, rows), ["arxiv_id", "page_number"], ["fig_ord"])
    assert sorted(r["fig_ord"] for r in kept.collect()) == plain_suppression(rows)


def test_pages_stream_and_odd_boxes_overlap_as_columns_do(spark, sf_dir):
    """Pages that end anywhere in a batch or fill several, boxes with NaN, nulls and no area; a column more comes back by a join."""
    from foliant.functions import geometry as G
    from foliant.plans.queries import QUERIES

    rng = np.random.default_rng(5)
    odd = [None, float("nan"), float("inf")]

    def box(i):
        if i % 29 == 0:
            return None
        b = [float(v) for v in (*rng.integers(0, 60, 2), *rng.integers(30, 90, 2))]
        if i % 7 == 0:
            b[i % 4] = odd[i // 7 % 2]
        return tuple(b)

    rows = [(f"p{i % 3}" if i % 50 else None, int(rng.integers(0, 9)) ** 2 // 20, i, box(i)) for i in range(400)]
    df = spark.createDataFrame(rows, f"arxiv_id string, page_number int, fig_ord int, bbox {BOX}").repartition(3)
    found = df.dropna(subset=["arxiv_id"]).groupBy("arxiv_id", "page_number").agg(F.array_sort(F.collect_list(F.struct((-F.coalesce(G.area(F.col("bbox")), F.lit(0.0))).alias("a"), "fig_ord", "bbox"))).alias("all"))
    pairs = F.transform("all", lambda a: F.transform("all", lambda b: G.overlaps(a["bbox"], b["bbox"])))
    expected = []
    for r in found.select("all.fig_ord", pairs.alias("meets")).collect():
        kept = []
        for i in range(len(r["fig_ord"])):
            if not any(r["meets"][i][k] for k in kept):
                kept.append(i)
        expected += [r["fig_ord"][i] for i in kept]
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    try:
        for size in ("7", before):
            spark.conf.set(key, size)
            for frame in (df, df.withColumn("image", F.lit("x"))):
                kept = FG.suppressed(frame, ["arxiv_id", "page_number"], ["fig_ord"])
                assert kept.columns == frame.columns and sorted(r["fig_ord"] for r in kept.collect()) == sorted(expected)
    finally:
        spark.conf.set(key, before)
    assert 40 < len(expected) < 380
    plan = QUERIES["bbox_nms"](spark, sf_dir)._jdf.queryExecution().sparkPlan().toString()
    assert "Join" not in plan and "collect_list" not in plan


def test_clusters_are_connected_components():
    rng = np.random.default_rng(2)
    xy = rng.integers(0, 400, (120, 2))
    b = np.hstack([xy, xy + rng.integers(1, 20, (120, 2))]).astype(float)
    found = FG.cluster(b, 10.0)
    group = list(range(len(b)))
    for _ in b:
        for i in range(len(b)):
            for j in np.flatnonzero(FG._near(b[i], b, 10.0)):
                low = min(group[i], group[j])
                group[i] = group[j] = low
    assert len(found) == len({*group})


def test_merge_is_one_pass():
    assert FG.merge(np.array([[0, 0, 1, 1], [50, 0, 51, 1], [300, 0, 301, 1.0]]), 100.0).tolist() == [[0, 0, 51, 1], [300, 0, 301, 1]]
    assert FG.cluster(np.zeros((0, 4))).shape == (0, 4)


def test_regions_and_busy_pages(spark):
    rows = [("p", 1, i, (float(i * 10), 0.0, float(i * 10 + 5), 40.0), 600.0, 800.0) for i in range(10)] + [("p", 2, i, (0.0, 0.0, 5.0, 5.0), 600.0, 800.0) for i in range(30)]
    df = spark.createDataFrame(rows, f"arxiv_id string, page int, draw_ord int, rect {BOX}, page_w double, page_h double")
    found = FG.regions(df, most=20).collect()
    assert [(r["page"], r["region_ord"], tuple(r["bbox"])) for r in found] == [(1, 1, (0.0, 0.0, 105.0, 50.0))]


def test_boxes_of_drawings(spark):
    rows = [("p", 0, (0.0, 0.0, 1.0, 1.0), [(5.0, 5.0, 6.0, 6.0)]), ("p", 1, None, [(2.0, 2.0, 3.0, 3.0), (4.0, 4.0, 4.0, 9.0), None]), ("p", 2, None, None)]
    df = spark.createDataFrame(rows, f"arxiv_id string, draw_ord int, rect {BOX}, items array<{BOX}>")
    assert [(r["draw_ord"], tuple(r["rect"])) for r in FG.drawing_boxes(df).orderBy("draw_ord").collect()] == [(0, (0.0, 0.0, 1.0, 1.0)), (1, (2.0, 2.0, 3.0, 3.0))]


def test_comprehensive_extraction(spark):
    schema = f"arxiv_id string, fig_ord int, image binary, page_number int, bbox {BOX}"
    a = spark.createDataFrame([("p", 0, b"x", 1, (0.0, 50.0, 10.0, 60.0))], schema)
    b = spark.createDataFrame([("p", 0, b"x", 1, (90.0, 0.0, 95.0, 5.0)), ("p", 1, b"y", 1, (100.0, 0.0, 110.0, 10.0))], schema)
    rows = FG.comprehensive([a, b]).orderBy("figure_index").collect()
    assert [(bytes(r["image"]), r["figure_index"], r["method_ord"]) for r in rows] == [(b"y", 1, 1), (b"x", 2, 0)]


def test_layout_and_embedded(spark):
    layout = spark.createDataFrame([("p", 1, 0, "Figure", 0.9, 2.0, 2.0, 200.0, 100.0), ("p", 1, 1, "Figure", 0.9, 0.0, 0.0, 5.0, 5.0), ("p", 1, 2, "Figure", 0.4, 0.0, 0.0, 500.0, 500.0), ("p", 1, 3, "Figure", 0.5, 100.0, 300.0, 400.0, 500.0)], "arxiv_id string, page int, blk_ord int, type string, score double, x_1 double, y_1 double, x_2 double, y_2 double")
    sizes = spark.createDataFrame([("p", 1, 600.0, 800.0)], "arxiv_id string, page int, page_w double, page_h double")
    rows = FG.layout_figures(layout, sizes).orderBy("blk_ord").collect()
    assert [(r["figure_index"], r["width"], r["height"]) for r in rows] == [(1, 205, 105), (3, 310, 210)]
    images = spark.createDataFrame([("p", 1, 7, 200, 100), ("p", 1, 8, 200, 100), ("p", 1, 9, 90, 90)], "arxiv_id string, page int, xref int, width int, height int")
    places = spark.createDataFrame([("p", 1, 7, 0, (1.0, 1.0, 2.0, 2.0)), ("p", 1, 7, 1, (3.0, 3.0, 4.0, 4.0))], f"arxiv_id string, page int, xref int, box_ord int, bbox {BOX}")
    assert [tuple(r["bbox"]) for r in FG.embedded_images(images, places).orderBy("xref").collect()] == [(1.0, 1.0, 2.0, 2.0), (0.0, 0.0, 200.0, 100.0)]


def test_caption_candidates_fall_back_to_the_page(spark):
    schema = f"arxiv_id string, page int, blk_ord int, box {BOX}"
    figs = spark.createDataFrame([("p", 1, 0, (0.0, 0.0, 100.0, 100.0)), ("p", 2, 0, (0.0, 0.0, 100.0, 100.0))], schema)
    texts = spark.createDataFrame([("p", 1, 5, (0.0, 110.0, 100.0, 120.0), "Fig. 1 x"), ("p", 2, 5, (0.0, 110.0, 100.0, 120.0), "other")], schema + ", text string")
    page = spark.createDataFrame([("p", 1, ["a"]), ("p", 2, ["b", "c"])], "arxiv_id string, page int, captions array<string>")
    assert [r["caption_candidates"] for r in FG.caption_candidates(figs, texts, page).orderBy("page").collect()] == [["Fig. 1 x"], ["b", "c"]]


def test_filenames(spark):
    df = spark.createDataFrame([("p", 3, 1, None), ("p", 3, 0, None), ("p", 3, 0, 7)], "arxiv_id string, page_number int, figure_index int, number int")
    assert [r[0] for r in df.select(FG.filename(number="number")).collect()] == ["p_3_1.png", "p_3_.png", "p_3_7.png"]


def caption_rows(spark, rows):
    return spark.createDataFrame([("p", i, n, f"cap {i}", page, 10 * i, 10 * i + 5) for i, (n, page) in enumerate(rows)], "arxiv_id string, cap_ord int, figure_number int, caption_text string, page int, start int, end int")


def test_caption_priority(spark):
    caps = caption_rows(spark, [(1, 3), (2, 5)])
    figs = spark.createDataFrame([("p", 2, 3), ("p", 1, None), ("p", 9, 8)], "arxiv_id string, figure_index int, page_number int")
    by_page = {r["figure_index"]: r["caption_info"] for r in L.link_captions(figs, caps).collect()}
    assert by_page[2]["cap_ord"] == 0 and by_page[1]["cap_ord"] == 0 and by_page[9] is None
    any_page = {r["figure_index"]: r["caption_info"] for r in L.link_captions(figs, caps, use_page=False).collect()}
    assert any_page[2]["cap_ord"] == 1


def test_figure_texts(spark):
    pages = spark.createDataFrame([("p", 1, "Figure 1: A long caption of a circuit.\nSee Fig. 1 for the whole of the matter.\nFig. 12 is another."), ("p", 2, None)], "arxiv_id string, page int, text string")
    blocks = spark.createDataFrame([("p", 0, 1, "Figure 1: A long caption of a circuit."), ("p", 1, 1, " See Fig. 1 for the whole of the matter. "), ("p", 2, 1, "  "), ("p", 3, 1, "Fig. 12 is another.")], "arxiv_id string, block_ord int, page int, text string")
    figs = spark.createDataFrame([("p", 1, 1)], "arxiv_id string, figure_index int, page_number int")
    row = L.figure_texts(figs, pages, blocks).first()
    full = L.full_text(pages).first()["full_text"]
    assert full.startswith("[PAGE 1]\nFigure 1") and full.endswith("\n[PAGE 2]\n")
    assert row["descriptions"] == ["Figure 1: A long caption of a circuit.", "Figure 1: A long caption of a circuit.", "See Fig. 1 for the whole of the matter."]
    spans = [full[p["start"] : p["end"]] for p in row["text_positions"]]
    assert spans[2] == "See Fig. 1 for the whole of the matter."
    assert len(row["contexts"]) == 3 and row["contexts"][0].startswith("[PAGE 1]")
    assert [r["type"] for r in L.paragraphs(blocks, L.full_text(pages)).orderBy("para_ord").collect()] == ["caption", "paragraph", "caption"]


def test_page_text(spark):
    pages = spark.createDataFrame([("p", 1, "one")], "arxiv_id string, page int, text string")
    asked = spark.createDataFrame([("p", 0), ("p", 1), ("p", 9)], "arxiv_id string, page int")
    assert sorted((r["page"], r["text"]) for r in L.page_text(pages, asked).collect()) == [(0, "one"), (1, "one"), (9, "")]


def test_ordered_stop(spark):
    papers = spark.createDataFrame([(0, 4), (1, 8), (2, 5)], "paper_ord long, n_accepted long")
    rows = D.ordered_stop(papers, 10).orderBy("paper_ord").collect()
    assert [(r["visited"], r["collected"]) for r in rows] == [(True, 4), (True, 6), (False, None)]
    assert D.whole_paper_stop(papers.withColumnRenamed("n_accepted", "n_figures"), 5).count() == 2


def test_running_total_over_buckets(spark):
    df = spark.range(1000).withColumn("v", F.col("id") % 7)
    rows = D.running_total(df, "id", "v", "s", bucket=64).orderBy("id").collect()
    total = 0
    for r in rows:
        assert r["s"] == total
        total += r["v"]


def test_entry_fallbacks(spark):
    schema = "filename string, arxiv_id string, page_number int, figure_index int, caption string, contexts array<string>, descriptions array<string>, text_positions array<struct<start:int,end:int>>, score double, visual_gates array<string>, extraction_method string"
    df = spark.createDataFrame([("a", "p", 1, 1, "A CNOT", [], [], [], 0.9, ["H"], "m"), ("b", "p", 1, 2, "", None, [], [], 0.9, None, "m")], schema)
    a, b = D.entries(df, gates(), topics()).orderBy("filename").collect()
    assert (a["descriptions"], a["text_positions"], a["quantum_gates"]) == (["A CNOT"], [[0, 6]], ["CNOT", "H"])
    assert (b["descriptions"], b["text_positions"], b["quantum_gates"]) == ([], [[]], [])


CIRCUIT = "filename string, arxiv_id string, page_number int, figure_number int, quantum_gates array<string>, quantum_problem string, descriptions array<string>, text_positions array<array<int>>"


def test_statistics_of_nothing(spark):
    r = D.statistics(spark.createDataFrame([], CIRCUIT)).first()
    assert (r["total_circuits_found"], r["avg_gates_per_circuit"], r["gate_distribution"]) == (0, 0.0, {})


def test_ties_of_rankings_go_to_the_first(spark):
    df = spark.createDataFrame([(0, "CNOT"), (1, "Z"), (2, "Z"), (3, "CNOT")], "at int, gate string")
    assert [r["gate"] for r in D.top(D.distribution(df, "gate", "at"), 2).collect()] == ["CNOT", "Z"]


def test_training_summary(spark):
    df = spark.createDataFrame([(0, "val", 2.0, 5, 10), (1, "val", 1.0, 8, 10), (2, "val", 1.0, 8, 10)], "epoch int, phase string, loss_sum double, correct int, rows int")
    assert [r["epoch"] for r in D.training_summary(df).where("is_best").collect()] == [1]


@pytest.mark.parametrize("paper,kinds", [("2410.08073", []), ("2410.08073v2", ["invalid_format"]), ("quant-ph/0001001", ["mismatch"]), ("", []), (None, [])])
def test_ids(spark, paper, kinds):
    name = "2410.08073v2_1_1.png"
    r = spark.createDataFrame([(paper, name)], "p string, f string").select(Q.id_findings(F.col("p"), F.col("f")).alias("x")).first()["x"]
    assert [x["error_type"] for x in r] == kinds


@pytest.mark.parametrize("page,kinds", [(0, ["invalid_value"]), (1, []), (100, []), (101, ["suspicious_value"]), (None, ["invalid_value"])])
def test_pages(spark, page, kinds):
    r = spark.createDataFrame([(page,)], "p int").select(Q.page_findings(F.col("p")).alias("x")).first()["x"]
    assert [x["error_type"] for x in r] == kinds


def test_schema_findings(spark):
    good = '{"arxiv_id":"a","page_number":1,"figure_number":true,"quantum_gates":[],"quantum_problem":"","descriptions":["x"],"text_positions":[[1,2]]}'
    bad = '{"arxiv_id":null,"page_number":1.5,"quantum_gates":{},"quantum_problem":"","descriptions":["x"],"text_positions":[]}'
    df = spark.createDataFrame([(good,), (bad,)], "j string").select(Q.schema_findings(F.col("j")).alias("x"))
    found = [sorted((x["error_type"], x["field"]) for x in r["x"]) for r in df.collect()]
    assert found == [[], [("missing_field", "figure_number"), ("wrong_type", "arxiv_id"), ("wrong_type", "page_number"), ("wrong_type", "quantum_gates")]]


def test_missing_file_is_reported_twice(spark):
    entry = spark.createDataFrame([("2410.08073_1_1.png", "2410.08073", 1, 1, ["H"], "x", ["d"], [[0, 1]])], CIRCUIT)
    disk = spark.createDataFrame([("other.png",)], "filename string")
    rows = Q.validate(entry, disk, gates()).collect()
    assert sorted(r["error_type"] for r in rows) == ["missing_file", "missing_file", "orphan_file"]
    r = Q.summary(Q.validate(entry, disk, gates())).first()
    assert (r["is_valid"], r["n_errors"], r["n_warnings"]) == (False, 2, 1)


def test_positions_are_checked(spark):
    r = spark.createDataFrame([(["d"], [[1, 2], [3], [5, 4], []])], "d array<string>, p array<array<int>>").select(Q.description_findings(F.col("d"), F.col("p")).alias("x")).first()["x"]
    assert [x["error_type"] for x in r] == ["length_mismatch", "invalid_format", "invalid_range", "invalid_format"]


def test_cleaning(spark):
    df = spark.createDataFrame([("f", "p", 1, 1, ["hadamard", "foo"], None, ["a [PAGE 2] b", "c", "d"], [[1, 2]])], CIRCUIT)
    r = Q.clean(df, gates()).first()
    assert (r["quantum_gates"], r["quantum_problem"], r["descriptions"], r["text_positions"]) == (["H"], "Unspecified quantum circuit", ["a  b", "c", "d"], [[1, 2], [0, 0], [0, 0]])


def test_reduction_of_descriptions(spark):
    df = spark.createDataFrame([(["ab", "abc", "zz", "ab"],)], "d array<string>")
    assert df.select(Q.longest_kept(F.col("d"))).first()[0] == ["abc", "zz"]
    assert df.select(Q.longest_in_order(F.col("d"))).first()[0] == ["abc", "zz"]


def test_entry_normalisation(spark):
    df = spark.createDataFrame([([" ", ""], " ", "cap"), ([], "x", ""), (["b", "ab"], None, "cap")], "descriptions array<string>, quantum_problem string, figure_caption string")
    rows = Q.normalise_entries(df).collect()
    assert [(r["descriptions"], r["quantum_problem"]) for r in rows] == [(["cap"], "not identify"), ([], "x"), (["ab"], "not identify")]


def test_fix_cleans_only_what_has_errors(spark):
    good = spark.createDataFrame([("2410.08073_1_1.png", "2410.08073", 1, 1, ["hadamard"], "x", ["d"], [[0, 1]])], CIRCUIT)
    disk = good.select("filename")
    assert Q.fix(good, disk, gates())[0].first()["quantum_gates"] == ["hadamard"]
    bad = good.withColumn("text_positions", F.array().cast("array<array<int>>"))
    fixed, found = Q.fix(bad, disk, gates())
    assert fixed.first()["text_positions"] == [[0, 0]] and found.where("severity = 'error'").count() == 0


@pytest.mark.parametrize("name", ["figure_descriptions", "figure_paragraph_refs"])
def test_paragraphs_are_linked_once_a_number(spark, sf_dir, monkeypatch, name):
    from foliant.plans.queries import QUERIES

    link, seen = L.link_paragraphs, []
    monkeypatch.setattr(L, "link_paragraphs", lambda figures, paras: seen.append(figures) or link(figures, paras))
    found = QUERIES[name](spark, sf_dir)
    (numbers,) = seen
    assert numbers.count() == numbers.select("arxiv_id", "figure_index").distinct().count() < found.count()


def test_of_numbers_keeps_every_figure(spark):
    figs = spark.createDataFrame([(1, "a", 1), (2, "a", 1), (3, None, 1), (4, "a", None), (4, "a", None)], "fig_ord int, arxiv_id string, figure_index int")
    out = L.of_numbers(figs, lambda numbers: numbers.withColumn("n", F.concat_ws("/", "arxiv_id", "figure_index")))
    assert out.columns == ["fig_ord", "arxiv_id", "figure_index", "n"]
    assert sorted((r["fig_ord"], r["n"]) for r in out.collect()) == [(1, "a/1"), (2, "a/1"), (3, "1"), (4, "a"), (4, "a")]
