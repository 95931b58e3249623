import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from foliant.logs import Stage, percent
from foliant.operators import dataset as D
from foliant.operators import figures as FG
from foliant.plans import pipeline as P
from foliant.sources import datasets as DS
from foliant.sources import papers as PS
from foliant.streaming.export import collected, run_incrementally
from foliant.vocab import gates

CIRCUIT = "ord int, filename string, arxiv_id string, page_number int, figure_number int, quantum_gates array<string>, quantum_problem string, descriptions array<string>, text_positions array<array<int>>"


def test_paper_list(spark, tmp_path):
    path = tmp_path / "papers.txt"
    path.write_text("arXiv:2410.08073\n\n  2401.1v2\nlast")
    rows = PS.read_papers(spark, str(path)).orderBy("paper_ord").collect()
    assert [(r["arxiv_id"], r["full_id"], r["pdf_url"]) for r in rows] == [
        ("2410.08073", "arXiv:2410.08073", "https://arxiv.org/pdf/2410.08073.pdf"),
        ("2401.1v2", "2401.1v2", "https://arxiv.org/pdf/2401.1v2.pdf"),
        ("last", "last", "https://arxiv.org/pdf/last.pdf"),
    ]
    spark.dataSource.register(PS.PaperListSource)
    assert spark.read.format("paperlist").load(str(path)).count() == 4
    with pytest.raises(Exception, match="(?i)path"):
        PS.read_papers(spark, str(tmp_path / "none.txt")).count()


def test_metadata(spark):
    entry = '<feed><entry><id>http://arxiv.org/abs/2401.1v3</id>{}</entry></feed>'
    bodies = [entry.format('<link title="pdf" href="http://x/pdf/1"/>'), entry.format(""), "<feed></feed>"]
    df = spark.createDataFrame(list(enumerate(bodies)), "i int, body string")
    assert [r["url"] for r in PS.metadata_url(df).orderBy("i").collect()] == ["http://x/pdf/1", "https://arxiv.org/pdf/2401.1.pdf", None]


@pytest.mark.parametrize("status,kind,attempt,want", [(200, "application/pdf", 1, "done"), (404, None, 1, "failed"), (500, None, 1, "retry"), (200, "text/html", 2, "retry"), (None, None, 1, "back_off"), (None, None, 3, "failed"), (500, None, 3, "failed")])
def test_decisions(spark, status, kind, attempt, want):
    df = spark.createDataFrame([(status, kind, attempt)], "s int, k string, a int")
    assert df.select(PS.next_action(F.col("s"), F.col("k"), F.col("a"))).first()[0] == want


def test_rate_limit():
    now, slept = [0.0], []
    limit = PS.RateLimit(3.0, lambda: now[0], lambda s: (slept.append(s), now.__setitem__(0, now[0] + s)))
    limit.wait()
    now[0] = 1.0
    limit.wait()
    now[0] = 10.0
    limit.wait()
    assert slept == [2.0] and PS.back_off(2) == 12.0


def test_download(spark):
    def fetch(url):
        if "bad" in url:
            return 404, "text/html", b""
        if "odd" in url:
            return 200, "text/html", b""
        if "boom" in url:
            raise OSError("no route")
        return 200, "application/pdf", b"%PDF"

    papers = spark.createDataFrame([(p, f"u/{p}") for p in ("good", "bad", "odd", "boom", "old")], "arxiv_id string, pdf_url string")
    cached = spark.createDataFrame([("old", b"x")], "arxiv_id string, content binary")
    rows = {r["arxiv_id"]: r for r in PS.download(papers, fetch, delay=0.0, cached=cached).collect()}
    assert {k: r["status"] for k, r in rows.items()} == {"good": "processed", "bad": "failed", "odd": "failed", "boom": "failed", "old": "processed"}
    assert rows["boom"]["error_message"] == "no route" and bytes(rows["old"]["content"]) == b"x"


def test_parsing_and_blocks(spark, tmp_path):
    (tmp_path / "a.pdf").write_bytes(b"one|two")
    (tmp_path / "b.pdf").write_bytes(b"broken")

    def parse(content):
        if b"|" not in content:
            raise ValueError("cannot parse")
        return content.decode().split("|")

    rows = PS.parse_pages(PS.read_binary(spark, str(tmp_path)), parse).orderBy("arxiv_id", "page").collect()
    assert [(r["arxiv_id"], r["page"], r["text"], r["error"]) for r in rows] == [("a", 1, "one", None), ("a", 2, "two", None), ("b", None, None, "cannot parse")]
    spans = spark.createDataFrame([("a", 1, 0, 0, 1, 0, "lo"), ("a", 1, 0, 0, 0, 0, " hel"), ("a", 1, 0, 1, 0, 0, "x "), ("a", 1, 1, 0, 0, 1, "image")], "arxiv_id string, page int, block int, line int, span int, kind int, text string")
    assert [r["text"] for r in PS.text_blocks(spans).collect()] == ["hello\nx"]


def test_labelled_images(spark, tmp_path):
    for label in ("b", "a"):
        (tmp_path / label).mkdir()
        (tmp_path / label / "1.png").write_bytes(b"i")
    assert sorted((r["label"], r["target"]) for r in PS.labelled_images(spark, str(tmp_path)).collect()) == [("a", 0), ("b", 1)]


def circuits(spark):
    rows = [(2, "f2.png", "p", 1, 2, ["H"], "", ["äb", "äbc"], [[0, 1], []]), (1, "f1.png", "p", 1, 1, [], "x", [], []), (3, "f2.png", "q", 1, 2, ["X", "H"], "y", ["n"], [[5, 6]])]
    return spark.createDataFrame(rows, CIRCUIT)


def test_dataset_round_trip(spark, tmp_path):
    DS.write_dataset(circuits(spark), str(tmp_path / "d.json"))
    text = "".join(p.read_text() for p in (tmp_path / "d.json").glob("part-*"))
    data = json.loads(text)
    assert list(data) == ["f1.png", "f2.png"] and data["f2.png"]["arxiv_id"] == "q" and list(data["f1.png"]) == ["arxiv_id", "page_number", "figure_number", "quantum_gates", "quantum_problem", "descriptions", "text_positions"]
    back = {r["filename"]: r for r in DS.read_dataset(spark, str(tmp_path / "d.json")).collect()}
    assert back["f2.png"]["text_positions"] == [[5, 6]] and json.loads(back["f1.png"]["json"]) == data["f1.png"]
    assert {r["filename"]: json.loads(r["json"]) for r in DS.entry_lines(circuits(spark)).collect()} == data


def test_no_row_holds_the_dataset(spark, tmp_path, sf_dir):
    """A line each entry, in the order of the one text; and the query takes no row for all."""
    from foliant.plans.queries import json_export_roundtrip

    more = [(k, f'f{k % 40}"é.png', "p", k, None, ["H"], "", [], []) for k in range(100, 0, -1)]
    for rows in (circuits(spark), spark.createDataFrame(more, CIRCUIT), circuits(spark).limit(0)):
        path = tmp_path / str(rows.count())
        DS.write_dataset(rows, str(path))
        (text,) = (p.read_text() for p in path.glob("part-*"))
        whole = DS.dataset_json(rows).first()["value"]
        assert text.replace("\n", "") == whole and len(text.splitlines()) == len(json.loads(whole)) + 2
        assert [r["filename"] for r in DS.read_dataset(spark, str(path)).collect()] == list(json.loads(whole))
    plan = json_export_roundtrip(spark, sf_dir)._jdf.queryExecution().sparkPlan().toString()
    assert "keys=[]" not in plan and "key=[]" not in plan and "from_json" in plan


def test_counts_file(spark, tmp_path):
    df = spark.createDataFrame([(1, "b", "processed", None), (0, "a", "not_visited", 3), (2, "c", "processed", 4)], "paper_ord long, full_id string, status string, image_count int")
    DS.write_counts(df, str(tmp_path / "c"))
    assert next((tmp_path / "c").glob("part-*")).read_text() == "arxiv_id,image_count\na,\nb,0\nc,4\n"


def test_export_and_report(spark, tmp_path):
    stats = D.statistics(circuits(spark), 3, 9)
    paths = DS.export(circuits(spark), stats, str(tmp_path))
    assert set(paths) == {"dataset", "statistics", "report"}
    report = DS.report(circuits(spark), stats, generated="now").first()["value"].split("\n")
    assert report[1:9] == ["QUANTUM CIRCUIT DATASET SUMMARY REPORT", "Exam ID: 37", "Generated: now", "=" * 60, "", "Total Images: 3", "Papers with Circuits: 2", "Average Gates per Circuit: 1.00"]
    assert report[11:14] == ["Gate Distribution:", "  H: 2", "  X: 1"]
    assert "Filename: f1.png" in report and report[-1] == "  Problem: y"
    back = DS.read_statistics(spark, paths["statistics"]).first()
    assert back["gate_distribution"] == {"H": 2, "X": 1} and back["total_images_extracted"] == 9
    data = json.loads("".join(p.read_text() for p in (tmp_path / "dataset_37.json").glob("part-*")))
    assert data["f1.png"]["quantum_problem"] == "x"


def test_image_sinks(spark, tmp_path):
    df = spark.createDataFrame([("a.png", b"1", 0.9), ("b.png", b"2", 0.1), ("c.png", b"3", None)], "filename string, image binary, score double")
    DS.write_images(df, str(tmp_path / "images"))
    assert (tmp_path / "images" / "b.png").read_bytes() == b"2"
    DS.write_images(df, f"file://{tmp_path}/split", DS.decision())
    assert sorted(str(p.relative_to(tmp_path / "split")) for p in (tmp_path / "split").rglob("*.png")) == ["accepted/a.png", "rejected/b.png", "rejected/c.png"]
    DS.write_by_decision(df, str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).groupBy("decision").count().orderBy("decision").collect()[0]["count"] == 1


def test_incremental_export_is_idempotent(spark, tmp_path):
    source, out, check = (str(tmp_path / n) for n in ("in", "out", "check"))
    first = circuits(spark).where("ord < 3")
    first.write.parquet(source)
    stream = lambda: spark.readStream.schema(CIRCUIT).parquet(source)
    run_incrementally(stream(), out, check).awaitTermination()
    circuits(spark).where("ord = 3").write.mode("append").parquet(source)
    for _ in range(2):
        run_incrementally(stream(), out, check).awaitTermination()
    rows = {r["filename"]: r["arxiv_id"] for r in collected(spark, out, CIRCUIT + ", epoch int").collect()}
    assert rows == {"f1.png": "p", "f2.png": "q"}


def inputs(spark):
    papers = spark.createDataFrame([(i, f"p{i}", f"p{i}", "failed" if i == 2 else "not_visited", None) for i in range(6)], "paper_ord long, arxiv_id string, full_id string, status string, image_count int")
    figures = spark.createDataFrame([(f"p{i}", 1, k, "vector_render") for i in range(6) if i != 2 for k in (1, 2, 3)], "arxiv_id string, page_number int, figure_index int, extraction_method string")
    pages = spark.createDataFrame([(f"p{i}", 1, "Figure 1: A CNOT gate circuit.\nFigure 2: Another.") for i in range(6)], "arxiv_id string, page int, text string")
    blocks = spark.createDataFrame([(f"p{i}", 0, 1, "Figure 1: A CNOT gate circuit.") for i in range(6)], "arxiv_id string, block_ord int, page int, text string")

    def score(df):
        def run(frames):
            for pdf in frames:
                yield pdf.assign(circuit_prob=[0.9 if "_3.png" not in f else 0.1 for f in pdf["filename"]])

        return df.mapInPandas(run, StructType([*df.schema, StructField("circuit_prob", DoubleType())]))

    return P.Inputs(papers, figures, pages, blocks, score)


def test_collection_stops_at_the_target(spark):
    circuits_, papers = P.collect_circuits(inputs(spark), target=5, wave=1)
    rows = circuits_.orderBy("ord").collect()
    assert [r["filename"] for r in rows] == ["p0_1_1.png", "p0_1_2.png", "p1_1_1.png", "p1_1_2.png", "p3_1_1.png"]
    assert "CNOT" in rows[0]["quantum_gates"]
    state = {r["arxiv_id"]: (r["status"], r["image_count"]) for r in papers.collect()}
    assert state["p3"] == ("processed", 1) and state["p2"] == ("failed", 0) and state["p4"] == ("not_visited", None)


def test_whole_run_and_validation(spark, tmp_path, capsys):
    i = inputs(spark)
    disk = spark.createDataFrame([("p0_1_1.png",)], "filename string")
    paths = P.run(i, disk, str(tmp_path), target=3)
    assert DS.read_statistics(spark, paths["statistics"]).first()["total_circuits_found"] == 3
    assert P.run_validation(spark, paths["dataset"], disk) is False
    assert "errors:" in capsys.readouterr().out
    assert P.run_phase_one(i, 4).count() == 6


def test_command_line(spark, tmp_path, capsys):
    i = inputs(spark)
    for name in ("papers", "figures", "pages", "blocks"):
        getattr(i, name).write.parquet(str(tmp_path / "t" / f"{name}.parquet"))
    i.score(i.figures.withColumn("filename", FG.filename())).select("filename", "circuit_prob").write.parquet(str(tmp_path / "t" / "scores.parquet"))
    (tmp_path / "images").mkdir()
    (tmp_path / "images" / "p0_1_1.png").write_bytes(b"x")
    where = ["--tables", str(tmp_path / "t"), "--out", str(tmp_path / "out")]
    assert P.main([*where, "--images", str(tmp_path / "images"), "--target", "3"]) == 0
    assert "dataset:" in capsys.readouterr().out
    assert P.main(["--validate-only", str(tmp_path / "out" / "dataset_37.json"), "--images", str(tmp_path / "images")]) == 1
    assert P.main([*where, "--phase-one", "4"]) == 0
    assert spark.read.parquet(str(tmp_path / "out" / "figures")).count() == 6
    with pytest.raises(SystemExit):
        P.main(["--target", "3"])


def test_stage_timer(caplog):
    with Stage("s") as s:
        s.progress(1, 4)
    assert s.seconds >= 0 and percent(1, 4) == 25.0 and percent(1, 0) == 0.0
    with pytest.raises(ValueError), Stage("s"):
        raise ValueError("x")


def test_vocabulary_frame(spark):
    assert gates().frame(spark).count() == 168
