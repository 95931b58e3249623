import re

import pytest
from pyspark.sql import functions as F

from foliant.functions import arrays as AR
from foliant.functions import geometry as G
from foliant.functions import match as M
from foliant.functions import score as S
from foliant.functions import text as T
from foliant.functions import topics as TP
from foliant.vocab import Vocabulary, gates, keywords, topics


def one(spark, expr, **values):
    row = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} {kind}" for k, kind in KINDS.items() if k in values)) if values else spark.range(1)
    return row.select(expr.alias("v")).first()["v"]


KINDS = {"t": "string", "a": "array<string>", "b": "array<string>"}


def text(spark, fn, value):
    return one(spark, fn(F.col("t")), t=value)


GATE_CASES = [
    ("Apply a Hadamard gate followed by a CNOT gate", ["CNOT", "H"], 0.50),
    ("The circuit uses X, Y, and Z Pauli gates", ["X", "Y", "Z"], 0.55),
    ("Controlled-Z and SWAP operations are applied", ["CZ", "SWAP", "Z"], 0.55),
    ("Toffoli gate for the AND operation", ["Toffoli"], 0.35),
    ("RX(π/2) and RZ(θ) rotations", ["RX", "RZ"], 0.50),
]


@pytest.mark.parametrize("caption,names,confidence", GATE_CASES)
def test_gates_and_confidence(spark, caption, names, confidence):
    sources = lambda c: M.find_in_sources(c, F.array().cast("array<string>"), F.lit(""), gates())
    assert text(spark, lambda c: M.find_terms(c, gates()), caption) == names
    assert text(spark, lambda c: M.confidence(sources(c)), caption) == pytest.approx(confidence)
    assert sorted(text(spark, lambda c: M.counted(sources(c)), caption)) == names


def test_unicode_boundaries(spark):
    assert text(spark, lambda c: M.find_terms(c, gates()), "éx") == []
    assert text(spark, lambda c: M.find_terms(c, gates()), "a σx b") == ["X"]
    assert text(spark, lambda c: M.find_terms(c, gates()), None) == []


@pytest.mark.parametrize("term,name", [("hadamard gate", "H"), ("CX", "CNOT"), ("controlled_z", "CZ"), ("feynman gate", None), ("foo", None), (" Swap   Gate ", "SWAP"), (None, None)])
def test_normalise(spark, term, name):
    assert text(spark, lambda c: M.normalise_term(c, gates()), term) == name


def test_clean_terms(spark):
    assert one(spark, M.clean_terms(F.col("a"), gates()), a=["H", "hadamard", "CNOT", "CX", "nothing"]) == ["CNOT", "H"]
    assert one(spark, M.clean_terms(F.col("a"), gates()), a=[]) == []


def test_locate_terms_agrees_with_a_plain_search(spark):
    sample = "A CNOT gate, then controlled-z; hadamard Ünï x"
    small = Vocabulary(gates().entries[:4] + gates().entries[12:14], gates().suffix)
    found = [(r["start"], r["end"], r["text"], r["canonical"]) for r in text(spark, lambda c: M.locate_terms(c, small), sample)]
    want = []
    for i, (c, t) in enumerate(small.terms()):
        want += [(m.start(), i, m.end(), m[0], c) for m in re.finditer(small.pattern(t), sample, re.IGNORECASE)]
    assert found == [(a, e, x, c) for a, _, e, x, c in sorted(want)]


def test_vocabulary_grows_and_loads(tmp_path):
    v = gates().extended("FSIM", ["fsim gate"])
    assert v.lookup()["fsim gate"] == "FSIM" and len(v.names()) == 33
    assert v.extended("FSIM", ["other"]).entries[-1] == ("FSIM", ("other",))
    path = tmp_path / "v.json"
    path.write_text('{"A": ["b"]}')
    assert Vocabulary.load(str(path)).terms() == [("A", "A"), ("A", "b")]
    assert topics().lookup()["period finding"] == "Shor's Algorithm"


DETECTIONS = [
    ("Figure 1: Quantum circuit implementing Grover's search algorithm", "The circuit applies Hadamard gates to initialize the qubits", 0.566667, 0.65, 0.616667, 0.816667, 0.696667, True),
    ("Figure 2: Experimental results showing error rates", "The plot shows the fidelity versus circuit depth", 0.0, -0.5, -0.30, 0.266667, -0.073333, False),
    ("Figure 3: CNOT gate sequence for Bell state preparation", "We apply a Hadamard gate followed by a CNOT", 0.766667, 1.0, 0.906667, 0.85, 0.884, True),
]


@pytest.mark.parametrize("caption,context,keyword,pattern,cap,ctx,total,is_circuit", DETECTIONS)
def test_detection(spark, caption, context, keyword, pattern, cap, ctx, total, is_circuit):
    row = spark.createDataFrame([(caption, [context])], "c string, x array<string>").select(S.caption_analysis(F.col("c"), keywords()).alias("a"), S.detection(F.col("c"), F.col("x"), keywords()).alias("d")).first()
    assert row["a"]["keyword_score"] == pytest.approx(keyword, abs=1e-6)
    assert row["a"]["pattern_score"] == pytest.approx(pattern, abs=1e-6)
    assert row["d"]["caption_score"] == pytest.approx(cap, abs=1e-6)
    assert row["d"]["context_score"] == pytest.approx(ctx, abs=1e-6)
    assert row["d"]["confidence"] == pytest.approx(total, abs=1e-6)
    assert row["d"]["is_circuit"] is is_circuit


def test_detection_of_nothing(spark):
    row = spark.createDataFrame([("", []), (None, None)], "c string, x array<string>").select(S.detection(F.col("c"), F.col("x"), keywords()).alias("d")).collect()
    assert [r["d"]["confidence"] for r in row] == [0.0, 0.0]


TOPICS = [
    ("Quantum circuit for Shor's factoring algorithm", ["modular exponentiation", "period finding"], "Shor's Algorithm", 0.9, "caption", ["Modular Exponentiation", "Simon's Algorithm", "Shor's Algorithm"]),
    ("VQE ansatz circuit for molecular simulation", ["variational eigensolver", "ground state energy"], "Variational Quantum Eigensolver (VQE)", 0.9, "caption", ["Variational ansatz", "Variational Quantum Eigensolver (VQE)"]),
    ("Bell state preparation circuit", ["entanglement generation"], "State Preparation", 0.9, "caption", ["State preparation circuit"]),
    ("General quantum circuit implementation", ["quantum gates are applied"], "Unspecified quantum circuit", 0.1, "fallback", []),
    ("", ["an entangled pair"], "Bell State Preparation", 0.7, "inference", []),
]


@pytest.mark.parametrize("caption,contexts,name,confidence,source,others", TOPICS)
def test_topics(spark, caption, contexts, name, confidence, source, others):
    r = spark.createDataFrame([(caption, contexts)], "c string, x array<string>").select(TP.identify_topic(F.col("c"), F.col("x"), topics()).alias("t")).first()["t"]
    assert (r["algorithm"], r["confidence"], r["source"], r["alternatives"]) == (name, confidence, source, others)


def test_section_title_comes_first(spark):
    r = spark.createDataFrame([("a swap test", "Boson Sampling")], "c string, s string").select(TP.identify_topic(F.col("c"), F.lit(None), topics(), F.col("s")).alias("t")).first()["t"]
    assert (r["algorithm"], r["confidence"]) == ("Boson Sampling", 1.0)


def test_cleaning_orders(spark):
    assert text(spark, T.clean_description, "a [PAGE 2] b") == "a b"
    assert text(spark, T.clean_text, "a [PAGE 2] b") == "a  b"
    assert text(spark, T.clean_text, None) == ""


@pytest.mark.parametrize("body,kind", [("Figure 3: …", "caption"), ("1. Introduction", "section_title"), ("Abstract—We " + "x" * 100, "abstract"), ("other words", "paragraph")])
def test_paragraph_types(spark, body, kind):
    assert text(spark, T.paragraph_type, body) == kind


def test_spans_are_code_point_offsets(spark):
    sample = "é Fig. 1 ü 😀 Fig. 22\nFig. 3"
    found = text(spark, lambda c: T.spans(c, r"Fig\. \d+"), sample)
    assert [(r["start"], r["end"], r["text"]) for r in found] == [(m.start(), m.end(), m[0]) for m in re.finditer(r"Fig\. \d+", sample)]
    assert text(spark, lambda c: T.spans(c, "x"), None) == []


def test_pages_and_sections(spark):
    sample = "[PAGE 1]\n" + "a" * 100 + "\n[PAGE 2]\n1. Background here\n" + "b" * 100
    at = lambda p: text(spark, lambda c: T.page_at(T.page_markers(c), F.lit(p)), sample)
    assert [at(0), at(20), at(67), at(68), at(150)] == [1, 1, 1, 2, 2]
    assert text(spark, lambda c: T.page_at(T.page_markers(c), F.lit(5)), "no marker") == 1
    assert [r["title"] for r in text(spark, T.sections, sample)] == ["1. Background here"]
    section = lambda p: text(spark, lambda c: T.section_at(T.sections(c), F.lit(p)), sample)
    assert section(0) is None and section(130) == "1. Background here"


def test_captions_continue_only_on_lines_that_begin_without_a_letter(spark):
    sample = "[PAGE 1]\nFig. 2: first line\n(a) goes on\nnot this\nFIGURE 2. again\n[PAGE 2]\n" + " " * 60 + "\nfigure 2: other page"
    found = [(r["figure_number"], r["caption_text"], r["page"]) for r in text(spark, T.captions, sample)]
    assert found[0][0] == 2 and len({(n, p) for n, _, p in found}) == len(found)
    assert (2, "Fig. 2: first line\n(a) goes on", 1) in found or (2, "FIGURE 2. again", 1) in found


def test_references_count_for_each_pattern(spark):
    found = text(spark, T.references, "As shown in Fig. 3 shows it")
    assert [r["figure_number"] for r in found] == [3, 3, 3, 3]


def plain_page(text, at):
    pages = [int(m[1]) for m in re.finditer(r"\[PAGE (\d+)\]", text[: at + 50])]
    return pages[-1] if pages else 1


def test_captions_and_references_agree_with_a_plain_search(spark, sf_dir):
    from foliant.plans import queries as Q

    texts = {r["arxiv_id"]: r["full_text"] for r in Q._caption_texts(spark, sf_dir).collect()}
    captions, references = [], []
    for paper, text in texts.items():
        seen = set()
        for p in T.CAPTIONS:
            for m in re.finditer(p.removeprefix("(?iuU)"), text, re.IGNORECASE | re.MULTILINE):
                key = (int(m[1]), plain_page(text, m.start()))
                if key not in seen:
                    seen.add(key)
                    captions.append((paper, *key, m.start(), m.end(), m[0].strip()))
        for p in T.REFERENCES:
            for m in re.finditer(p.removeprefix("(?U)"), text):
                context = re.sub(r"\s+", " ", text[max(0, m.start() - 100) : m.end() + 200].strip())
                references.append((paper, int(m[1]), plain_page(text, m.start()), m.start(), m.end(), context))
    assert len(captions) > 5 and len(references) > 50
    assert sorted(tuple(r) for r in Q.caption_extract(spark, sf_dir).collect()) == sorted(captions)
    assert sorted(tuple(r) for r in Q.reference_extract(spark, sf_dir).collect()) == sorted(references)


def test_find(spark):
    assert text(spark, lambda c: T.find(c, F.lit("cd")), "abcd") == (2, 4)
    assert text(spark, lambda c: T.find(c, F.lit("x")), "abcd") is None


def test_ocr_tokens(spark):
    assert text(spark, T.ocr_tokens, " I | -- 1. H  CX ") == ["H", "CX"]


@pytest.mark.parametrize("w,h,ok", [(99, 50, False), (100, 50, True), (3000, 2000, True), (3001, 50, False)])
def test_sizes(spark, w, h, ok):
    assert one(spark, G.size_ok(F.lit(w), F.lit(h))) is ok


def test_shapes(spark):
    assert one(spark, G.aspect_ok(F.lit(10), F.lit(0))) is True
    assert one(spark, G.region_aspect_ok(F.lit(10.0), F.lit(0.0))) is False
    assert one(spark, G.area_ok(F.lit(100), F.lit(100))) is True


def box(*c):
    return G.box(*(F.lit(float(x)) for x in c))


def test_overlap_must_exceed_half(spark):
    assert one(spark, G.overlaps(box(0, 0, 10, 10), box(5, 0, 15, 10))) is False
    assert one(spark, G.overlaps(box(0, 0, 10, 10), box(4, 0, 14, 10))) is True
    assert one(spark, G.overlaps(box(0, 0, 10, 10), F.lit(None).cast("struct<x0:double,y0:double,x1:double,y1:double>"))) is False


def test_caption_below(spark):
    assert one(spark, G.caption_below(box(0, 0, 100, 100), box(0, 110, 100, 120))) is True
    assert one(spark, G.caption_below(box(0, 0, 100, 100), box(0, 260, 100, 270))) is False
    assert one(spark, G.caption_below(box(0, 0, 100, 100), box(200, 110, 300, 120))) is False


@pytest.mark.parametrize("caption", ["Circuit diagram of a Hadamard gate, then a CNOT gate sequence", "Error rate versus depth", "quantum circuit that performs a controlled swap on qubit 3", ""])
def test_evidence_of_captions(spark, caption):
    k, low = keywords(), caption.lower()
    gates_ = [g for g in k.entities if re.search(rf"\b{re.escape(g)}\b", low)][:3]
    want = [f"primary:{p}" for p in k.primary if p in low] + [f"gate:{g}" for g in gates_]
    want += [f"pattern:{p[:30]}..." for p in S.FOR if re.search(p, low)] + [f"negative:{p[:20]}..." for p in S.AGAINST if re.search(p, low)]
    boosting = sum(b in low for b in S.BOOSTING)
    want += [f"gate+circuit:{boosting}"] if boosting and "circuit" in low else []
    assert spark.createDataFrame([(caption,)], "c string").select(S.caption_analysis(F.col("c"), k).alias("a")).first()["a"]["evidence"] == want


def test_evidence_of_topics(spark):
    r = spark.createDataFrame([("VQE and QAOA", ["a swap test", "nothing"]), ("a bell pair", []), ("", None)], "c string, x array<string>").select(TP.identify_topic(F.col("c"), F.col("x"), topics()).alias("t")).collect()
    assert r[0]["t"]["evidence"] == ["Caption: VQE and QAOA"] * 2 + ["Context: a swap test..."]
    assert r[1]["t"]["evidence"] == ["Inferred from text patterns: Bell State Preparation"] and r[2]["t"]["evidence"] == []


def test_aliases_that_only_some_lists_have(spark):
    for text, name in (("adapt-vqe", "Variational Quantum Eigensolver (VQE)"), ("inverse qft", "Quantum Fourier Transform (QFT)"), ("rotated surface code", "Surface Code"), ("suzuki-trotter", "Hamiltonian Simulation"), ("state tomography", "Tomography")):
        assert topics().lookup()[text] == name


def test_raw_matches(spark):
    """A name that is its own alias, but for case, counts twice: each term is searched."""
    r = spark.createDataFrame([("Hadamard then CNOT", ["a Toffoli gate"], None)], "c string, x array<string>, e string").select(M.raw_matches(F.col("c"), F.col("x"), F.col("e"), gates()).alias("m")).first()["m"]
    assert r == ["Hadamard", "CNOT", "CNOT", "Toffoli gate", "Toffoli gate"]


def test_sums_before(spark):
    values = list(range(1, 1000))
    r = spark.createDataFrame([(values,), ([],), (None,)], "v array<int>").select(AR.sums_before(F.col("v")).alias("s")).collect()
    assert r[0]["s"] == [i * (i + 1) // 2 for i in range(999)] and r[1]["s"] == r[2]["s"] == []
