import hashlib
import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from foliant.llm import privacy
from foliant.llm.common import table
from foliant.llm.queries import op10_privacy

PATTERNS = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"]


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def plain(text):
    out = []
    for k, p in enumerate(PATTERNS):
        for m in re.finditer(p, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if k == 1 and any(int(x) > 255 for x in m[0].split(".")):
                continue
            if k == 2 and not (12 <= len(digits) <= 19 and luhn(digits)):
                continue
            if k == 3 and not 9 <= len(digits) <= 15:
                continue
            out.append((m.start(), k, m.end()))
    return sorted(out)


ALPHABET = st.lists(st.sampled_from([*"a1@.-+ ()_%", "com", "255", "256", "0001", "4111111111111111", "é", "\n", "+1 (555) 555-1234", "1.2.3.4", "a@b.c"]), max_size=14).map("".join)


@settings(max_examples=400, deadline=None)
@given(ALPHABET)
def test_base_spans_agree_with_the_patterns(text):
    assert [s for s in privacy.entities(text) if s[1] < privacy.BASE] == plain(text)


def test_long_runs_take_linear_time():
    for text in ("1" * 100_000, "a" * 100_000 + "@", "1." * 50_000, "+1" + " " * 100_000, "f" * 100_000, "@" * 100_000):
        privacy.entities(text)


def test_query_agrees_with_a_plain_version(spark):
    d = "/root/testdata/sf0.01"
    texts = {r["doc_id"]: r["text"] for r in table(spark, d, "documents").collect()}
    rows = op10_privacy(spark, d).collect()
    assert len(rows) == len(texts) and any(r["spans"] for r in rows)
    for r in rows:
        base = plain(texts[r["doc_id"]])
        assert [r[f"n_{k}"] for k in privacy.KINDS[:4]] == [sum(s[1] == k for s in base) for k in range(4)]
        listed = [f"{privacy.KINDS[k]}:{a}:{b}" for a, k, b in base]
        assert r["base_sha256"] == hashlib.sha256(",".join(listed).encode()).hexdigest()
        assert set(listed) <= set(r["spans"].split(",")) | {""}
        order = [(int(a), privacy.KINDS.index(k)) for k, a, _ in (s.split(":") for s in r["spans"].split(",") if s)]
        assert order == sorted(order)


def cued(n):
    """Documents in which one word stands before mail addresses only, and another everywhere."""
    rng = random.Random(4)
    rows = []
    for i in range(n):
        fill = [f"w{rng.randrange(400)}" .replace("0", "a").replace("1", "b") for _ in range(40)]
        fill = [re.sub("[0-9]", "q", w) + rng.choice("xyz") for w in fill]
        if i % 4 == 0:
            at = rng.randrange(5, 35)
            fill[at:at] = ["mailbox", f"user{i}@host{i}.example"]
        rows.append((i, "common " + " ".join(fill)))
    return rows


def test_revealing_terms_are_found_and_removed(spark):
    df = spark.createDataFrame(cued(200), "doc_id long, text string")
    model = privacy.fit(df)
    terms = {(r["term"], r["kind"]): r["disclosure"] for r in model.terms.collect()}
    assert terms["mailbox", 0] == pytest.approx(1.0) and ("common", 0) not in terms
    clean = {r["doc_id"]: r["text"] for r in privacy.sanitise(df).collect()}
    texts = dict(cued(200))
    for i, t in clean.items():
        assert "@" not in t and "mailbox" not in t
        assert ("[EMAIL]" in t) == (i % 4 == 0)
        if i % 4:
            assert t == texts[i]


def test_disclosure_agrees_with_a_plain_count(spark):
    rows = cued(60)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    near, values, total, counts = {}, {}, 0, {}
    for _, t in rows:
        words = privacy.alnum_words(t)
        total += len(words)
        for w in words:
            counts[w.decode()] = counts.get(w.decode(), 0) + 1
        spans = privacy.entities(t)
        for term, a, _, s in privacy.neighbours(t, spans):
            near.setdefault((term, s[1]), set()).add((t, a))
            values.setdefault((term, s[1]), set()).add(t[s[0] : s[2]])
    prior = sum(len(v) for v in near.values()) / total
    import math

    want = {}
    for (term, kind), places in near.items():
        d = math.log(min(1, len(places) / counts[term]) / prior) / -math.log(prior)
        if len(values[term, kind]) >= privacy.SUPPORT and d >= privacy.GENERALISE:
            want[term, kind] = pytest.approx(d)
    assert {(r["term"], r["kind"]): r["disclosure"] for r in privacy.fit(df).terms.collect()} == want


def test_blocks_of_terms_give_the_same(spark, monkeypatch):
    df = spark.createDataFrame(cued(80) + [(1000, "mailbox token x a@b.de")], "doc_id long, text string")
    model = privacy.fit(df, threshold=0.3, support=1)
    whole = [tuple(r) for r in privacy.digest(privacy.detect(df, model)).select("doc_id", "spans").orderBy("doc_id").collect()]
    monkeypatch.setattr(privacy, "BLOCK_TERMS", 2)
    assert len(list(model.blocks())) > 3
    assert [tuple(r) for r in privacy.digest(privacy.detect(df, model)).select("doc_id", "spans").orderBy("doc_id").collect()] == whole


def test_odd_tables(spark):
    df = spark.createDataFrame([(None, None, 1, 3), (1, "", 1, 0), (2, "a@b.c", 1, 5), (2, "a@b.c", 1, 5), (3, "é a@b.c " + "x " * 100_000, 1, None)], "doc_id long, text string, pii int, n_chars long")
    out = privacy.sanitise(df).collect()
    assert out[0].asDict().keys() == set(df.columns)
    assert sorted(((r["doc_id"], r["text"][:9] if r["text"] else r["text"], r["n_chars"]) for r in out), key=str) == sorted([(None, None, 3), (1, "", 0), (2, "[EMAIL]", 7), (2, "[EMAIL]", 7), (3, "é [EMAIL]", 200_010)], key=str)
    assert privacy.sanitise(df.limit(0)).count() == 0


def test_revealing_terms_go_wherever_they_stand(spark):
    """Half of a term's occurrences stand far from entities, or in documents without any."""
    rows = cued(200)
    texts = dict(rows)
    far = " ".join(["plain"] * 20) + " Mailbox, end"
    rows += [(1000, texts[0] + " " + far)] + [(2000 + i, f"{far} of {i}") for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    model = privacy.fit(df)
    d = {(r["term"], r["kind"]): r["disclosure"] for r in model.terms.collect()}["mailbox", 0]
    assert privacy.GENERALISE <= d < privacy.REMOVE
    clean = {r["doc_id"]: r["text"] for r in privacy.sanitise(df).collect()}
    assert all("mailbox" not in t.lower() for t in clean.values())
    assert clean[2003] == " ".join(["plain"] * 20) + " [EMAIL TERM], end of 3"
    pii = {r["doc_id"]: r["pii"] for r in privacy.detect(df, model).collect()}
    assert [(s["kind"], s["start"], s["end"]) for s in pii[2003]] == [("term", 120, 127)]


def test_a_name_tied_to_one_address_is_revealing(spark):
    """One address only, in many documents or many times in one."""
    rows = cued(100) + [(1000 + i, f"w x y z quillon ada@one.example z y x w {i}") for i in range(5)]
    rows += [(2000, " then ".join(["mrs brandish bob@two.example of " + "w x y z " * 5] * 4)), (3000, "seen quillon, and brandish again")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    terms = {(r["term"], r["kind"]) for r in privacy.fit(df).terms.collect()}
    assert {("quillon", 0), ("brandish", 0)} <= terms
    assert not any(w in r["text"] for r in privacy.sanitise(df).collect() for w in ("quillon", "brandish"))


def test_disclosures_are_joined_by_all_tasks(spark, monkeypatch):
    """Files are few because rows are dealt anew after the join, not because few tasks join."""
    written, seen = privacy.written, []

    def spy(df, name, parts=0):
        seen.append((df._jdf.queryExecution().sparkPlan().toString(), parts))
        return written(df, name, parts)

    monkeypatch.setattr(privacy, "written", spy)
    docs = spark.createDataFrame([(i, f"write to marlowe at m{i % 9}@example.com or elsewhere, as many others do today") for i in range(60)], "doc_id long, text string")
    assert privacy.fit(docs).rows
    ((plan, parts),) = seen
    assert plan.startswith("Exchange ") and "REPARTITION_BY_NUM" in plan and "SortMergeJoin" in plan and not parts
