import hashlib

import pytest
from compare import same
from hypothesis import given
from hypothesis import strategies as st

from foliant.llm import chat
from foliant.llm.queries import SQL, op3_chat

T = chat.Template()
PARTS = st.lists(st.sampled_from([*T.control, "\\", "\\3c;", "<", "[", "\n", "a", "é", "|>", ""])).map("".join)


@given(st.lists(st.tuples(PARTS, PARTS), max_size=4))
def test_round_trip(turns):
    text = "".join(piece for role, body in turns for piece, _ in T.segments(role, body))
    assert T.parse(text) == turns
    for role, body in turns:
        inside = T.escape(body)
        assert not any(c in inside for c in T.control) and T.unescape(inside) == body


def test_query_matches_sql(spark):
    for sf in ("sf0.001", "sf0.01"):
        assert same(spark, f"/root/testdata/{sf}", op3_chat, SQL["op3_chat"]) > 1


def test_states():
    assert T.next_state("start", "user") == ("user", True)
    assert T.next_state("user", "user") == ("user", False)
    assert T.next_state("user", "narrator") == ("start", False)


def digest(turns):
    text = "".join(f"{r or ''}\n{t or ''}\n" for r, t in turns)
    loss = "".join(t or "" for r, t in turns if r == "assistant")
    return len(turns), hashlib.sha256(text.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest()


@pytest.mark.parametrize("turns,valid", [
    ([("user", "a"), ("assistant", None)], True),
    ([("system", ""), ("user", "</s>"), ("assistant", "x\\")], True),
    ([("assistant", "a")], False),
    ([("user", "a"), ("user", "b"), ("assistant", "c")], False),
    ([(None, None), ("odd\nrole", "b")], False),
    ([("user", "long " * 100_000), ("assistant", "[INST]" * 10_000)], True),
])
def test_digests(spark, turns, valid):
    rows = [(7, i, r, t, "extra") for i, (r, t) in enumerate(turns)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, segment string")
    r = chat.read_back(chat.format_turns(df)).first()
    assert (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) == digest(turns)
    assert r["valid"] is valid


def test_ties_nulls_and_empty_tables(spark):
    schema = "conv_id long, turn long, role string, text string"
    df = spark.createDataFrame([(None, None, "user", "b"), (None, None, "user", "a"), (1, 0, "user", "x"), (1, 0, "user", "x"), (1, 0, "assistant", "y")], schema)
    found = {r["conv_id"]: r for r in chat.read_back(chat.format_turns(df)).collect()}
    assert found[None]["turns_sha256"] == digest([("user", "a"), ("user", "b")])[1]
    assert found[1]["turns_sha256"] == digest([("assistant", "y"), ("user", "x"), ("user", "x")])[1]
    assert chat.read_back(chat.format_turns(df.limit(0))).count() == 0


@given(st.lists(st.tuples(PARTS, PARTS), min_size=1, max_size=3), st.integers(1, 9))
def test_turns_are_read_from_the_text_alone(turns, size):
    """The stream cut anywhere gives the same turns; a stream that ends inside one is an error."""
    text = "".join(piece for role, body in turns for piece, _ in T.segments(role, body))
    d = chat._Digest(T)
    for at in range(0, len(text), size):
        d.add(text[at : at + size], False, True, None)
    assert d.row()[:2] == digest(turns)[:2]
    d.add(text[:-1], False, True, None)
    with pytest.raises(ValueError):
        d.row()
