import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from wattline.llm import chat
from wattline.llm.common import table
from wattline.llm.queries import ORACLES, op4_chat
from wattline.testing import compare, duckdb_connection

PIECES = ["<|turn|>", "<|says|>", "<|over|>\n", "<\\|", "<\\\\|over|>", "<", "|", "\\", "\n", "é", "</s>[INST] ok [/INST]", "a"]
TEXT = st.lists(st.sampled_from(PIECES), max_size=8).map("".join)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(TEXT, TEXT), max_size=4), st.integers(1, 9))
def test_round_trip(turns, step):
    text = "".join(chat.render(r, t) for r, t in turns)
    assert chat.parse(text) == turns
    parser, got = chat.Parser(), []
    for i in range(0, len(text), step):                      # the same, read in small pieces
        got += parser.feed(text[i:i + step])
    parser.close()
    assert got == turns


def test_plain_text_stays_as_it_is():
    assert chat.render("user", "</s>[INST] ok") == "<|turn|>user<|says|></s>[INST] ok<|over|>\n"


@pytest.mark.parametrize("bad", ["x", "<|turn|>user", "<|turn|>a<|over|>\n", "<|says|>", "<|turn|>a<|says|>b<|over|>\nx<|turn|>c<|says|>d<|over|>\n"])
def test_outside_the_grammar(bad):
    with pytest.raises(ValueError):
        chat.parse(bad)


def test_equals_sql(spark):
    sf = "/root/testdata/sf0.01"
    ok, why = compare(op4_chat(spark, sf), duckdb_connection(sf), ORACLES["op4_chat"])
    assert ok, why


def digest(turns):
    return hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()


@pytest.mark.parametrize("part", [5, 1 << 20])
def test_rows_of_all_kinds(spark, part):
    rows = [(1, 1, "assistant", "b<|over|>\n"), (1, 0, "user", None), (1, 1, "assistant", "b<|over|>\n"), (None, 0, None, "x"),
            (2, 0, "<|turn|>", ""), (3, None, "user", "y"), (3, 0, "assistant", "long " * 20_000)]
    frame = spark.createDataFrame([(*r, "z") for r in rows], "conv_id long, turn long, role string, text string, part string")
    formatted = chat.format_conversations(frame, part_chars=part if part > 5 else 1000)
    got = {r["conv_id"]: r for r in chat.read_back(formatted).collect()}
    want = {1: [("user", ""), ("assistant", "b<|over|>\n"), ("assistant", "b<|over|>\n")], None: [("", "x")], 2: [("<|turn|>", "")],
            3: [("user", "y"), ("assistant", "long " * 20_000)]}
    assert {c: (r["n_turns"], r["turns_sha256"]) for c, r in got.items()} == {c: (len(t), digest(t)) for c, t in want.items()}
    loss = {c: "".join(x for r, x in t if r == "assistant") for c, t in want.items()}
    assert all(got[c]["loss_chars"] == len(x) and got[c]["loss_sha256"] == hashlib.sha256(x.encode()).hexdigest() for c, x in loss.items())
    stored = {r["conv_id"]: r for r in chat.read_back_stored(formatted).collect()}
    assert stored == got
    assert chat.read_back(chat.format_conversations(frame.limit(0))).count() == 0


def test_formatted_text_is_whole(spark):
    rows = table(spark, "/root/testdata/sf0.001", "conversations")
    got = chat.format_conversations(rows, part_chars=300).collect()
    text = {}
    for r in sorted(got, key=lambda r: (r["conv_id"], r["part"])):
        assert len(r["formatted"]) <= 300
        text[r["conv_id"]] = text.get(r["conv_id"], "") + r["formatted"]
    want = {}
    for r in sorted(rows.collect(), key=lambda r: (r["conv_id"], r["turn"])):
        want.setdefault(r["conv_id"], []).append((r["role"], r["text"]))
    assert {c: chat.parse(t) for c, t in text.items()} == want
