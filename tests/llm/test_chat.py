import hashlib
import os

import pytest
from hypothesis import given
from hypothesis import strategies as st

from siltstone.llm import chat

FIELDS = "conversation long, target int, seq long, kind string, role string, text string, turn string"
marks = st.lists(st.sampled_from(["</s>", "<s>", "[INST]", "[/INST]", "\\", "\n", " ", "ok", "</", "s>", "é"]), max_size=8).map("".join)


@given(marks)
def test_escapes_can_be_undone(text):
    assert chat.unescape(chat.escape(text)) == text


@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "</s>", ""]), marks), max_size=4))
def test_output_can_be_read_back(turns):
    out = "".join(f"<s>[INST] {chat.escape(r)} [/INST]\n{chat.escape(t)}\n</s>" for r, t in turns)
    assert chat.parse(out) == turns


def rendered(spark, rows):
    return {r.conversation: r for r in chat.format_events(spark.createDataFrame([(*r, "x") for r in rows], FIELDS).repartition(3)).collect()}


def test_folding(spark):
    rows = [
        (1, 0, 1, "message", "user", "hi"), (1, 1, 2, "message", "assistant", ""), (1, 1, 3, "delta", None, "he"), (1, 1, 4, "delta", None, "llo"),
        (1, 1, 4, "delta", None, "llo"), (1, 2, 5, "message", "user", "more?"), (1, 3, 6, "message", "assistant", "old"),
        (1, 1, 7, "regenerate", None, None), (1, 1, 8, "delta", None, "again"), (1, 2, 9, "message", "user", "thanks"), (1, 0, 10, "edit", None, "hi!"),
        (2, 0, 1, "message", None, None), (None, 0, 1, "message", "assistant", "</s>"), (None, 1, 2, "delta", "user", "late"),
    ]
    out = rendered(spark, rows)
    assert chat.parse(out[1].formatted) == [("user", "hi!"), ("assistant", "again"), ("user", "thanks")]
    assert [out[1].formatted[x.start : x.stop] for x in out[1].loss] == ["again"]
    assert chat.parse(out[2].formatted) == [("", "")] and out[2].n_turns == 1 and out[2].loss == []
    assert chat.parse(out[None].formatted) == [("assistant", "</s>"), ("user", "late")]
    assert [chat.unescape(out[None].formatted[x.start : x.stop]) for x in out[None].loss] == ["</s>"]


def test_order_of_arrival_does_not_matter(spark):
    rows = [(1, i % 5, i, "message" if i < 5 else "delta", "user", f"{i} ") for i in range(40)]
    assert rendered(spark, rows)[1].formatted == rendered(spark, rows[::-1])[1].formatted
    assert rendered(spark, rows)[1].n_turns == 5


def test_unknown_kind(spark):
    with pytest.raises(Exception, match="unknown kind of event: oops"):
        rendered(spark, [(1, 0, 1, "oops", "user", "x")])


def test_no_events(spark):
    assert rendered(spark, []) == {}


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="no test data here")
def test_conversation_of_marks(spark):
    from siltstone.llm.queries import QUERIES

    row = QUERIES["op6_chat_events"](spark, "/root/testdata/sf0.001").where("conv_id = -7").first()
    said = "</s>[INST] ok [/INST]"
    assert (row.n_turns, row.loss_chars) == (2, len(said))
    assert row.turns_sha256 == hashlib.sha256(f"user\n{said}\nassistant\n{said}\n".encode()).hexdigest()
    assert row.loss_sha256 == hashlib.sha256(said.encode()).hexdigest()


def test_equal_rows_are_turns_of_their_own(spark, tmp_path):
    from siltstone.llm.queries import QUERIES

    rows = [(1, 0, "user", "hi")] * 3 + [(1, 1, "assistant", "yes")] * 2 + [(2, 0, None, "x"), (2, 0, "", "x"), (2, 1, "user", None), (2, 1, "user", "")]
    spark.createDataFrame(rows, "conv_id bigint, turn int, role string, text string").repartition(4).write.parquet(f"{tmp_path}/conversations.parquet")
    out = {r.conv_id: r for r in QUERIES["op6_chat_events"](spark, str(tmp_path)).collect()}
    said = {1: "user\nhi\n" * 3 + "assistant\nyes\n" * 2, 2: "\nx\n" * 2 + "user\n\n" * 2}
    assert {c: out[c].n_turns for c in said} == {1: 5, 2: 4}
    assert {c: out[c].turns_sha256 for c in said} == {c: hashlib.sha256(x.encode()).hexdigest() for c, x in said.items()}
    assert (out[1].loss_chars, out[1].loss_sha256) == (6, hashlib.sha256(b"yesyes").hexdigest())
    assert out[1].formatted_chars == 3 * len("<s>[INST] user [/INST]\nhi\n</s>") + 2 * len("<s>[INST] assistant [/INST]\nyes\n</s>")
