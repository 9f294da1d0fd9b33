import hashlib
from collections import defaultdict

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from siltstone.llm.lines import Chunks, drop_repeated_lines


def chunks_of(text):
    chunks = Chunks(pa.array([text]))
    return list(zip(chunks.start.tolist(), chunks.stop.tolist(), strict=True))


def test_text_in_front_moves_few_boundaries():
    block = "\n".join(f"line {i}" for i in range(200))
    before = "\n".join(["other", "lines", "here", block])
    shift = len("other\nlines\nhere\n")
    own, moved = set(chunks_of(block)), {(a - shift, b - shift) for a, b in chunks_of(before)}
    assert len(own & moved) >= len(own) - 1 and 60 < len(own) < 140


def test_chunks_and_pairs():
    text = "\n\na\nb\n\nc\n\nd\ne\n"
    chunks = Chunks(pa.array([text, None, "", "x", "y\nz"]))
    spans = [(r, text[a:b]) for r, a, b in zip(chunks.row.tolist(), chunks.start.tolist(), chunks.stop.tolist(), strict=True) if r == 0]
    assert "".join("".join(t.split()) for _, t in spans) == "abcde" and all(t[0] != "\n" != t[-1] for _, t in spans)
    row, start, stop, _, within = chunks.pairs()
    assert [text[a:b] for r, a, b in zip(row, start, stop, strict=True) if r == 0] == ["a\nb", "b\n\nc", "c\n\nd", "d\ne"]
    held = [next((a for a, b in chunks_of(text) if a <= s and b >= e), -1) for r, s, e in zip(row, start, stop, strict=True) if r == 0]
    assert within[row == 0].tolist() == held and (row == 4).sum() == 1


def test_clean_texts_stay(docs_of):
    rows = [(i, "\n".join(f"{i} {j}" for j in range(20))) for i in range(5)]
    assert {r.n_removed_lines for r in drop_repeated_lines(docs_of(rows)).collect()} == {0}
    assert drop_repeated_lines(docs_of([]).limit(0)).collect() == []


def passages(rows):
    """Rows without repeated passages, by comparing lists of lines: (id, text, lines, lines that went)."""
    places = defaultdict(set)
    found = []
    for doc, text in rows:
        split = (text or "").split("\n") if text else []
        filled = [i for i, line in enumerate(split) if line]
        digest = hashlib.md5((text or "").encode()).digest()
        for i, j in zip(filled, filled[1:], strict=False):
            places[tuple(split[i : j + 1])].add((doc is None, doc or 0, digest, i))
        found.append((split, filled, digest))
    out = []
    for (doc, text), (split, filled, digest) in zip(rows, found, strict=True):
        gone = set()
        for i, j in zip(filled, filled[1:], strict=False):
            if min(places[tuple(split[i : j + 1])]) != (doc is None, doc or 0, digest, i):
                gone |= set(range(i, j + 1))
        rest = None if text is None else "\n".join(line for i, line in enumerate(split) if i not in gone)
        out.append((doc, rest, len(split), len(gone)))
    return out


@pytest.mark.parametrize("window, divisor", [(1, 2), (3, 4), (1, 1)])
def test_repeated_passages(docs_of, texts, untouched, window, divisor):
    block = "\n".join(f"line {i} of a long notice" for i in range(30))
    rows = texts + [(70 + i, f"head {i}\nmore {i}\n{block}\ntail {i}") for i in range(5)] + [(80, f"{block}\n\n\n{block}"), (81, "\n\n\n"), (82, "x\n\ny\n")]
    rows += [(83, "x\n\ny"), (84, "x\n\ny\nz\nö\n"), (85, "q\nz\nö\nx\ny"), (86, "same\nsame\nsame\nsame"), (87, "q\n\nx\n\ny\n\n"), (83, "x\n\ny")]
    out = drop_repeated_lines(docs_of(rows), window=window, divisor=divisor)
    untouched(out)
    got = [tuple(r) for r in out.select("doc_id", "text", "n_lines", "n_removed_lines").collect()]
    assert sorted(got, key=repr) == sorted(passages(rows), key=repr)
    assert {r[3] for r in got if r[0] in (71, 72, 73, 74)} == {30}
    # no line is lost altogether
    assert {x for _, t in rows for x in (t or "").split("\n")} == {x for _, t, *_ in got for x in (t or "").split("\n")} | {""}


def test_query_finds_short_passages(spark, tmp_path):
    from siltstone.llm.queries import QUERIES

    # runs of two to five lines in documents of three to eight
    rows = [(i, "\n".join([f"own {i}", *(f"shared {i % 4} {j}" for j in range(2 + i % 4)), f"end {i}", f"after {i}"][i % 2 :])) for i in range(40)]
    spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r.n_removed_lines for r in QUERIES["op4_line_chunks"](spark, str(tmp_path)).collect()}
    assert got == {i: 0 if i < 4 else 2 + i % 4 for i in range(40)}
    assert got == {doc: gone for doc, _, _, gone in passages(rows)}


def test_chunks_settle_most_of_a_long_passage(docs_of, monkeypatch):
    """Pairs are looked at around chunks and in first copies, not in later ones."""
    from siltstone.llm import lines

    seen = {}

    def watch(df, label):
        out = real(df, label)
        seen[label] = out
        return out

    real = lines.stored
    monkeypatch.setattr(lines, "stored", watch)
    block = "\n".join(f"a line of the notice {i}" for i in range(60))
    rows = [(i, f"own {i}\n{block}\nend {i}") for i in range(30)]
    got = {r.doc_id: r.n_removed_lines for r in drop_repeated_lines(docs_of(rows)).collect()}
    assert got == {i: 60 if i else 0 for i in range(30)}
    pairs, every = seen["open-pairs"].count(), 30 * 59
    assert seen["later-chunks"].count() >= 29 * 10 and pairs < 0.75 * every


@settings(max_examples=5, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["a", "b", "c", "dd", "", "e e"]), max_size=9), min_size=1, max_size=8))
def test_any_lines(spark, texts):
    rows = [(i // 2, "\n".join(lines)) for i, lines in enumerate(texts)]
    out = drop_repeated_lines(spark.createDataFrame(rows, "doc_id bigint, text string"))
    got = [tuple(r) for r in out.collect()]
    assert sorted(got, key=repr) == sorted(passages(rows), key=repr)
