"""Periodic runs against a direct search."""

import hashlib
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from siltstone.llm import runs
from siltstone.llm.queries import QUERIES, with_planted_run


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def brute(symbols, least, times):
    """(start, length, smallest period) of all runs."""
    found = {}
    for p in range(1, len(symbols) // times + 1):
        i = 0
        while i + p < len(symbols):
            if symbols[i] != symbols[i + p]:
                i += 1
                continue
            start = i
            while i + p < len(symbols) and symbols[i] == symbols[i + p]:
                i += 1
            if i - start + p >= max(least, times * p):
                found.setdefault((start, i - start + p), p)
    return sorted(((a, size, p) for (a, size), p in found.items()), key=lambda r: (r[0], r[2]))


def row_of(words, least=24, times=3):
    found = brute(words, least, times)
    gone = {i for a, size, p in found for i in range(a + p, a + size)}
    best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    more = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return len(found), *more, found, " ".join(w for i, w in enumerate(words) if i not in gone)


_blocks = st.tuples(st.lists(st.integers(0, 2), min_size=1, max_size=9), st.integers(1, 7))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(_blocks, max_size=6), min_size=1, max_size=4), st.sampled_from([(24, 3), (4, 2), (1, 3), (9, 4)]))
def test_find_runs(texts, sizes):
    rows = [[x for block, n in text for x in block * n] for text in texts]
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int64)
    owner, start, length, period = runs.find_runs(np.array([x for r in rows for x in r], np.int64), offsets, *sizes)
    got = list(zip(owner.tolist(), start.tolist(), length.tolist(), period.tolist(), strict=True))
    assert got == [(i, *r) for i, row in enumerate(rows) for r in brute(row, *sizes)]


@pytest.mark.parametrize("size", [2, 31, 200, 3000])
def test_extensions(size):
    source = np.random.default_rng(size)
    symbols = (source.random(size) < 0.05).astype(np.int64)
    symbols[size // 2 :] = symbols[: size - size // 2]
    i, j = source.integers(0, size, (2, 3000))
    i, j = i[i != j], j[i != j]
    limit = size - np.maximum(i, j)
    got = runs.CoverIndex(symbols, size).extension(i, j, limit)
    for a, b, most, n in zip(i, j, limit, got, strict=True):
        assert (symbols[a : a + n] == symbols[b : b + n]).all() and (n == most or symbols[a + n] != symbols[b + n])


def test_few_suffixes_are_sorted():
    index = runs.CoverIndex(np.zeros(31_000, np.int64), 31_000)
    assert len(index._rank) == 6000
    assert {(a - b) % runs.PERIOD for a in runs.COVER for b in runs.COVER} == set(range(runs.PERIOD))


def test_grid_in_parts(monkeypatch):
    symbols, offsets = np.arange(3000) % 7, np.array([0, 3000])
    whole = runs.find_runs(symbols, offsets)
    monkeypatch.setattr(runs, "POINTS", 50)
    assert [x.tolist() for x in runs.find_runs(symbols, offsets)] == [x.tolist() for x in whole] == [[0], [0], [3000], [7]]


def test_strongest_is_exact():
    # 3 + 1 / 1000000007 against 3 + 1 / 1000000006
    owner, start = np.zeros(3, np.int64), np.array([5, 9, 1])
    period = np.array([1_000_000_007, 1_000_000_006, 10])
    length = np.array([3_000_000_022, 3_000_000_019, 30])
    assert runs.strongest(owner, start, length, period).tolist() == [1]
    assert runs.strongest(owner, start, np.array([30, 60, 90]), np.array([10, 20, 30])).tolist() == [2]


def test_documents(docs_of, texts, untouched):
    rows = texts + [
        (70, "a b " * 11 + "a"), (71, "a b " * 12), (72, "x " + "a b " * 12 + "a c"), (73, "a b c d e f g h " * 3), (74, "a b c d e f g h " * 3 + "a"),
        (75, "q " * 24 + "a b c " * 9), (76, " ".join(["a b a c"] * 9 + ["z"] * 30)), (77, " ".join(str(i % 40) for i in range(140))),
    ]
    out = runs.collapse_runs(docs_of(rows))
    untouched(out)
    got = [
        (r.doc_id, r.text, r.n_runs, r.run_start, r.run_length, r.run_period, r.exponent_milli, [tuple(x) for x in r.runs], r.collapsed) for r in out.collect()
    ]
    want = [(i, t, *row_of(words_of(t))) for i, t in rows]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    by_id = {r[0]: r for r in want}
    assert [by_id[i][2] for i in (70, 71, 73, 75, 77)] == [0, 1, 1, 2, 1]


def test_no_rows(docs_of, spark):
    assert runs.collapse_runs(docs_of([]).limit(0)).collect() == []
    with pytest.raises(ValueError, match="run_period"):
        runs.collapse_runs(spark.createDataFrame([(1, "a", 2)], "doc_id int, text string, run_period int"))


def planted(doc, text):
    words, h = words_of(text), zlib.crc32(str(doc).encode())
    if doc is None or h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[a + (i - a) % p] if i >= a else words[i] for i in range(n)]


def test_query(spark, tmp_path, texts):
    rows = [(i, " ".join(f"w{(i * j) % 57}" for j in range(i % 90))) for i in range(400)] + texts
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    assert sorted((r.doc_id or -1, words_of(r.text)) for r in with_planted_run(docs).collect()) == sorted((d or -1, planted(d, t)) for d, t in rows)
    sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
    want = []
    for doc, text in rows:
        *values, found, rest = row_of(planted(doc, text))
        want.append((doc, *values, sha("".join(f"{a},{n},{p}\n" for a, n, p in found)), sha(rest)))
    got = [tuple(r) for r in QUERIES["op11_periodic_runs"](spark, str(tmp_path)).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert sum(r[1] > 0 for r in want) > 20
