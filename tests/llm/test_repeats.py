"""Substring and byte dedup against brute force."""

import hashlib
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from siltstone.llm import fm_index, repeats, suffixes


def covered(units, window, starts):
    flags = np.zeros(len(units), bool)
    for i in starts:
        flags[i : i + window] = True
    return flags


def brute(sequences, window):
    """Flags of units inside windows that start more than once."""
    times = Counter(tuple(s[i : i + window]) for s in sequences for i in range(len(s) - window + 1))
    return [covered(s, window, [i for i in range(len(s) - window + 1) if times[tuple(s[i : i + window])] > 1]) for s in sequences]


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def removed_words(docs_of, rows, **options):
    out = fm_index.drop_repeated_words(docs_of(rows), **options)
    sequences = [words_of(t) for _, t in rows]
    want = []
    for (i, text), words, gone in zip(rows, sequences, brute(sequences, 35), strict=True):
        kept = " ".join(w for w, g in zip(words, gone, strict=True) if not g)
        want.append((i, text, len(words), int(gone.sum()), hashlib.sha256(kept.encode()).hexdigest(), kept))
    got = [tuple(r) for r in out.select("doc_id", "text", "n_words", "n_removed", "kept_sha256", "kept").collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    return out, want


def removed_bytes(docs_of, rows):
    out = suffixes.drop_repeated_bytes(docs_of(rows))
    sequences = [(t or "").encode() for _, t in rows]
    want = []
    for (i, _), data, gone in zip(rows, sequences, brute(sequences, 200), strict=True):
        kept = bytes(b for b, g in zip(data, gone, strict=True) if not g)
        runs = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        want.append((i, len(data), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest(), kept))
    got = [(*r[:5], bytes(r[5])) for r in out.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept").collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    return out, want


@pytest.mark.parametrize("shard_rows", [6000, 40, 2])
def test_words(docs_of, texts, untouched, monkeypatch, shard_rows):
    monkeypatch.setattr(fm_index, "SHARD_ROWS", shard_rows)
    out, want = removed_words(docs_of, texts)
    untouched(out)
    assert any(r[3] for r in want) and any(not r[3] and r[2] > 50 for r in want)


@pytest.mark.parametrize("shard_rows, batch_rows", [(1500, 300), (40, 7), (2, 1)])
def test_bytes(docs_of, texts, untouched, monkeypatch, shard_rows, batch_rows):
    monkeypatch.setattr(suffixes, "SHARD_ROWS", shard_rows)
    monkeypatch.setattr(suffixes, "BATCH_ROWS", batch_rows)
    untouched(removed_bytes(docs_of, texts)[0])


def near_copies(n, words):
    """Copies of one text with a few words changed in each."""
    base = [f"w{(i * i) % 997}" for i in range(words)]
    rows = []
    for i in range(n):
        own = list(base)
        for j in range(3):
            own[(37 * i + 61 * j) % words] = f"x{i}_{j}"
        rows.append((i, " ".join(own)))
    return rows


@pytest.mark.parametrize("remove", [removed_words, removed_bytes])
def test_near_copies_do_not_blow_up(docs_of, monkeypatch, remove):
    """Anchors that most segments share are split by more anchors, into a few parts a segment."""
    seen, real = {}, repeats.stored

    def watch(df, label):
        seen.setdefault(label, []).append(real(df, label))
        return seen[label][-1]

    monkeypatch.setattr(repeats, "stored", watch)
    for module in (fm_index, suffixes):
        monkeypatch.setattr(module, "SHARD_ROWS", 8)
    _, want = remove(docs_of, near_copies(40, 120))
    assert any(r[3] for r in want)
    segments = seen["distinct-segments"][0].count()
    assert segments > 150 and 0 < seen["parts"][0].count() < 4 * segments
    assert all(p.count() < 4 * segments for p in seen["parts"][: repeats.SPLITS])


def test_splits_end_with_windows(docs_of, monkeypatch):
    monkeypatch.setattr(repeats, "SPLITS", 0)
    monkeypatch.setattr(fm_index, "SHARD_ROWS", 3)
    removed_words(docs_of, near_copies(12, 90))


def thue_morse(length):
    return "".join("ab"[i.bit_count() & 1] for i in range(length))


def test_words_that_polynomials_confuse(docs_of):
    """Two long words of the same letters, which have the same hash for every base modulo 2**64."""
    odd = thue_morse(1024), thue_morse(1024).translate(str.maketrans("ab", "ba"))
    rows = [(i, " ".join([*(f"w{j}" for j in range(20)), word, *(f"v{j}" for j in range(20))])) for i, word in enumerate(odd)]
    _, want = removed_words(docs_of, rows)
    assert [r[3] for r in want] == [0, 0]
    _, want = removed_words(docs_of, [*rows, (2, rows[0][1])])
    assert sorted(r[3] for r in want) == [0, 41, 41]


def test_no_rows(docs_of):
    assert fm_index.drop_repeated_words(docs_of([]).limit(0)).collect() == []
    assert suffixes.drop_repeated_bytes(docs_of([]).limit(0)).collect() == []


def test_added_names_are_refused(spark):
    docs = spark.createDataFrame([(1, "a", 2)], "doc_id int, text string, n_removed int")
    with pytest.raises(ValueError, match="n_removed"):
        fm_index.drop_repeated_words(docs)


@settings(max_examples=40, deadline=None)
@given(st.lists(st.lists(st.integers(1, 3), min_size=1, max_size=30), min_size=1, max_size=6), st.integers(1, 3))
def test_matching_statistics(runs, at_least):
    text = np.array([x for run in runs for x in [*run, 0]], np.int64)
    lengths = np.array([len(r) for r in runs])
    starts = np.cumsum(lengths + 1) - lengths - 1
    found = fm_index.FmIndex(text, 64).matching_statistics(text, starts, starts + lengths, at_least)
    joined = [tuple(r) for r in runs]
    for run, start in zip(joined, starts, strict=True):
        for i in range(len(run)):
            best = 0
            for n in range(1, len(run) - i + 1):
                if sum(other[j : j + n] == run[i : i + n] for other in joined for j in range(len(other) - n + 1)) >= at_least:
                    best = n
            assert found[start + i] == best


@settings(max_examples=40, deadline=None)
@given(st.lists(st.sampled_from(["a" * 40, "ab" * 30, "abcdefgh" * 9, "xyz" * 20, "q" * 7]), min_size=1, max_size=12), st.integers(1, 4))
def test_levels(parts, batch):
    window = 20
    segments = [p.encode() for p in parts if len(p) >= window]
    counts = [min(len(s) - window + 1, 9) for s in segments]
    shard = pa.table(
        {
            "seg": pa.array([bytes([i]) for i in range(len(segments))], pa.binary()),
            "at": pa.array([10] * len(segments), pa.int32()),
            "windows": pa.array(counts, pa.int32()),
            "payload": pa.array(segments, pa.binary()),
            "times": pa.array([1] * len(segments), pa.int64()),
        }
    )
    found = suffixes.family_search(window, batch)(shard).to_pylist()
    got = {(r["seg"][0], i) for r in found for run in r["runs"] for i in range(run["first"], run["last"] + 1)}
    every = Counter((s[i : i + window], i) for s, n in zip(segments, counts, strict=True) for i in range(n))
    want = {(k, i) for k, (s, n) in enumerate(zip(segments, counts, strict=True)) for i in range(n) if every[(s[i : i + window], i)] > 1}
    assert got == want
