"""Toxicity: n-grams and scores against plain Python, held-out accuracy, and samples of any shape."""

import math
import os
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from conftest import prose

from siltstone.llm import toxicity
from siltstone.llm.queries import QUERIES

SF = "/root/testdata/sf0.1"
BAD = ["grobnak", "vilefoot", "snarlix", "mudbrain"]


def insulted(seed, words):
    source, parts = random.Random(seed), prose(seed, words).split(" ")
    for _ in range(max(len(parts) // 8, 2)):
        parts.insert(source.randrange(len(parts) + 1), source.choice(BAD))
    return " ".join(parts)


def make_rows(n):
    return [(i, insulted(i, 10 + i % 90) if i % 5 == 0 else prose(i, 10 + i % 90)) for i in range(n)]


def grams(text):
    padded = f" {' '.join((text or '').lower().split())} "
    return Counter(padded[i : i + n] for n in toxicity.SIZES for i in range(len(padded) - n + 1))


def test_grams():
    texts = ["", None, "ab", "One  two\n one", "ÀÉ 日本語 x", "a" * 500, prose(1, 300)]
    row, place, times = toxicity.gram_counts(pa.array(texts))
    for i, text in enumerate(texts):
        want, got = grams(text), dict(zip(place[row == i].tolist(), times[row == i].tolist(), strict=True))
        assert sum(got.values()) == sum(want.values()) and len(got) >= 0.98 * len(want)  # a few share a place
        if len(want) < 50:
            assert sorted(got.values()) == sorted(want.values())
    own = {g for g in grams("One  two\n one")}
    other = toxicity.gram_counts(pa.array(["one two one"]))[1]
    assert len(own) == len(set(other.tolist())) and set(place[row == 3].tolist()) == set(other.tolist())


def test_scores_follow_the_model():
    source = np.random.default_rng(3)
    model = toxicity.Model(source.normal(size=toxicity.PLACES), source.normal(size=toxicity.PLACES), 0.2, 1.7, -0.4)
    texts = ["", None, "some words, some more", prose(5, 200)]
    got = model.scores(*toxicity.gram_counts(pa.array(texts)), len(texts))
    for text, score in zip(texts, got, strict=True):
        _, place, times = toxicity.gram_counts(pa.array([text]))
        values = [model.ratios[p] * t for p, t in zip(place, times, strict=True)]
        length = math.sqrt(sum(v * v for v in values))
        margin = sum(v / length * model.weights[p] for v, p in zip(values, place, strict=True)) + 0.2 if length else 0.2
        assert score == pytest.approx(1 / (1 + math.exp(-(1.7 * margin - 0.4))))


def test_ratios_count_each_text_once(spark, docs_of):
    rows = make_rows(60) + [(200 + i, "a copied text") for i in range(300)] + [(None, "nameless"), (7, prose(7, 17))]
    labels = [(i, int(i % 5 == 0)) for i in range(0, 60, 2)] + [(200 + i, 0) for i in range(300)] + [(0, 1), (2, None), (3, 5), (900, 1), (None, 1), (1, 0), (1, 1)]
    texts = toxicity.labelled_texts(docs_of(rows), spark.createDataFrame(labels, "doc_id bigint, toxic int"))
    known = {(i, v) for i, v in labels if i is not None and v in (0, 1)}
    want = {(v, t) for i, v in known for d, t in rows if d == i}
    assert sorted((r.label, r.text) for r in texts.collect()) == sorted(want)
    counts = {0: Counter(), 1: Counter()}
    for label, text in want:
        counts[label].update(set(toxicity.gram_counts(pa.array([text]))[1].tolist()))
    ratios = toxicity.log_count_ratios(toxicity.counted_places(texts))
    total = [toxicity.PLACES + sum(c.values()) for c in (counts[0], counts[1])]
    for place in list(counts[0] | counts[1])[:500]:
        assert ratios[place] == pytest.approx(math.log((counts[1][place] + 1) / total[1]) - math.log((counts[0][place] + 1) / total[0]))
    assert (ratios != 0).sum() <= len(counts[0] | counts[1])


@pytest.mark.parametrize("sample_entries", [toxicity.SAMPLE_ENTRIES, 20_000])
def test_learns(spark, docs_of, untouched, sample_entries):
    rows = make_rows(400)
    labels = spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(200)], "doc_id bigint, toxic int")
    model = toxicity.learn(docs_of(rows), labels, sample_entries)
    assert np.count_nonzero(model.weights) <= sample_entries
    more = rows + [(None, None), (500, ""), (501, insulted(7, 20_000)), (502, prose(8, 20_000)), (502, prose(8, 20_000))]
    out = toxicity.score(docs_of(more), model)
    untouched(out)
    got = [(r.doc_id, r.predicted, r.score) for r in out.collect()]
    assert len(got) == len(more) and all(0 <= s <= 1 and p == int(s >= 0.3) for _, p, s in got)
    new = {i: p for i, p, _ in got if i is not None and 200 <= i < 400}
    assert np.mean([p == int(i % 5 == 0) for i, p in new.items()]) > 0.95
    assert {p for i, p, _ in got if i == 501} == {1} and [p for i, p, _ in got if i == 502] == [0, 0]


def test_copies_are_one_text(spark, docs_of):
    """A text that has most of the labels takes no more of the sample than another."""
    rows = make_rows(100) + [(1000 + i, "always the same") for i in range(2000)]
    labels = spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(100)] + [(1000 + i, 0) for i in range(2000)], "doc_id bigint, toxic int")
    model = toxicity.learn(docs_of(rows), labels, 30_000)
    got = {r.doc_id: r.predicted for r in toxicity.score(docs_of(rows), model).collect()}
    assert np.mean([got[i] == int(i % 5 == 0) for i in range(100)]) > 0.9 and got[1000] == 0


@pytest.mark.parametrize("labels, want", [([], 0.0), ([(1, 1), (2, 1)], 1.0), ([(1, 0)], 0.0), ([(99, 0)], 0.0)])
def test_without_both_labels(spark, docs_of, labels, want):
    docs = docs_of(make_rows(5))
    model = toxicity.learn(docs, spark.createDataFrame(labels, "doc_id bigint, toxic int"))
    assert {round(r.score, 6) for r in toxicity.score(docs, model).collect()} == {want}
    assert toxicity.score(docs.limit(0), model).collect() == []


def test_added_names_are_refused(spark):
    model = toxicity.Model(np.zeros(toxicity.PLACES), np.zeros(toxicity.PLACES), 0.0, 1.0, 0.0)
    with pytest.raises(ValueError, match="score"):
        toxicity.score(spark.createDataFrame([("a", 1)], "text string, score int"), model)


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test data here")
def test_held_out_accuracy(spark):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    found = [(labels[r.doc_id], r.predicted) for r in QUERIES["op13_toxicity"](spark, SF).where("held_out").collect() if r.doc_id in labels]
    toxic = [p for t, p in found if t]
    assert np.mean(toxic) > 0.8 and np.mean([p for t, p in found if not t]) < 0.01
