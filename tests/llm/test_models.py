"""Language profiles and the quality classifier: held-out accuracy, defined results, whole texts."""

import os

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from siltstone.llm import language, quality
from siltstone.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"
needs_data = pytest.mark.skipif(not os.path.isdir(SF), reason="no test data here")


@needs_data
def test_languages_of_held_out_documents(spark):
    found = QUERIES["op2_language_id"](spark, SF).join(spark.read.parquet(f"{SF}/documents.parquet"), "doc_id")
    held = found.where("held_out AND lang IS NOT NULL AND length(text) > 30")
    right, total = held.select(F.avg((F.col("lang") == F.col("lang_pred")).cast("double")), F.count("*")).first()
    assert total > 100 and right > 0.97


@needs_data
def test_quality_of_held_out_documents(spark):
    scored = QUERIES["op10_quality_classifier"](spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id")
    held = scored.where("held_out AND quality IS NOT NULL")
    right, total = held.select(F.avg((F.col("quality") == F.col("predicted")).cast("double")), F.count("*")).first()
    assert total > 50 and right > 0.97


def test_profile_of_a_text_is_its_bundle():
    owner, grams, has_letter = language._grams(pa.array(["Ab, ab!", None, "12", "é"]))
    assert has_letter.tolist() == [True, False, False, True]
    # gap-a-b, a-b-gap twice; the gap around a single letter
    assert np.bincount(owner, minlength=4).tolist() == [4, 0, 0, 1]
    letters = language.letter_vectors(256)
    a, b = letters[1], letters[2]
    vector = language.gram_vectors(np.array([1 << 12 | 2 << 6 | 0]), letters)[0]
    assert (vector == np.roll(a, 2) * np.roll(b, 1) * letters[0]).all()


def test_language_edge_cases(docs_of, texts, untouched):
    langs = docs_of(texts).withColumn("lang", F.when(F.col("doc_id") < 12, "xx").when(F.col("doc_id") == 54, "yy"))
    profiles = language.prototypes(language.gram_counts(langs))
    assert sorted(profiles) == ["xx", "yy"]
    out = language.identify(docs_of(texts), profiles)
    untouched(out)
    got = {r.doc_id: r for r in out.where("doc_id is not null").collect()}
    assert all(got[i].lang_pred == "und" and got[i].score == 0 for i in (50, 51, 52))
    assert got[54].lang_pred == "yy" and got[0].lang_pred == "xx"
    assert all(0 <= r.score <= 1 for r in got.values())
    assert language.prototypes(language.gram_counts(langs.limit(0))) == {}
    assert {r.lang_pred for r in language.identify(docs_of(texts), {}).collect()} == {"und"}


def test_quality_edge_cases(docs_of, texts, untouched, spark):
    docs = docs_of(texts)
    labels = spark.createDataFrame([(i, int(i < 10), "a") for i in (0, 1, 2, 3, 4, 30, 31, 32, 33)] + [(None, 1, "b"), (5, None, "c")], "doc_id long, quality int, text string")
    out = quality.score(docs, quality.learn(docs, labels))
    untouched(out)
    assert out.count() == len(texts)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in out.collect())
    one_sided = quality.score(docs, quality.learn(docs, labels.where("quality = 1")))
    assert {r.predicted for r in one_sided.collect()} == {1}
    assert {r.predicted for r in quality.score(docs, quality.learn(docs, labels.where("quality = 0"))).collect()} == {0}
    assert {r.predicted for r in quality.score(docs, quality.learn(docs, labels.limit(0))).collect()} == {1}


def test_features_cover_the_end_of_a_long_text():
    clean = " ".join(f"word{i}" for i in range(30000))
    owner, places = quality.features(pa.array([clean, clean + " !!$$ odd"]))
    assert len(set(places[owner == 1]) - set(places[owner == 0])) >= 2


def test_dual_coordinate_descent_separates():
    rows = [np.array([i % 7, 10 + (i % 2)]) for i in range(200)]
    labels = np.array([i % 2 for i in range(200)])
    sample = quality.Sample(np.concatenate(rows), np.arange(201) * 2, labels, np.ones(200))
    weights, bias = quality.dual_coordinate_descent(sample, np.arange(200), np.ones(16), 1.0, 20)
    assert all((weights[r].sum() + bias > 0) == bool(y) for r, y in zip(rows, labels, strict=True))


def _two_kinds(n):
    return [(i, f"good word{i} here" if i % 2 else f"bad$$ {i}!! ##{i}") for i in range(n)]


@pytest.mark.parametrize("sample_rows", [1, 2, 20])
def test_small_samples(spark, docs_of, sample_rows):
    """Forty labelled rows of two texts, of which some sample by the hash of the text would be empty."""
    docs = docs_of([(i, "one text" if i % 4 else "the other $$") for i in range(40)])
    labels = spark.createDataFrame([(i, int(i % 4 > 0)) for i in range(40)], "doc_id long, quality int")
    rows = quality.labelled_features(docs, labels)
    scored = quality.score(docs, quality.train(rows, sample_rows))
    found = {r.text: r.score for r in scored.collect()}
    assert found["one text"] > found["the other $$"]


def test_a_copied_text_is_one_of_the_sample(spark, docs_of):
    docs = docs_of(_two_kinds(60) + [(1000 + i, "good word copied often") for i in range(3000)])
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)] + [(1000 + i, 1) for i in range(3000)], "doc_id long, quality int")
    rows = quality.labelled_features(docs, labels)
    taken = quality._lowest(rows, 1, 10, 31).collect()
    assert len(taken) == 10 and sum(r.times for r in quality._lowest(rows, 1, 100, 31).collect()) == 3030
    got = {r.doc_id: r.predicted for r in quality.score(docs, quality.train(rows, 20)).collect()}
    assert np.mean([got[i] == i % 2 for i in range(60)]) > 0.9 and got[1000] == 1


def test_quality_by_hand(spark, docs_of):
    """Ratios, margins and scores again in plain Python, from sets of features."""
    rows = _two_kinds(30)
    docs, labels = docs_of(rows), {i: i % 2 for i in range(30)}
    found = quality.labelled_features(docs, spark.createDataFrame(list(labels.items()), "doc_id long, quality int"))
    model = quality.train(found)
    sets = {}
    for i, text in rows:
        owner, places = quality.features(pa.array([text]))
        sets[i] = set(places.tolist())
    counts = np.ones((2, quality.PLACES))
    for i, places in sets.items():
        for place in places:
            counts[labels[i], place] += 1
    seen = sorted(set().union(*sets.values()))
    ratios = {p: np.log(counts[1, p] / counts[1].sum()) - np.log(counts[0, p] / counts[0].sum()) for p in seen}
    assert np.allclose(model.squares[seen], [ratios[p] ** 2 for p in seen]) and np.count_nonzero(model.squares) <= len(seen)
    got = {r.doc_id: r.score for r in quality.score(docs, model).collect()}
    for i, places in sets.items():
        margin = (sum(model.weights[p] for p in places) + model.bias) / np.sqrt(sum(ratios.get(p, 0) ** 2 for p in places) + 1)
        assert got[i] == pytest.approx(1 / (1 + np.exp(-(model.slope * margin + model.shift))))


def test_languages_by_hand(docs_of):
    """Profiles and cosines again in plain Python, trigram by trigram."""
    rows = [(1, "the cat and the dog"), (2, "der Hund und die Katze"), (3, "a dog, the cat"), (4, "und der Hund!"), (5, None), (6, "42")]
    docs = docs_of(rows).withColumn("lang", F.when(F.col("doc_id") == 1, "en").when(F.col("doc_id") == 2, "de"))
    found = language.identify(docs, language.prototypes(language.gram_counts(docs)))
    letters = language.letter_vectors().astype(int)

    def bundle(text):
        codes = [0]
        for c in (text or "").lower():
            code = ord(c) - 96 if "a" <= c <= "z" else 0
            if code or codes[-1]:
                codes.append(code)
        codes += [0] * (codes[-1] != 0)
        total = np.zeros(language.SIZE)
        for a, b, c in zip(codes, codes[1:], codes[2:]):
            if b:  # around a letter
                total += np.roll(letters[a], 2) * np.roll(letters[b], 1) * letters[c]
        return total

    profiles = {"en": bundle(rows[0][1]), "de": bundle(rows[1][1])}
    for r in found.collect():
        own = bundle(dict(rows)[r.doc_id])
        if not own.any():
            assert (r.lang_pred, r.score) == ("und", 0.0)
            continue
        cosines = {k: own @ v / np.linalg.norm(own) / np.linalg.norm(v) for k, v in profiles.items()}
        best = max(sorted(cosines), key=cosines.get)
        assert r.lang_pred == best and r.score == pytest.approx(max(cosines[best], 0), abs=1e-5)
