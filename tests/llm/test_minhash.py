from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from test_repeats import words_of

from siltstone.llm import minhash
from siltstone.llm.components import components


def shingles(text):
    words = words_of(text)
    return Counter(tuple(words[i : i + 5]) for i in range(max(len(words) - 4, 1))) if words else Counter()


def similarity(a, b):
    return sum((a & b).values()) / max(sum((a | b).values()), 1)


def classes_of(rows, linked):
    """Smallest id of each row's component; rows without words stand alone."""
    bags = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if bags[i] and bags[j] and linked(bags[i], bags[j]):
                root[find(i)] = find(j)
    groups = defaultdict(list)
    for i, (doc, _) in enumerate(rows):
        groups[find(i)].append(doc)
    return [min((d for d in groups[find(i)] if d is not None), default=None) for i in range(len(rows))]


def test_classes(docs_of, texts, untouched):
    out = minhash.classify(docs_of(texts))
    untouched(out)
    want = [(d, t, c, d == c) for (d, t), c in zip(texts, classes_of(texts, lambda a, b: similarity(a, b) >= 0.8), strict=True)]
    got = [tuple(r) for r in out.select("doc_id", "text", "class_id", "kept").collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_one_of_each_class_survives(docs_of, texts):
    kept = [tuple(r) for r in minhash.survivors(docs_of(texts)).select("doc_id", "text").collect()]
    assert len(kept) == len(set(kept))
    assert sorted(kept, key=repr) == sorted({(d, t) for (d, t), c in zip(texts, classes_of(texts, lambda a, b: similarity(a, b) >= 0.8), strict=True) if d == c}, key=repr)


def test_copies_of_a_base_and_texts_around_one_passage(docs_of):
    # copies are near the base but not near each other; the others share much, but not enough
    base = [f"w{i}" for i in range(200)]
    rows = [(1000, " ".join(base))]
    for i in range(40):
        words = list(base)
        for j in range(3):
            words[(7 * i + 60 * j) % 190 + 5] = f"x{i}_{j}"
        rows.append((i, " ".join(words)))
    rows += [(500 + i, " ".join([*base[:100], *(f"y{i}_{j}" for j in range(30))])) for i in range(40)]
    want = classes_of(rows, lambda a, b: similarity(a, b) >= 0.8)
    got = {r.doc_id: r.class_id for r in minhash.classify(docs_of(rows)).collect()}
    assert got == dict(zip([d for d, _ in rows], want, strict=True))
    assert len({got[i] for i in range(40)}) == 1 and len({got[500 + i] for i in range(40)}) == 40


def test_no_rows(docs_of):
    assert minhash.classify(docs_of([]).limit(0)).collect() == []


def test_agreement_is_weighted_similarity():
    a, b = "x " * 30 + " ".join(f"a{i}" for i in range(60)), "x " * 50 + " ".join(f"a{i}" for i in range(40))
    owner, elements = minhash.shingle_layers(pa.array([a, b]), 5)
    signature = minhash.throw_darts(owner, elements, 2, 4096)
    expected = similarity(shingles(a), shingles(b))
    assert abs((signature[0] == signature[1]).mean() - expected) < 0.04
    assert len(np.unique(signature[0])) > 4000


def test_short_and_empty_rows():
    owner, elements = minhash.shingle_layers(pa.array(["", None, "one", "one two three four five six"]), 5)
    assert np.bincount(owner, minlength=4).tolist() == [0, 0, 1, 2]
    assert (minhash.throw_darts(owner, elements, 4, 128)[:2] == 0).all()


def test_components(spark):
    links = [(i, i + 1) for i in range(1, 60)] + [(100, 200), (200, 300), (300, 100), (7, 7), (900, 900), (None, 5)]
    got = dict(components(spark.createDataFrame(links, "a long, b long")).collect())
    assert got == {**{i: 1 for i in range(1, 61)}, 100: 100, 200: 100, 300: 100, 900: 900}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_equal_texts_without_words_are_a_class(docs_of, untouched):
    rows = [(5, ""), (3, None), (9, ""), (7, " \n"), (8, " \n"), (6, "\t"), (1, "word"), (None, "")]
    out = minhash.classify(docs_of(rows), wordless=True)
    untouched(out)
    got = {(r.doc_id, r.text): (r.class_id, r.kept) for r in out.collect()}
    assert got == {(d, t): (c, d == c) for (d, t), c in zip(rows, [3, 3, 3, 7, 7, 6, 1, 3], strict=True)}
    assert sorted(r.doc_id for r in minhash.survivors(docs_of(rows), wordless=True).collect()) == [1, 3, 6, 7]
