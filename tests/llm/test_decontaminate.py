import re

import pytest

from siltstone.llm.decontaminate import decontaminate


def words_of(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def brute(docs, items, window=10):
    wanted = {}
    for item, text in items:
        words = words_of(text)
        for i in range(max(len(words) - window, 0) + 1 if words else 0):
            wanted.setdefault(tuple(words[i : i + window]), set()).add(item)
    out = []
    for doc, text in docs:
        words, hit, found = words_of(text), set(), set()
        for size in {len(k) for k in wanted}:
            for i in range(len(words) - size + 1):
                names = wanted.get(tuple(words[i : i + size]))
                if names is not None:
                    hit |= set(range(i, i + size))
                    found |= {str(n) for n in names if n is not None}
        out.append((doc, len(words), len(hit), len(found), sorted(found), bool(hit)))
    return out


@pytest.mark.parametrize("shingle", [3, 1])
def test_windows(spark, docs_of, texts, untouched, shingle):
    base = words_of(texts[5][1])
    items = [(1, " ".join(base[10:40])), (2, " ".join(base[30:60]).upper() + "!"), (10, " ".join(base[10:40])), (3, "Word"), (4, "ab ab"), (5, ""), (6, None), (7, "..."), (None, " ".join(words_of(texts[3][1])[:12])), (8, "日本語 ß")]
    rows = texts + [(90, "-".join(base[12:22])), (91, " ".join(base[12:21])), (92, "x " + " ".join(base[30:40]) + " y " + " ".join(base[35:50]))]
    out = decontaminate(docs_of(rows), spark.createDataFrame(items, "item_id long, text string"), shingle=shingle)
    untouched(out)
    got = [(r.doc_id, r.n_words, r.n_hit, r.n_items, list(r.item_ids), r.contaminated) for r in out.collect()]
    assert sorted(got, key=repr) == sorted(brute(rows, items), key=repr)


def test_nothing_to_find(spark, docs_of, texts):
    none = spark.createDataFrame([], "item_id long, text string")
    out = decontaminate(docs_of(texts), none).collect()
    assert len(out) == len(texts) and not any(r.contaminated or r.n_items for r in out)
    assert decontaminate(docs_of([]).limit(0), none).collect() == []


def test_added_names_are_refused(spark):
    docs = spark.createDataFrame([(1, "a", 2)], "doc_id int, text string, n_hit int")
    items = spark.createDataFrame([(1, "b")], "item_id int, text string")
    with pytest.raises(ValueError, match="n_hit"):
        decontaminate(docs, items)
    assert decontaminate(docs, items, columns=["doc_id"]).count() == 1
