"""The filter audit against applying every order of the filters one by one."""

import math
import re
from itertools import permutations

import duckdb
import pytest
from pyspark.sql import functions as F

from siltstone.llm import filter_audit, sql
from siltstone.llm.queries import QUERIES


def fails(rows):
    """The letters of the conditions that each (doc_id, text, lang) meets."""
    out = []
    for doc, text, _ in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        found = "A" * (len(words) < 200) + "B" * (100 * len(set(words)) < 50 * len(words))
        found += "C" * (100 * len(re.findall("[A-Z]", text)) > 3 * len(text)) + "D" * bool(re.search(r"[#$%&*|]", text))
        found += "E" * any(d is not None and doc is not None and d < doc and (t or "") == text for d, t, _ in rows)
        out.append(found)
    return out


def brute(rows, labels):
    good, toxic = ({d for d, q, t in labels if d is not None and (q, t)[i] == 1} for i in range(2))
    failed, out = fails(rows), []
    for part in {lang or "" for *_, lang in rows}:
        own = [(f, doc in good, doc in toxic) for f, (doc, _, lang) in zip(failed, rows, strict=True) if (lang or "") == part]
        removed = {}
        table = []
        for order in permutations("ABCDE"):
            left = own
            for step, letter in enumerate(order):
                gone = [d for d in left if letter in d[0]]
                left = [d for d in left if letter not in d[0]]
                redundant = sum(letter in d[0] for d in own) - len(gone)
                alone = sum(d[0] == letter for d in own)
                table.append([part, "".join(order), step + 1, len(left), len(gone), redundant, alone, sum(d[1] for d in gone), sum(d[2] for d in gone), letter])
                removed[letter] = removed.get(letter, 0) + len(gone)
        out += [(*row[:9], removed[row[9]]) for row in table]
    return out


COLUMNS = "part filter_order step kept removed redundant unique_fails good_lost toxic_lost shapley".split()
ROWS = [
    (1, "a b c " * 80, "en"), (2, "A b " * 120, "en"), (3, "x# y", "de"), (4, None, None), (5, "", "en"), (5, "", "en"), (6, "x# y", "en"),
    (None, "x# y", "en"), (None, "x# y", ""), (7, " ".join(map(str, range(250))), "fr"), (8, " ".join(map(str, range(250))), "fr"),
    (9, " ".join(f"Ä{i}" for i in range(300)), "fr"), (8, "ÀÉ É", "de"), (-3, "a b c " * 80, "es"), (10, "W" * 5000, "es"), (11, "$ " * 300, "es"),
]
LABELS = [(1, 1, 0), (2, 0, 1), (2, 1, 0), (3, 1, 1), (5, 1, None), (7, None, 1), (8, 1, 0), (None, 1, 1), (99, 1, 1), (8, 1, 0)]


@pytest.fixture
def tables(spark, tmp_path):
    def make(rows, labels):
        docs = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], "doc_id bigint, text string, lang string, part string, mask string, n string")
        docs.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
        spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
        return str(tmp_path)

    return make


def test_edge_cases(spark, tables):
    path = tables(ROWS, LABELS)
    got = sorted(map(tuple, QUERIES["op12_filter_audit"](spark, path).select(COLUMNS).collect()))
    assert got == sorted(brute(ROWS, LABELS))
    duck = duckdb.connect()
    for name in ("documents", "labels"):
        duck.sql(f"CREATE VIEW {name} AS SELECT * FROM '{path}/{name}.parquet/*.parquet'")
    assert sorted(duck.sql(sql.FILTER_ORDERS).select(*COLUMNS).fetchall()) == got


def test_a_large_group_of_copies(spark, tables):
    rows = [(i, "same text", ["en", "de"][i % 2]) for i in range(400)] + [(1000 + i, f"own {i}", "en") for i in range(50)]
    got = {r.filter_order[r.step - 1]: r for r in QUERIES["op12_filter_audit"](spark, tables(rows, [])).where("part = 'de' AND step = 1").collect()}
    assert (got["E"].removed, got["E"].kept, got["A"].removed, got["E"].unique_fails) == (200, 0, 200, 0)
    # those of the copies are shared evenly between A and E: half of all orders apply either first
    assert got["E"].shapley == got["A"].shapley == 200 * 60


def test_nothing(spark, tables):
    assert QUERIES["op12_filter_audit"](spark, tables([], [])).collect() == []


def test_path_counts():
    for n in range(1, 6):
        forward, backward = filter_audit.path_counts(n)
        for state in range(1 << n):
            size = state.bit_count()
            assert (forward[state], backward[state]) == (math.factorial(size), math.factorial(n - size))


def test_other_filters(spark):
    docs = spark.createDataFrame([(i, "x" * i, None) for i in range(20)], "doc_id int, text string, lang string")
    rules = {"S": F.length("text") < 5, "L": F.length("text") > 15, "N": F.lit(None).cast("boolean")}
    counted = filter_audit.profile(filter_audit.failures(docs, rules), spark.createDataFrame([], "doc_id int"), 3, {})
    out = filter_audit.audit(counted, "SLNC", [])
    assert out.count() == 24 * 4
    assert {(r.filter, r.removed, r.shapley) for r in out.selectExpr("substring(filter_order, step, 1) filter", "removed", "shapley").collect()} == {
        ("S", 5, 120), ("L", 4, 96), ("N", 0, 0), ("C", 0, 0)
    }
    with pytest.raises(ValueError, match="at most"):
        filter_audit.audit(counted, "ABCDEFGH", [])
