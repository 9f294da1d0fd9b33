"""Differing rows against a comparison of bags."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from siltstone.operators.reconcile import differing_rows, reconcile_rows

SCHEMA = "k {kind}, j int, a string, b double"


def brute(source, target):
    left, right = Counter(source), Counter(target)
    more, less = left - right, right - left
    out = []
    for key in {r[:2] for r in [*more, *less]}:
        s, t = ([r for r in bag.elements() if r[:2] == key] for bag in (more, less))
        changed = None
        if len(s) == len(t) == 1:
            changed = [c for c, x, y in zip("ab", s[0][2:], t[0][2:], strict=True) if x != y]
        out.append((*key, "missing" if not t else "unexpected" if not s else "changed", len(s), len(t), changed))
    return sorted(out, key=repr)


def copies(kind, seed, n=800, changes=12):
    source = random.Random(seed)
    key = {"bigint": lambda: source.choice([None, source.randrange(10**6)]) if source.random() < 0.02 else source.randrange(10**6), "string": lambda: f"k{source.randrange(300)}"}[kind]
    rows = [(key(), source.randrange(3), source.choice([None, "x", "y"]), source.choice([None, 0.5, 2.0])) for _ in range(n)]
    rows += rows[:5]
    other = list(rows)
    for _ in range(changes):
        i = source.randrange(len(other))
        how = source.randrange(4)
        if how == 0:
            del other[i]
        elif how == 1:
            other[i] = (*other[i][:2], "changed", other[i][3])
        elif how == 2:
            other.append((key(), 7, "new", None))
        else:
            other.append(other[i])
    source.shuffle(other)
    return rows, other


@pytest.mark.parametrize("kind", ["bigint", "string"])
@pytest.mark.parametrize("fan, leaf_rows", [(64, 200_000), (8, 20), (2, 1)])
def test_rows(spark, rows, kind, fan, leaf_rows):
    left, right = copies(kind, fan)
    schema = SCHEMA.format(kind=kind)
    source, target = spark.createDataFrame(left, schema).repartition(3), spark.createDataFrame(right, schema).repartition(2)
    assert rows(reconcile_rows(source, target, ["k", "j"], fan=fan, leaf_rows=leaf_rows)) == brute(left, right)


def test_equal_tables_and_empty_ones(spark, rows):
    left, _ = copies("bigint", 1)
    source = spark.createDataFrame(left, SCHEMA.format(kind="bigint"))
    assert reconcile_rows(source, source.orderBy("b"), ["k", "j"]).collect() == []
    empty = source.limit(0)
    assert rows(reconcile_rows(source, empty, ["k", "j"])) == brute(left, [])
    assert reconcile_rows(empty, empty, ["k", "j"]).collect() == []


def test_columns_to_compare(spark, rows):
    source = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0)], "k int, a string, b double")
    target = spark.createDataFrame([(1, "a", 9.0, 0), (2, "c", 2.0, 0)], "k int, a string, b double, more int")
    assert rows(reconcile_rows(source, target, ["k"], ["a"])) == [(2, "changed", 1, 1, ["a"])]
    assert rows(reconcile_rows(source, target, ["k"])) == [(1, "changed", 1, 1, ["b"]), (2, "changed", 1, 1, ["a"])]


def scanned(df):
    """Rows that the scan of a narrow query gives."""
    counted = df.select(F.col("k"))
    counted.collect()
    scan = counted._jdf.queryExecution().executedPlan().collectLeaves().head()
    return scan.metrics().apply("numOutputRows").value()


def test_equal_ranges_are_not_read_again(spark, tmp_path):
    """In files ordered by the key, what is looked at again is near the one row that differs."""
    whole = spark.range(0, 100_000, 1, 20).select(F.col("id").alias("k"), (F.col("id") % 7).alias("v"))
    changed = whole.withColumn("v", F.when(F.col("k") == 61_234, 100).otherwise(F.col("v")))
    for name, table in (("source", whole), ("target", changed)):
        table.write.option("parquet.block.size", 1 << 14).parquet(f"{tmp_path}/{name}")
    source, target = (spark.read.parquet(f"{tmp_path}/{name}") for name in ("source", "target"))
    left, right = differing_rows(source, target, ["k"], leaf_rows=500)
    assert scanned(source) == 100_000 and scanned(left) <= 5000 and scanned(right) <= 5000
    assert left.count() == right.count() <= 500
    assert reconcile_rows(source, target, ["k"], leaf_rows=500).collect() == [(61_234, "changed", 1, 1, ["v"])]
