"""Deep pages, clustered tables and critical paths against sorting, filtering and searching everything."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from siltstone.operators import ordering
from siltstone.operators.eventlog import critical_path
from siltstone.operators.ordering import deep_page
from siltstone.sources.clustered import files_for, read_clustered, write_clustered


def some_rows(seed, n=3000):
    source = random.Random(seed)
    return [(source.choice([None, *range(5), *([3] * 8)]), source.choice([None, source.random()]), f"s{source.randrange(40)}", i) for i in range(n)]


SCHEMA = "a int, b double, s string, i int"


@pytest.mark.parametrize("order", [["a", "-b", "i"], ["-b", "a", "-i"], ["i"], ["-i"], ["s", "i"], ["a", "s", "i"]])
@pytest.mark.parametrize("few, ranges", [(100_000, 256), (50, 8)])
def test_deep_pages(spark, order, few, ranges):
    df = spark.createDataFrame(some_rows(1), SCHEMA).repartition(3)
    every = df.orderBy(*(F.desc(n[1:]) if n[0] == "-" else n for n in order)).collect()
    for offset, limit in ((0, 5), (1777, 20), (2990, 50), (3000, 5), (5000, 1), (1500, 0)):
        assert deep_page(df, order, offset, limit, ranges, few).collect() == every[offset : offset + limit]


def test_a_deep_page_sorts_little(spark, monkeypatch):
    """What reaches the sort is near the page, in rows that mostly tie in the first column as well."""
    df = spark.range(200_000).select((F.col("id") % 2).alias("a"), F.xxhash64("id").alias("b"))
    got = deep_page(df, ["a", "b"], 150_000, 10, few=2000)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    rest = df.where("a = 1").count()
    assert got.count() == 10 and rest == 100_000
    assert got.collect() == df.orderBy("a", "b").offset(150_000).limit(10).collect()
    assert "Offset 150000" not in plan
    offset = int(plan.split("Offset ")[1].split()[0])
    assert offset < 2000
    assert deep_page(df.limit(0), ["a"], 3, 4).collect() == [] and ordering.FEW == 100_000


def test_filters_on_two_columns_open_few_files(spark, tmp_path, rows):
    df = spark.range(40_000).select(F.expr("CAST(rand(3) * 1000 AS INT)").alias("x"), F.expr("rand(4) * 1000").alias("y"), "id")
    df = df.withColumn("x", F.when(F.col("id") % 97 != 0, F.col("x")))
    path = write_clustered(df, str(tmp_path / "table"), ["x", "y"], files=64)
    stored = spark.read.parquet(path)
    assert stored.count() == 40_000 and stored.columns == df.columns
    every = files_for(spark, path, ["x", "y"], {})
    assert len(every) >= 50
    for wanted in ({"x": (200, 300), "y": (700.0, 800.0)}, {"y": (None, 100.0)}, {"x": (990, None)}, {"x": (2000, None)}):
        got = read_clustered(spark, path, ["x", "y"], wanted)
        condition = F.lit(True)
        for name, (low, high) in wanted.items():
            condition &= F.col(name).isNotNull() & (F.lit(low is None) | (F.col(name) >= F.lit(low))) & (F.lit(high is None) | (F.col(name) <= F.lit(high)))
        # not from the frame again: its numbers are random
        assert rows(got) == rows(stored.where(condition))
    both = files_for(spark, path, ["x", "y"], {"x": (200, 300), "y": (700.0, 800.0)})
    one = files_for(spark, path, ["x", "y"], {"y": (None, 100.0)})
    assert len(both) <= 0.15 * len(every) and len(one) <= 0.35 * len(every)
    assert files_for(spark, path, ["x", "y"], {"x": (2000, None)}) == []


def test_clustered_by_text(spark, tmp_path, rows):
    df = spark.createDataFrame(some_rows(2, 500), SCHEMA)
    path = write_clustered(df, str(tmp_path / "table"), ["s", "a"], files=8)
    got = read_clustered(spark, path, ["s", "a"], {"s": ("s3", "s3"), "a": (3, 3)})
    assert rows(got) == rows(df.where("s = 's3' AND a = 3"))


def longest(steps, feeds):
    seconds, waits = defaultdict(dict), defaultdict(set)
    for run, flow, n in steps:
        seconds[run][flow] = seconds[run].get(flow, 0) + n
    for a, b in feeds:
        waits[b].add(a)

    def end(run, flow):
        before = max((end(run, w) for w in waits[flow] if w in seconds[run]), default=(0, []))
        return before[0] + seconds[run][flow], [*before[1], flow]

    return {run: max((end(run, f) for f in flows), key=lambda e: e[0]) for run, flows in seconds.items()}


def test_critical_paths(spark):
    source = random.Random(6)
    steps = [(run, f"f{i}", source.randrange(1, 10**6)) for run in range(4) for i in range(15) if source.random() < 0.8]
    feeds = [(f"f{a}", f"f{b}") for a in range(15) for b in range(a + 1, 15) if source.random() < 0.25] + [("f1", "f2"), ("nowhere", "f3")]
    own = spark.createDataFrame(steps, "run int, flow string, seconds long")
    got = critical_path(own, spark.createDataFrame(feeds, "source string, target string")).orderBy("run", "position").collect()
    for run, (total, chain) in longest(steps, feeds).items():
        mine = [r for r in got if r.run == run]
        assert [r.flow for r in mine] == chain and [r.position for r in mine] == list(range(1, len(chain) + 1))
        assert mine[-1].finished_after == total and sum(r.seconds for r in mine) == total
    circle = spark.createDataFrame([("f1", "f2"), ("f2", "f1")], "source string, target string")
    both = spark.createDataFrame([(0, "f1", 3), (0, "f2", 4)], "run int, flow string, seconds long")
    with pytest.raises(ValueError, match="circle"):
        critical_path(both, circle)
    assert critical_path(own.limit(0), circle).collect() == []
