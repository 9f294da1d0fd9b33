"""Stored sketches: counts and extremes exact, all else within the bounds of the sketches."""

import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from siltstone.operators.sketches import distribution_drift, kll_error, merge, profile_of, sketch

SCHEMA = "day string, v double, n int, s string, t timestamp_ntz, empty int"
COLUMNS = ["v", "n", "s", "t", "empty"]


def make(spark, seed, n, shift=0.0):
    source = random.Random(seed)
    rows = [
        (source.choice(["a", "b", None]), source.choice([None, source.gauss(shift, 1)]), source.randrange(50), source.choice([None, "x", "y", f"s{source.randrange(20)}"]), None, None)
        for _ in range(n)
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    return rows, df.withColumn("t", F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_interval(0, 0, 0, n)"))


def test_profile_of_parts(spark):
    rows, df = make(spark, 1, 6000)
    stored = sketch(df, "day", COLUMNS)
    assert stored.count() == 3 * len(COLUMNS)
    for wanted in (["a", "b", None], ["a"], [None]):
        part = merge(stored.where(F.col("part").isin([w for w in wanted if w]) | (F.col("part").isNull() if None in wanted else F.lit(False))))
        got = {r.column_name: r for r in profile_of(part).collect()}
        own = [r for r in rows if r[0] in wanted]
        for place, name in enumerate(["v", "n", "s"], 1):
            values = [r[place] for r in own if r[place] is not None]
            assert (got[name].rows, got[name].nulls) == (len(own), len(own) - len(values))
            distinct = len(set(values))
            assert abs(got[name].distinct_values - distinct) <= 0.03 * distinct
            if name == "s":
                assert (got[name].min_text, got[name].max_text, got[name].quantiles) == (min(values), max(values), None)
                continue
            assert (got[name].min_value, got[name].max_value) == (min(values), max(values))
            values.sort()
            for share, value in zip((0.25, 0.5, 0.75), got[name].quantiles, strict=True):
                below, upto = (sum(f(x, value) for x in values) / len(values) for f in (lambda x, y: x < y, lambda x, y: x <= y))
                assert below - kll_error() <= share <= upto + kll_error()
        assert (got["empty"].nulls, got["empty"].min_value, got["empty"].distinct_values) == (len(own), None, 0)


def exact_distance(x, y):
    return max(abs(sum(a <= p for a in x) / len(x) - sum(b <= p for b in y) / len(y)) for p in {*x[::7], *y[::7]})


@pytest.mark.parametrize("shift", [0.0, 0.3, 3.0])
def test_drift(spark, shift):
    left, right = make(spark, 2, 3000), make(spark, 3, 3000, shift)
    b, c = (merge(sketch(df, "day", COLUMNS)) for _, df in (left, right))
    got = {r.column_name: r for r in distribution_drift(b, c).collect()}
    x, y = ([r[1] for r in rows if r[1] is not None] for rows, _ in (left, right))
    error = 2 * kll_error() + 3 / 250
    assert abs(got["v"].distance - exact_distance(x, y)) <= error
    edges = sorted(x)[len(x) // 10 :: len(x) // 10][:9]
    share = lambda values: [max(sum(lo < v <= hi for v in values) / len(values), 1e-4) for lo, hi in zip([-math.inf, *edges], [*edges, math.inf], strict=True)]
    psi = sum((q - p) * math.log(q / p) for p, q in zip(share(x), share(y), strict=True))
    assert got["v"].psi == pytest.approx(psi, rel=0.35, abs=0.03)
    assert got["v"].distance < 0.1 if shift == 0 else got["v"].distance > 0.08
    # values by hash: all of few values are told apart
    p, q = (Counter(r[3] for r in rows if r[3] is not None) for rows, _ in (left, right))
    want = sum((q[k] / q.total() - p[k] / p.total()) * math.log((q[k] / q.total()) / (p[k] / p.total())) for k in p)
    assert got["s"].psi == pytest.approx(want, abs=0.01) and got["s"].distance is None
    assert got["s"].distinct_shared == 22 and got["n"].distinct_shared == 50
    assert got["empty"].psi is None and got["empty"].distance is None


def test_nothing(spark):
    _, df = make(spark, 1, 5)
    empty = merge(sketch(df.limit(0), "day", COLUMNS))
    assert empty.collect() == [] and profile_of(empty).collect() == []
    one = distribution_drift(merge(sketch(df, "day", ["n", "s"])), merge(sketch(df, "day", ["n"])))
    assert {r.column_name: r.psi is None for r in one.collect()} == {"n": False, "s": True}
