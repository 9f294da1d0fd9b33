"""Joins as of a time against looking the version up fact by fact."""

import random

import pytest
from pyspark.sql import functions as F

from siltstone.operators.asof import enrich_as_of
from siltstone.sources.readers import stream_table
from siltstone.streaming.enrich import run_enriched_as_of

FACTS, VERSIONS = "id int, key string, t int, name string", "key string, since int, till int, name string, score int"


def brute(facts, versions, ends=True):
    out = []
    for id_, key, t, name in facts:
        rank = lambda v: (v[1], v[3] or "", v[4] is not None, v[4] or 0, v[2] is not None, v[2] or 0)
        found = [v for v in versions if key is not None and t is not None and v[0] == key and v[1] is not None and v[1] <= t]
        best = max(found, key=rank, default=None)
        if best and ends and best[2] is not None and t >= best[2]:
            best = None
        out.append((id_, key, t, name, *((best[3], best[4]) if best else (None, None))))
    return sorted(out, key=repr)


def make(seed, hot, n=900):
    source = random.Random(seed)
    keys = ["hot"] * hot + ["a", "b", "c", "lonely"] + [None] * (hot > 0)
    facts = [(i, source.choice(keys), source.choice([*range(200), None]) if i % 50 == 0 else source.randrange(200), f"f{i}") for i in range(n)]
    versions = []
    for i in range(n // 2):
        since = source.randrange(0, 220, 3)
        versions.append((source.choice([k for k in keys if k != "lonely"]), since, source.choice([None, since + source.randrange(1, 20)]), f"v{source.randrange(5)}", source.choice([None, i])))
    return facts, [*versions, ("a", None, None, "timeless", 1)]


@pytest.mark.parametrize("shares, hot", [(4096, 0), (8, 6), (40, 6)])
def test_as_of(spark, rows, shares, hot):
    """Also with one key in more than a third of all rows, cut into chunks that hand over their last version."""
    facts, versions = make(shares, hot)
    left, right = spark.createDataFrame(facts, FACTS), spark.createDataFrame(versions, VERSIONS).repartition(3)
    for ends in (True, False):
        got = enrich_as_of(left, right, ["key"], "t", "since", ["name", "score"], {"name": "version"}, "till" if ends else None, shares)
        assert got.columns == ["id", "key", "t", "name", "version", "score"]
        want = brute(facts, versions if ends else [(*v[:2], None, *v[3:]) for v in versions], ends)
        assert rows(got) == want
    assert any(w[4] for w in want) and any(not w[4] for w in want)


def test_a_chunk_takes_over_from_chunks_far_before(spark, rows):
    """One version long ago, then nothing but facts of its key."""
    facts = spark.range(5000).select(F.lit("k").alias("key"), F.col("id").alias("t"))
    versions = spark.createDataFrame([("k", 10, "only")], "key string, since long, v string")
    got = enrich_as_of(facts, versions, ["key"], "t", "since", ["v"], shares=30)
    assert got.groupBy("v").count().orderBy("v").collect() == [(None, 10), ("only", 4990)]


def test_nothing_on_one_side(spark):
    facts, versions = spark.createDataFrame([(1, "a", 5, "x")], FACTS), spark.createDataFrame([], VERSIONS)
    assert enrich_as_of(facts, versions, ["key"], "t", "since", ["score"]).collect() == [(1, "a", 5, "x", None)]
    assert enrich_as_of(facts.limit(0), versions, ["key"], "t", "since", ["score"]).collect() == []
    with pytest.raises(ValueError, match="name"):
        enrich_as_of(facts, versions, ["key"], "t", "since", ["name"])


def test_several_keys_and_one_shuffle_of_the_facts(spark, rows):
    facts = spark.createDataFrame([(1, "x", 5), (1, "y", 5), (2, "x", 1)], "a int, b string, t int")
    versions = spark.createDataFrame([(1, "x", 3, 1.5), (1, "y", 5, 2.5), (2, "x", 2, 3.5)], "a int, b string, since int, v double")
    got = enrich_as_of(facts, versions, ["a", "b"], "t", "since", ["v"])
    assert rows(got) == sorted([(1, "x", 5, 1.5), (1, "y", 5, 2.5), (2, "x", 1, None)], key=repr)


def test_late_rows_of_a_stream(spark, tmp_path, rows):
    facts, versions = make(3, 2, 200)
    known = spark.createDataFrame(versions, VERSIONS)
    landing, out, mark = (str(tmp_path / p) for p in ("landing", "out", "mark"))
    for part in (facts[100:], facts[:100]):
        spark.createDataFrame(part, FACTS).write.mode("append").parquet(landing)
        stream = stream_table(spark, landing, FACTS)
        run_enriched_as_of(stream, lambda: known, ["key"], "t", "since", ["name", "score"], {"name": "version"}, out, mark, "till")
    assert rows(spark.read.parquet(out).drop("__siltstone_batch")) == brute(facts, versions)
