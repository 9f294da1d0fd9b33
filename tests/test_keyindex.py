"""The key index against counting all rows after every run."""

import random
from collections import Counter

import pytest

from siltstone.sources.readers import stream_table
from siltstone.streaming import keyindex
from siltstone.streaming.keyindex import KeyIndex, run_unique

SCHEMA = "a bigint, b string, other int"


def some_rows(seed, n, spread):
    source = random.Random(seed)
    return [(source.choice([None] + [source.randrange(spread)] * 9), source.choice(["x", "y", None] if source.random() < 0.1 else ["x", "y"]), i) for i in range(n)]


def brute(rows):
    times = Counter(r[:2] for r in rows if r[0] is not None and r[1] is not None)
    return sorted(((*k, n) for k, n in times.items() if n > 1), key=repr)


@pytest.mark.parametrize("most_runs, bucket_keys", [(12, 1 << 20), (2, 40)])
def test_every_slice(spark, tmp_path, rows, monkeypatch, most_runs, bucket_keys):
    monkeypatch.setattr(keyindex, "MOST_RUNS", most_runs)
    monkeypatch.setattr(keyindex, "BUCKET_KEYS", bucket_keys)
    landing, root, seen = str(tmp_path / "landing"), str(tmp_path / "unique"), []
    for number, size in enumerate((200, 30, 1, 120)):
        new = some_rows(number, size, 400) + [(7, "x", 0)] * 40 * (number > 1)
        seen += new
        spark.createDataFrame(new, SCHEMA).coalesce(2).write.mode("append").parquet(landing)
        index = run_unique(spark, stream_table(spark, landing, SCHEMA), ["a", "b"], root)
        assert rows(index.repeated()) == brute(seen)
        assert len(index.runs()) <= most_runs
    asked = [(1000, "x", 1), (seen[0][0], seen[0][1], 2), (None, "x", 3), (7, "z", 4)]
    known = {r[:2] for r in seen if None not in r[:2]}
    missing = index.missing(spark.createDataFrame(asked, "ka bigint, kb string, n int"), ["ka", "kb"])
    assert rows(missing) == sorted((r for r in asked if None not in r[:2] and r[:2] not in known), key=repr)


def test_a_batch_again(spark, tmp_path, rows):
    index = KeyIndex(spark, ["a", "b"], spark.createDataFrame([], SCHEMA).schema, str(tmp_path / "index"))
    first, second = some_rows(1, 80, 60), some_rows(2, 80, 60)
    for batch, part in ((0, first), (1, second), (1, second)):
        index.add(spark.createDataFrame(part, SCHEMA), batch)
        assert rows(index.repeated()) == brute(first + second * (batch > 0))


def test_the_filter(spark, tmp_path):
    """It excludes no key that is there, hardly lets others pass, and leaves buckets without hits closed."""
    schema = spark.createDataFrame([], "k bigint").schema
    index = KeyIndex(spark, ["k"], schema, str(tmp_path / "index"))
    index.add(spark.range(20_000).toDF("k"), 0)
    (run,) = index.runs()
    assert run.blocks == 8
    assert index.candidates(spark.range(20_000).toDF("k"), run).count() == 20_000
    strangers = index.candidates(spark.range(10**6, 10**6 + 20_000).toDF("k"), run).count()
    assert 0 < strangers < 600
    assert index.found(spark.range(10**6, 10**6 + 20_000).toDF("k")).collect() == []


def test_only_new_rows_are_read(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(keyindex, "BUCKET_KEYS", 100)
    landing, root = str(tmp_path / "landing"), str(tmp_path / "unique")
    spark.range(5000).selectExpr("id AS k").write.parquet(landing)
    run_unique(spark, stream_table(spark, landing, "k bigint"), ["k"], root)
    opened = []
    real = KeyIndex._keys_of

    def watch(self, run):
        opened.append(run)
        return real(self, run)

    monkeypatch.setattr(KeyIndex, "_keys_of", watch)
    spark.range(10**7, 10**7 + 3).selectExpr("id AS k").write.mode("append").parquet(landing)
    index = run_unique(spark, stream_table(spark, landing, "k bigint"), ["k"], root)
    # new keys that the filter knows to be new open no bucket of older ones
    assert opened == [] and index.repeated().collect() == []
    spark.createDataFrame([(17,)], "k bigint").write.mode("append").parquet(landing)
    assert run_unique(spark, stream_table(spark, landing, "k bigint"), ["k"], root).repeated().collect() == [(17, 2)]
    assert len(opened) == 1
