"""Change targets of split buckets and deltas: same rows as the whole feed gives, at the cost of what is new."""

import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from test_cdc import FEED, SCHEMA, expected_scd1, expected_scd2

from siltstone.sources.readers import stream_table
from siltstone.streaming import target
from siltstone.streaming.cdc import Feed, refresh_target
from siltstone.streaming.target import Bucket, bring_up_to_date, bucket_of, read_manifest, read_target

FLOW = Feed(["id"], "seq", "op = 'DELETE'", ["op", "seq"])
EXPECTED = {1: expected_scd1, 2: expected_scd2}


class Landing:
    """Feeds a target run by run."""

    def __init__(self, spark, path, scd_type, **options):
        self.spark, self.root, self.landing, self.scd_type, self.options = spark, f"{path}/target", f"{path}/landing", scd_type, options
        self.seen = []

    def run(self, changes, schema=SCHEMA):
        self.spark.createDataFrame(changes, schema).coalesce(1).write.mode("append").parquet(self.landing)
        self.seen += changes
        before = self.files()
        refresh_target(self.spark, stream_table(self.spark, self.landing, schema), FLOW, self.scd_type, self.root, "followed", **self.options)
        return {p: s for p, s in self.files().items() if p not in before}

    def files(self):
        """Data files of the target, without log, checkpoint and manifest."""
        return {p: p.stat().st_size for p in Path(self.root).glob("*/*/*.parquet") if p.parts[-3].startswith(("base-", "delta-"))}

    def check(self, rows):
        assert rows(self.spark.table("followed")) == EXPECTED[self.scd_type](self.seen)
        assert rows(read_target(self.spark, FLOW, self.scd_type, self.root)) == EXPECTED[self.scd_type](self.seen)


def some_changes(seed, n, keys, first):
    source = random.Random(seed)
    return [
        (source.choice(keys), f"n{source.randrange(50)}", f"c{source.randrange(9)}", source.choice(["UPDATE"] * 4 + ["DELETE"]), source.randrange(first, first + 300))
        for _ in range(n)
    ]


@pytest.mark.parametrize("scd_type", [1, 2])
def test_a_run_writes_what_it_brings(spark, tmp_path, rows, scd_type):
    """Touching a few keys of many adds a few small files; every byte of the load stays where it is."""
    flow = Landing(spark, tmp_path, scd_type, most_bytes=20_000)
    source = random.Random(5)
    load = [(i, f"{source.random()}", f"{source.random()}", "INSERT", i) for i in range(6000)]
    loaded = sum(flow.run(load).values())
    assert len(read_manifest(spark, flow.root).buckets) >= 4
    old = flow.files()
    for count in (2, 20):
        new = flow.run([(i * 37, "new", "x", "UPDATE", 10_000 + i + count) for i in range(count)])
        assert sum(new.values()) < count * 2500 and sum(new.values()) < loaded / 5
        assert all(p.parts[-3].startswith("delta-") for p in new)
    assert set(old) <= set(flow.files())
    flow.check(rows)


@pytest.mark.parametrize("scd_type", [1, 2])
def test_any_changes_in_any_order(spark, tmp_path, rows, scd_type):
    """Late, repeated and tied changes, deletes, a key with most of them, and null keys, in small buckets."""
    flow = Landing(spark, tmp_path, scd_type, most_bytes=3000)
    keys = [7] * 60 + list(range(40)) + [None] * 3
    for number, first in enumerate((1000, 0, 500, 1100)):
        changes = some_changes(number, 150 if number < 3 else 12, keys, first)
        flow.run([*changes, *changes[:5]])
        flow.check(rows)
    assert len(read_manifest(spark, flow.root).buckets) > 4


def test_worked_example(spark, tmp_path, rows):
    flow = Landing(spark, tmp_path, 2)
    flow.run(FEED[2:])
    flow.run(FEED[:2])
    flow.check(rows)


def test_one_key_is_never_split(spark, tmp_path, rows):
    flow = Landing(spark, tmp_path, 2, most_bytes=2000)
    flow.run([(3, f"n{i}", "c", "UPDATE", i) for i in range(900)])
    assert list(read_manifest(spark, flow.root).buckets) == ["0-0"]
    flow.check(rows)


def test_many_small_deltas_are_joined_and_large_ones_folded(spark, tmp_path, rows, monkeypatch):
    monkeypatch.setattr(target, "MOST_DELTAS", 2)
    flow = Landing(spark, tmp_path, 1)
    flow.run([(i, f"name {i * 7919}", "c", "INSERT", i) for i in range(4000)])
    base = read_manifest(spark, flow.root).buckets["0-0"].base
    for i in range(4):
        flow.run([(i, "again", "c", "UPDATE", 9000 + i)])
        assert len(read_manifest(spark, flow.root).buckets["0-0"].deltas) <= 2
    assert read_manifest(spark, flow.root).buckets["0-0"].base == base
    flow.run([(i, f"other {i * 104729}", "c", "UPDATE", 9100 + i) for i in range(3000)])
    after = read_manifest(spark, flow.root).buckets["0-0"]
    assert after.base != base and after.deltas == ()
    flow.check(rows)


def test_new_columns_are_null_in_older_rows(spark, tmp_path, rows):
    flow = Landing(spark, tmp_path, 1)
    flow.run(FEED)
    flow.run([(9, "Eve", "Daejeon", "INSERT", 9, 5.0)], f"{SCHEMA}, score double")
    got = {r.id: r.score for r in spark.table("followed").collect()}
    assert got == {1: None, 2: None, 4: None, 9: 5.0}


def test_nothing_new(spark, tmp_path, rows):
    flow = Landing(spark, tmp_path, 2)
    flow.run(FEED)
    version = read_manifest(spark, flow.root).version
    assert flow.run([]) == {} and read_manifest(spark, flow.root).version == version
    assert not bring_up_to_date(spark, FLOW, 2, flow.root)
    with pytest.raises(ValueError, match="no run"):
        read_target(spark, FLOW, 2, str(tmp_path / "nowhere"))


def test_every_row_has_one_bucket(spark):
    names = ["1-0", "2-1", "3-3", "3-7"]
    found = spark.range(2000).select(F.xxhash64("id").alias("h"), bucket_of(["id"], names).alias("b")).collect()
    assert {r.b for r in found} == set(names)
    assert all((r.h & ((1 << int(r.b[0])) - 1)) == int(r.b[2:]) for r in found)
    assert Bucket("a", 5, (("b", 2), ("c", 3))).delta_bytes == 5
