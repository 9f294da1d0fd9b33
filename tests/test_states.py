"""Gold tables from partial states: equal to grouping all rows, whatever the batches."""

import random

import pytest
from pyspark.sql import functions as F

from siltstone.sources.readers import stream_table
from siltstone.streaming import states
from siltstone.streaming.states import Gold, read_gold, run_gold

SCHEMA = "g string, h int, v long, w double, s string"
GOLD = Gold(
    {"g": "g", "half": "h DIV 2"},
    {"n": ("count", "*"), "filled": ("count", "v"), "total": ("sum", "v"), "mean_v": ("mean", "v"), "low": ("min", "w"), "high": ("max", "s"), "vs": ("distinct", "v"), "ss": ("distinct", "s"), "hs": ("distinct", "h % 3")},
)


def some_rows(seed, n):
    source = random.Random(seed)
    value = lambda: source.choice([None, -40_000, -1, 0, 1, 32_768, 32_769, source.randrange(10**12)])
    return [(source.choice(["hot"] * 4 + ["a", None]), source.randrange(6), value(), source.choice([None, 1.5, -2.25]), source.choice([None, "x", "", f"s{source.randrange(9)}"])) for _ in range(n)]


def brute(rows):
    out, groups = [], {}
    for g, h, v, w, s in rows:
        groups.setdefault((g, h // 2), []).append((h, v, w, s))
    for (g, half), found in groups.items():
        vs, ws, ss = ([x for x in column if x is not None] for column in list(zip(*found, strict=True))[1:])
        total = sum(vs) if vs else None
        out.append((g, half, len(found), len(vs), total, total / len(vs) if vs else None, min(ws, default=None), max(ss, default=None), len(set(vs)), len(set(ss)), len({f[0] % 3 for f in found})))
    return sorted(out, key=repr)


@pytest.mark.parametrize("most", [16, 2])
def test_runs(spark, tmp_path, rows, monkeypatch, most):
    monkeypatch.setattr(states, "MOST_BATCHES", most)
    landing, root, seen = str(tmp_path / "landing"), str(tmp_path / "states"), []
    for number, size in enumerate((300, 1, 40, 200)):
        new = some_rows(number, size)
        seen += new
        spark.createDataFrame(new, SCHEMA).coalesce(1).write.mode("append").parquet(landing)
        assert run_gold(spark, stream_table(spark, landing, SCHEMA), GOLD, root) == size
        got = read_gold(spark, spark.createDataFrame([], SCHEMA).schema, GOLD, root)
        assert got.columns == [*GOLD.keys, *GOLD.measures]
        assert rows(got) == brute(seen)
        assert all("/states/" in f for f in got.inputFiles())
    assert run_gold(spark, stream_table(spark, landing, SCHEMA), GOLD, root) == 0
    folds = list((tmp_path / "states").glob("folded-*"))
    assert bool(folds) == (most == 2)
    sums = states.partial_sums(spark.createDataFrame([], SCHEMA), GOLD).schema
    read = [r[0] for r in states._states(spark, "sums", sums, root).select(F.input_file_name()).distinct().collect()]
    assert len({f.split("__siltstone_batch=")[1].split("/")[0] for f in read if "folded-" not in f}) <= most


def test_a_batch_again_replaces_itself(spark, tmp_path, rows):
    landing, root = str(tmp_path / "landing"), str(tmp_path / "states")
    spark.createDataFrame(some_rows(1, 50), SCHEMA).coalesce(1).write.parquet(landing)
    run_gold(spark, stream_table(spark, landing, SCHEMA), GOLD, root)
    # as if the run had ended before its commit
    commit = tmp_path / "states" / "checkpoint" / "commits" / "0"
    commit.unlink()
    (commit.parent / ".0.crc").unlink(missing_ok=True)
    run_gold(spark, stream_table(spark, landing, SCHEMA), GOLD, root)
    assert rows(read_gold(spark, spark.createDataFrame([], SCHEMA).schema, GOLD, root)) == brute(some_rows(1, 50))


def test_states_are_small(spark):
    """A bitmap holds up to 32,768 values, so states follow groups and spread, not rows."""
    data = spark.range(100_000).select(F.lit("g").alias("g"), F.lit(1).alias("h"), "id", F.lit(1.0).alias("w"), F.lit("s").alias("s")).toDF("g", "h", "v", "w", "s")
    assert states.partial_sums(data, GOLD).count() == 1
    assert states.partial_sets(data, GOLD).where("__measure = 'vs'").count() <= 5


def test_without_distinct_measures_and_without_measures(spark, tmp_path, rows):
    landing = str(tmp_path / "landing")
    spark.createDataFrame(some_rows(2, 30), SCHEMA).write.parquet(landing)
    for gold in (Gold({"g": "g"}, {"n": ("count", "*")}), Gold({"g": "g"}, {}), Gold({"g": "g"}, {"d": ("distinct", "s")})):
        root = str(tmp_path / f"states{len(gold.measures)}{len(gold.sets)}")
        run_gold(spark, stream_table(spark, landing, SCHEMA), gold, root)
        got = read_gold(spark, spark.createDataFrame([], SCHEMA).schema, gold, root)
        assert {r.g for r in got.collect()} == {"hot", "a", None}
    with pytest.raises(ValueError, match="median"):
        Gold({}, {"m": ("median", "v")})
