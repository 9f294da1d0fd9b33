import pytest
from pyspark.sql import functions as F

from siltstone.operators.joins import enrich, known, readings_by, unknown
from siltstone.operators.skew import fits_broadcast, hot_keys, key_counts, skew_left_join


def facts(spark, n=9000):
    """A third of all rows under one key, another third under NULL; 12 input partitions."""
    key = F.when(F.col("id") % 3 == 0, F.lit(-1)).when(F.col("id") % 3 == 1, F.col("id"))
    return spark.range(0, n, 1, 12).select(key.alias("k"), F.col("id").alias("v"))


def reference(spark):
    return spark.range(9000).where("id % 2 = 0").selectExpr("id AS k", "id * 10 AS a").union(
        spark.createDataFrame([(-1, 7), (-1, 8), (None, 9)], "k long, a long")
    )


def test_hot_keys_are_few_and_right(spark, rows):
    counts = key_counts(facts(spark), ["k"])
    assert rows(hot_keys(counts, 64).select("k", "__fan")) == [(-1, 32)]
    assert hot_keys(key_counts(spark.range(100), ["id"]), 100).count() == 0


def test_join_equals_plain_left_join(spark):
    left, right = facts(spark), reference(spark)
    got, want = skew_left_join(left, right, ["k"]), left.join(right, ["k"], "left")
    assert got.columns == ["k", "v", "a"]
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_equal_names_need_a_rename(spark, rows):
    left = spark.createDataFrame([(1, 5), (2, 6)], "k int, level int")
    right = spark.createDataFrame([(1, 50)], "k int, level int")
    with pytest.raises(ValueError, match="both sides have level"):
        enrich(left, right, ["k"], ["level"])
    for limit in (0, 100):
        joined = enrich(left, right, ["k"], ["level"], {"level": "device_level"}, max_broadcast_rows=limit)
        assert rows(joined) == [(1, 5, 50), (2, 6, None)]


def test_hot_rows_in_one_partition_are_spread(spark):
    left = spark.range(0, 10_000, 1, 1).select(F.lit(1).alias("k"), F.col("id").alias("v"))
    right = spark.createDataFrame([(1, 7)], "k int, a int")
    plan = skew_left_join(left, right, ["k"], shares=64)
    salts = left.withColumn("salt", F.pmod(F.xxhash64(F.spark_partition_id(), "k", "v"), F.lit(64)))
    assert salts.groupBy("salt").count().where("count < 400").count() == 64
    assert plan.where("a = 7").count() == 10_000


@pytest.mark.parametrize("shares", [32, 4096])
def test_hot_and_null_rows_are_spread(spark, shares):
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold", "spark.sql.shuffle.partitions")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.shuffle.partitions", "16")
        joined = skew_left_join(facts(spark), reference(spark).where("k >= 0 OR a = 7"), ["k"], shares=shares)
        sizes = [r[1] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        for key, value in old.items():
            spark.conf.set(key, value)
    assert sum(sizes) == 9000 and max(sizes) < 3000


@pytest.mark.parametrize("limit", [0, 100_000], ids=["large reference", "small reference"])
def test_enrich_and_membership(spark, rows, limit):
    df = spark.createDataFrame([("a", 1), ("b", 2), (None, 3), ("x", 4)], "device_id string, v int")
    ref = spark.createDataFrame([("a", "m1", "up"), ("b", "m2", "down"), (None, "m3", "odd")], "device_id string, model string, status string")
    got = enrich(df, ref, ["device_id"], ["model", "status"], {"status": "device_status"}, limit)
    assert got.columns == ["device_id", "v", "model", "device_status"]
    assert rows(got) == sorted([("a", 1, "m1", "up"), ("b", 2, "m2", "down"), (None, 3, None, None), ("x", 4, None, None)], key=repr)
    assert rows(known(df, ref, ["device_id"], limit)) == [("a", 1), ("b", 2)]
    assert rows(unknown(df, ref, ["device_id"], limit)) == sorted([(None, 3), ("x", 4)], key=repr)


def test_readings_by_sums_before_the_join(spark, rows):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("b", None), ("c", 9.0), (None, 1.0)], "device_id string, value double")
    dim = spark.createDataFrame([("a", "north"), ("b", "north"), ("c", None)], "device_id string, region string")
    assert rows(readings_by(df, dim, "device_id", "region", "value")) == sorted([("north", 3, 1.5, 2), (None, 1, 9.0, 1)], key=repr)


def test_fits_broadcast(spark):
    assert fits_broadcast(spark.range(10), 10) and not fits_broadcast(spark.range(11), 10)
    wide = spark.range(10).select("id", F.repeat(F.lit("é"), 100).alias("t"), F.array("id").alias("a"), F.lit(None).alias("n"))
    assert fits_broadcast(wide, 10, 2100) and not fits_broadcast(wide, 10, 2000)
    assert fits_broadcast(wide.where("false"), 10, 0)
