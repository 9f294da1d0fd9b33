import itertools

import pytest
from pyspark.sql import functions as F
from test_cdc import FEED, SCHEMA, expected_scd1, expected_scd2

from siltstone.operators.eventlog import recorded_metrics
from siltstone.operators.joins import enrich
from siltstone.operators.quality import expect_or_drop, quarantine
from siltstone.sources.readers import message_columns, message_log_options, stream_table
from siltstone.streaming.cdc import Feed, compact, read_log, read_scd, refresh_target, scd_stream
from siltstone.streaming.enrich import run_enriched
from siltstone.streaming.ingest import (
    full_refresh,
    read_quarantine,
    read_silver,
    run_batches,
    run_incremental,
    silver_and_quarantine,
    write_batch,
)
from siltstone.streaming.target import pending, read_manifest

LANDING = "id long, v double"
FLOW = Feed(["id"], "seq", "op = 'DELETE'", ["op", "seq"])


def land(spark, path, start, count):
    spark.range(start, start + count).selectExpr("id", "CAST(id % 10 AS double) AS v").write.mode("append").parquet(path)


def land_changes(spark, path, changes):
    spark.createDataFrame(changes, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def test_each_run_takes_only_new_rows(spark, tmp_path):
    landing, out, mark = (str(tmp_path / p) for p in ("landing", "out", "mark"))
    land(spark, landing, 0, 1000)
    stream = lambda: stream_table(spark, landing, LANDING)
    assert run_incremental(stream(), out, mark) == 1000
    land(spark, landing, 1000, 50)
    assert run_incremental(stream(), out, mark) == 50
    assert run_incremental(stream(), out, mark) == 0
    assert spark.read.parquet(out).select("id").distinct().count() == 1050 == spark.read.parquet(out).count()


def test_full_refresh_switches_readers(spark, tmp_path):
    landing = str(tmp_path / "landing")
    land(spark, landing, 0, 10)
    first = full_refresh(spark, stream_table(spark, landing, LANDING), "refresh", "refreshed_rows")
    assert spark.table("refreshed_rows").count() == 10
    land(spark, landing, 10, 5)
    second = full_refresh(spark, stream_table(spark, landing, LANDING), "refresh", "refreshed_rows")
    assert spark.table("refreshed_rows").count() == 15
    assert first != second and spark.read.parquet(first).count() == 10


def test_full_refresh_of_a_split_and_a_feed(spark, tmp_path, rows):
    landing, changes = str(tmp_path / "landing"), str(tmp_path / "changes")
    land(spark, landing, 0, 20)
    land_changes(spark, changes, FEED)
    split = lambda s, path, mark: silver_and_quarantine(s, {"small": "v < 7"}, path, mark)
    assert read_silver(spark, full_refresh(spark, stream_table(spark, landing, LANDING), "split", run=split)).count() == 14
    log = lambda s, path, mark: scd_stream(s, FLOW, 2, path, mark)
    rebuilt = full_refresh(spark, stream_table(spark, changes, SCHEMA), "log", run=log)
    assert rows(read_scd(spark, FLOW, 2, rebuilt)) == expected_scd2(FEED)


def test_batches_beyond_the_kept_progress_are_counted(spark, tmp_path):
    landing, setting = str(tmp_path / "landing"), "spark.sql.streaming.numRecentProgressUpdates"
    spark.range(0, 24, 1, 24).selectExpr("id", "0.0D AS v").write.parquet(landing)
    old, seen = spark.conf.get(setting), []
    spark.conf.set(setting, "12")
    try:
        stream = stream_table(spark, landing, LANDING, max_files=1)
        read = run_batches(stream, str(tmp_path / "mark"), lambda batch, batch_id: seen.append(batch.count()))
    finally:
        spark.conf.set(setting, old)
    assert read == 24 == sum(seen) and len(seen) == 24


def test_split_equals_batch_over_several_batches(spark, tmp_path):
    landing, out, mark = (str(tmp_path / p) for p in ("landing", "out", "mark"))
    rules = {"small": "v < 7", "odd": "id % 2 = 1"}
    for start in (0, 100, 200):
        land(spark, landing, start, 100)
    assert silver_and_quarantine(stream_table(spark, landing, LANDING, max_files=2), rules, out, mark) == 300
    source = spark.read.schema(LANDING).parquet(landing)
    for read, batch in ((read_silver, expect_or_drop), (read_quarantine, quarantine)):
        got, want = read(spark, out, source.schema), batch(source, rules)
        assert got.columns == ["id", "v"]
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_split_of_nothing_can_be_read(spark, tmp_path):
    landing, out, mark = (str(tmp_path / p) for p in ("landing", "out", "mark"))
    land(spark, landing, 0, 4)
    silver_and_quarantine(stream_table(spark, landing, LANDING), {}, out, mark)
    assert read_silver(spark, out).count() == 4
    assert read_quarantine(spark, out, spark.read.parquet(landing).schema).count() == 0


def test_repeated_batch_replaces_itself(spark, tmp_path, rows):
    df = spark.createDataFrame([(1,), (2,)], "a int")
    for _ in range(2):
        write_batch(df, 7, str(tmp_path / "t"))
    assert rows(spark.read.parquet(str(tmp_path / "t")).select("a")) == [(1,), (2,)]


def test_stream_enriched_like_batch(spark, tmp_path, rows):
    landing, out, mark = (str(tmp_path / p) for p in ("landing", "out", "mark"))
    land(spark, landing, 0, 20)
    ref = spark.range(0, 10).selectExpr("id", "concat('m', id) AS model")
    for limit in (0, 100):
        stream = enrich(stream_table(spark, landing, LANDING), ref, ["id"], ["model"], max_broadcast_rows=limit)
        run_incremental(stream, f"{out}{limit}", f"{mark}{limit}")
        assert rows(spark.read.parquet(f"{out}{limit}")) == rows(enrich(spark.read.parquet(landing), ref, ["id"], ["model"]))


def test_each_batch_sees_the_reference_as_it_is_then(spark, tmp_path, rows):
    landing, out, mark = (str(tmp_path / p) for p in ("landing", "out", "mark"))
    models = iter(["old", "new"])
    reference = lambda: spark.range(40).select("id", F.lit(next(models)).alias("model"))
    for start in (0, 20):
        land(spark, landing, start, 20)
        run_enriched(stream_table(spark, landing, LANDING), reference, ["id"], ["model"], None, out, mark)
    got = spark.read.parquet(out).groupBy("model").agg(F.min("id"), F.count("*"))
    assert rows(got) == [("new", 20, 20), ("old", 0, 20)]


@pytest.mark.parametrize("scd_type,expected", [(1, expected_scd1), (2, expected_scd2)])
def test_change_feed_in_several_runs(spark, tmp_path, rows, scd_type, expected):
    """Shuffled arrival, a replay, a late change older than the delete, an insert after it."""
    landing, log, mark = (str(tmp_path / p) for p in ("landing", "log", "mark"))
    parts = [
        [FEED[5], FEED[2], FEED[4]],
        [FEED[0], FEED[1], (3, "Late", "X", "UPDATE", 4)],
        [FEED[3], FEED[4], FEED[4]],
        [(3, "Again", "Y", "INSERT", 9), (1, "Null", "Z", None, 7)],
    ]
    seen = []
    for part in parts:
        land_changes(spark, landing, part)
        seen += part
        scd_stream(stream_table(spark, landing, SCHEMA), FLOW, scd_type, log, mark)
        assert rows(read_scd(spark, FLOW, scd_type, log)) == expected(seen)
    compacted = compact(spark, FLOW, scd_type, log, str(tmp_path / "compacted"))
    assert rows(read_scd(spark, FLOW, scd_type, compacted)) == expected(seen)
    assert read_log(spark, compacted).count() == (4 if scd_type == 1 else len(set(seen)))
    late = [(2, "Bob", "Jeju", "UPDATE", 10)]
    land_changes(spark, landing, late)
    assert scd_stream(stream_table(spark, landing, SCHEMA), FLOW, scd_type, compacted, mark) == 1
    assert rows(read_scd(spark, FLOW, scd_type, compacted)) == expected(seen + late)


@pytest.mark.parametrize("cut", range(1, 6))
def test_any_split_into_batches_gives_the_batch_result(spark, tmp_path, rows, cut):
    landing, log, mark = (str(tmp_path / p) for p in ("landing", "log", "mark"))
    land_changes(spark, landing, FEED[cut:])
    land_changes(spark, landing, FEED[:cut])
    scd_stream(stream_table(spark, landing, SCHEMA, max_files=1), FLOW, 1, log, mark)
    assert rows(read_scd(spark, FLOW, 1, log)) == expected_scd1(FEED)


def test_new_checkpoint_does_not_overwrite_old_batches(spark, tmp_path, rows):
    first, second, log = (str(tmp_path / p) for p in ("first", "second", "log"))
    land_changes(spark, first, FEED[:3])
    land_changes(spark, second, FEED[3:])
    for source, mark in ((first, "mark1"), (second, "mark2")):
        scd_stream(stream_table(spark, source, SCHEMA), FLOW, 2, log, str(tmp_path / mark))
    assert rows(read_scd(spark, FLOW, 2, log)) == expected_scd2(FEED)


def test_published_target_follows_the_feed(spark, tmp_path, rows):
    landing, root = str(tmp_path / "landing"), str(tmp_path / "target")
    for part in (FEED[:4], FEED[4:]):
        land_changes(spark, landing, part)
        refresh_target(spark, stream_table(spark, landing, SCHEMA), FLOW, 2, root, "customer_history")
    assert rows(spark.table("customer_history")) == expected_scd2(FEED)


@pytest.mark.parametrize("scd_type,expected", [(1, expected_scd1), (2, expected_scd2)])
def test_a_run_reads_new_changes_and_touched_buckets_only(spark, tmp_path, rows, scd_type, expected):
    landing, root, name = str(tmp_path / "landing"), str(tmp_path / "target"), f"target_{scd_type}"
    first = [(i, "n", "c", "INSERT", i) for i in range(1, 41)]
    second = [(7, "m", "c", "UPDATE", 100), (7, "late", "c", "UPDATE", 3), (9, None, None, "DELETE", 101), (7, "m", "c", "UPDATE", 100)]
    land_changes(spark, landing, first)
    assert refresh_target(spark, stream_table(spark, landing, SCHEMA), FLOW, scd_type, root, name) == 40
    assert rows(spark.table(name)) == expected(first)
    before = read_manifest(spark, root)
    land_changes(spark, landing, second)
    assert refresh_target(spark, stream_table(spark, landing, SCHEMA), FLOW, scd_type, root, name) == 4
    after = read_manifest(spark, root)
    assert rows(spark.table(name)) == expected(first + second)
    moved = {b for b in after.changes if before.changes.get(b) != after.changes[b]}
    assert 1 <= len(moved) <= 2 and after.version == before.version + 1
    # what the second run had to read of the log
    read = pending(spark, root, before)
    files = [r[0] for r in read.select(F.input_file_name()).distinct().collect()]
    assert files and all(f"__siltstone_batch={max(after.seen.values())}/" in f for f in files)
    filters = read._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: [")[1].split("PushedFilters")[0]
    assert "__siltstone_batch" in filters
    # nothing new: nothing is written
    assert refresh_target(spark, stream_table(spark, landing, SCHEMA), FLOW, scd_type, root, name) == 0
    assert read_manifest(spark, root).version == after.version


def test_composite_key(spark, rows):
    data = [(a, b, s, f"{a}{b}{s}") for a, b, s in itertools.product((1, 2), ("x", "y"), (1, 2))]
    feed = spark.createDataFrame(data, "a int, b string, s int, v string")
    assert rows(Feed(["a", "b"], "s", except_cols=["s"]).current(feed)) == [
        (a, b, f"{a}{b}2") for a, b in itertools.product((1, 2), ("x", "y"))
    ]


def test_message_log_options():
    options = message_log_options("host:9093", "readings", "login", max_per_trigger=2000)
    assert options["startingOffsets"] == "earliest" and options["failOnDataLoss"] == "false"
    assert options["maxOffsetsPerTrigger"] == "2000" and options["kafka.security.protocol"] == "SASL_SSL"
    plain = message_log_options("host:9093", "t")
    assert "kafka.sasl.mechanism" not in plain and "maxOffsetsPerTrigger" not in plain


def test_user_columns_with_ordinary_names_stay(spark, tmp_path, rows):
    names = ["verdict", "batch_id", "run_id", "gold"]
    landing, out, mark, log, mark2 = (str(tmp_path / p) for p in ("landing", "out", "mark", "log", "mark2"))
    data = spark.range(6).select("id", *(F.concat(F.lit(n), F.col("id").cast("string")).alias(n) for n in names))
    data.write.parquet(landing)
    stream = lambda: stream_table(spark, landing, data.schema)
    silver_and_quarantine(stream(), {"low": "id < 4"}, out, mark)
    both = read_silver(spark, out, data.schema).unionByName(read_quarantine(spark, out, data.schema))
    assert both.columns == data.columns and rows(both) == rows(data)
    feed = Feed(["id"], "run_id")
    scd_stream(stream(), feed, 2, log, mark2)
    assert rows(read_scd(spark, feed, 2, log).select(data.columns)) == rows(data)


def test_reserved_names_are_refused(spark, tmp_path):
    taken = spark.range(2).withColumn("__siltstone_batch", F.lit(1))
    taken.write.parquet(str(tmp_path / "in"))
    stream = stream_table(spark, str(tmp_path / "in"), taken.schema)
    with pytest.raises(Exception, match="reserved: __siltstone_batch"):
        silver_and_quarantine(stream, {}, str(tmp_path / "out"), str(tmp_path / "mark"))


def test_stream_of_a_catalog_table(spark, tmp_path, rows):
    spark.sql("DROP TABLE IF EXISTS landing_rows")
    for start, count in ((0, 1000), (1000, 50)):
        spark.range(start, start + count).write.mode("append").format("parquet").saveAsTable("landing_rows")
        taken = run_incremental(stream_table(spark, "landing_rows"), str(tmp_path / "out"), str(tmp_path / "mark"))
        assert taken == count
    assert spark.read.parquet(str(tmp_path / "out")).count() == 1050
    spark.sql("DROP TABLE landing_rows")


def test_every_batch_of_a_run_is_recorded(spark, tmp_path):
    landing, record = str(tmp_path / "landing"), str(tmp_path / "record")
    spark.range(0, 110, 1, 110).write.parquet(landing)
    run = lambda: run_incremental(
        stream_table(spark, landing, "id long", max_files=1), str(tmp_path / "out"), str(tmp_path / "mark"), record=record
    )
    assert run() == 110
    spark.range(7).coalesce(1).write.mode("append").parquet(landing)
    assert run() == 7
    first, second = recorded_metrics(spark, record).orderBy("started_at").collect()
    assert (first["batches"], first["input_rows"], second["batches"], second["input_rows"]) == (110, 110, 1, 7)


def test_raw_layer_keeps_the_log_position(spark):
    log = spark.range(2).select(
        F.lit('{"a":1}').cast("binary").alias("value"),
        F.lit(0).alias("partition"),
        F.col("id").alias("offset"),
        F.current_timestamp().alias("timestamp"),
    )
    got = message_columns(log)
    assert got.columns == ["raw_json", "log_partition", "log_offset", "enqueued_ts"]
    assert got.first()["raw_json"] == '{"a":1}'
