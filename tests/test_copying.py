import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from siltstone.operators.reconcile import (
    reconcile_aggregates,
    reconcile_counts,
    reconcile_sets,
    reconciliation_passes,
)
from siltstone.session import fresh_path, shared_dir
from siltstone.sources.readers import (
    export,
    load_documents,
    load_ndjson,
    read_table,
    remote_table,
    stream_table,
)
from siltstone.sources.writers import export_ndjson, publish, save_table, write_table

FACT = "device_id string, event_ts timestamp, metric string, value double, battery_pct int, ingest_date date"
FACTS = [
    ("a", dt.datetime(2024, 1, 1, 9), "co2", 1.5, 50, dt.date(2024, 1, 1)),
    ("b", dt.datetime(2024, 1, 2, 9), "co2", None, None, dt.date(2024, 1, 2)),
]


def test_json_lines_round_trip(spark, tmp_path, rows):
    df = spark.createDataFrame(FACTS, FACT)
    path = export_ndjson(df, str(tmp_path / "out"))
    assert '"ingest_date":"2024-01-01"' in spark.read.text(path).where("value LIKE '%\"a\"%'").first()[0]
    assert rows(load_ndjson(spark, path, FACT)) == rows(df)


def test_a_bad_field_costs_the_field_only(spark, tmp_path, rows):
    path = tmp_path / "in.json"
    path.write_text('{"device_id":"a","value":"high","ingest_date":"2024-13-01","battery_pct":"7"}\n{"value":2}\nnonsense\n')
    got = rows(load_ndjson(spark, str(path), "device_id string, value double, ingest_date date, battery_pct int"))
    assert got == sorted([("a", None, None, 7), (None, 2.0, None, None), (None, None, None, None)], key=repr)


def test_partitioned_table_reads_wanted_days_only(spark, tmp_path, capsys):
    path = write_table(spark.createDataFrame(FACTS, FACT), str(tmp_path / "t"), ["ingest_date"], rebalance=True)
    day = spark.read.parquet(path).where("ingest_date = DATE'2024-01-02'")
    assert day.count() == 1
    day.explain("formatted")
    assert "PartitionFilters: [isnotnull(ingest_date" in capsys.readouterr().out


def test_rewrite_may_change_the_schema(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table(spark.range(3), path)
    write_table(spark.range(2).withColumn("x", F.lit("y")), path, columns={"x": "a letter"})
    assert spark.read.parquet(path).columns == ["id", "x"]
    assert spark.read.parquet(path).schema["x"].metadata == {"comment": "a letter"}


def test_failed_rewrite_leaves_readers_alone(spark, tmp_path):
    publish(spark, "published_rows", write_table(spark.range(3), str(tmp_path / "v1")))
    with pytest.raises(Exception, match="broken"):
        bad = spark.range(2).withColumn("x", F.when(F.col("id") == 1, F.raise_error(F.lit("broken"))).cast("int"))
        publish(spark, "published_rows", write_table(bad, str(tmp_path / "v2")))
    assert read_table(spark, "published_rows").count() == 3


def test_labelled_table(spark):
    save_table(spark.range(1), "labelled", "it's a copy", {"quality": "bronze", "source": "warehouse.export"})
    described = {r[0]: r[1] for r in spark.sql("DESCRIBE TABLE EXTENDED labelled").collect()}
    assert described["Comment"] == "it's a copy" and "quality=bronze" in described["Table Properties"]
    save_table(spark.range(5), "labelled")
    assert read_table(spark, "labelled").count() == 5
    spark.sql("DROP TABLE labelled")


def test_documents_and_projection(spark, tmp_path, rows):
    path = tmp_path / "docs.json"
    path.write_text('{"id":"1","device_id":"a","model":"m","battery_pct":7,"_doc_type":"device_state"}\n')
    got = load_documents(spark, str(path))
    assert got.columns == ["device_id", "model", "firmware", "region", "site", "status", "registered_at", "last_seen", "battery_pct"]
    assert rows(export(got, ["device_id", "battery_pct"])) == [("a", 7)]


def test_remote_scan(spark, tmp_path):
    path = write_table(spark.range(9), str(tmp_path / "t"))
    assert remote_table(spark, "parquet", {"path": path}).where("id > 5").count() == 3
    with pytest.raises(ValueError, match="partitionColumn"):
        remote_table(spark, "jdbc", {"url": "jdbc:none", "dbtable": "t"})


def test_stream_and_batch_of_one_folder(spark, tmp_path):
    path = write_table(spark.range(9), str(tmp_path / "t"))
    assert stream_table(spark, path, "id long", max_files=1).isStreaming
    assert read_table(spark, path).count() == 9


def test_counts(spark, rows):
    pairs = {"t": (spark.range(3), spark.range(3)), "u": (spark.range(3), spark.range(2))}
    assert rows(reconcile_counts(pairs)) == [("t", 3, 3, True), ("u", 3, 2, False)]


def test_aggregates_match_null_groups_and_show_missing_ones(spark, rows):
    source = spark.createDataFrame([(None, 1.0), ("a", 2.0), ("b", 3.0)], "g string, v double")
    target = spark.createDataFrame([(None, 1.0), ("a", 5.0), ("c", 3.0)], "g string, v double")
    got = rows(reconcile_aggregates(source, target, ["g"], {"n": F.count(F.lit(1)), "total": F.sum("v")}))
    assert got == sorted(
        [
            (None, 1, 1, 1.0, 1.0, True),
            ("a", 1, 1, 2.0, 5.0, False),
            ("b", 1, None, 3.0, None, False),
            ("c", None, 1, None, 3.0, False),
        ],
        key=repr,
    )


def test_sets(spark, rows):
    expected = spark.createDataFrame([("t", "a"), ("t", None), ("u", "x")], "table string, tag string")
    actual = spark.createDataFrame([("t", "a"), ("t", None), ("t", "b")], "table string, tag string")
    assert rows(reconcile_sets(expected, actual, ["table", "tag"])) == [("t", "b", "unexpected"), ("u", "x", "missing")]
    assert rows(reconciliation_passes(expected, actual, ["table", "tag"])) == [(1, 1, False)]
    assert rows(reconciliation_passes(expected, expected, ["table", "tag"])) == [(0, 0, True)]


def test_scratch_paths_differ_and_share_a_folder(spark):
    one, two = fresh_path(spark, "x"), fresh_path(spark, "x")
    assert one != two and one.startswith(shared_dir(spark)) and two.startswith(shared_dir(spark))


def test_shared_folder_comes_from_the_session():
    class Conf:
        def get(self, key, default=None):
            return "hdfs://cluster/shared/" if key == "spark.checkpoint.dir" else default

    class Session:
        conf = Conf()

    assert shared_dir(Session()) == "hdfs://cluster/shared"


def test_cluster_without_shared_folder_is_refused():
    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://host:7077"

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(Session())


def test_unreadable_lines_are_kept(spark, tmp_path, rows):
    path = str(tmp_path / "lines")
    spark.createDataFrame([('{"a": 1, "b": "x"}',), ("{broken",), ('{"a": "one", "b": "y"}',), ("[1]",)], "value string").write.text(path)
    got = load_ndjson(spark, path, "a int, b string", unreadable="text")
    assert got.columns == ["a", "b", "text"]
    assert {(r.a, r.b, r.text) for r in got.collect()} >= {(1, "x", None), (None, "y", None), (None, None, "{broken")}
    assert load_ndjson(spark, path, "a int, b string").columns == ["a", "b"]
    with pytest.raises(ValueError, match="is a column"):
        load_ndjson(spark, path, "a int, b string", unreadable="b")


def test_comments_and_properties_are_read_back(spark):
    from siltstone.sources.writers import described, save_table

    df = spark.range(3).withColumn("v", F.lit("x")).withMetadata("v", {"comment": "what it's like"})
    name = f"described_{uuid.uuid4().hex}"
    try:
        save_table(df, name, "it's three rows", {"steward": "team 'a'"})
        got = {(r.kind, r.name): r.value for r in described(spark, name).collect()}
        assert got["comment", "table"] == "it's three rows" and got["property", "steward"] == "team 'a'" and got["column", "v"] == "what it's like"
        assert ("column", "id") not in got
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_written_rows_of_a_run(spark, tmp_path):
    from siltstone.operators.eventlog import recorded_metrics
    from siltstone.sources.readers import stream_table
    from siltstone.streaming.ingest import run_incremental

    landing, record = str(tmp_path / "landing"), str(tmp_path / "record")
    spark.range(40).write.parquet(landing)
    stream = stream_table(spark, landing, "id long").where("id % 4 = 0")
    run_incremental(stream, str(tmp_path / "out"), str(tmp_path / "mark"), record=record)
    (got,) = recorded_metrics(spark, record).collect()
    assert (got.input_rows, got.written_rows, got.batches) == (40, 10, 1)
