import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from test_cdc import FEED, SCHEMA, expected_scd1, expected_scd2

from siltstone.operators.aggregates import totals
from siltstone.operators.ordering import page, top_k
from siltstone.plans.config import load_config
from siltstone.plans.medallion import bronze, gold_in_one_scan, gold_tables, materialize, quarantined, silver, update

YAML = """
source: {source}
bronze_table: bronze_trips
silver_table: silver_trips_clean
landing_table: raw_trips_landing
expectations:
  valid_fare: "fare_amount > 0"
  non_negative_distance: "trip_distance >= 0"
  pickup_present: "pickup_zip IS NOT NULL"
gold_tables:
  - name: gold_by_pickup_zip
    dimension: pickup_zip
  - name: gold_by_trip_len
    dimension: "case when trip_distance < 2 then 'short' when trip_distance < 10 then 'mid' else 'long' end"
"""
TRIPS = [(5.0, 1.0, 1, 9), (15.0, 3.0, 1, None), (7.5, 12.0, 2, 9), (-2.0, 1.0, 2, 9), (9.0, 1.0, None, 9), (None, 1.0, 3, 9)]
GOLD = {
    "gold_by_pickup_zip": [(1, 2, 10.0, 2.0), (2, 1, 7.5, 12.0)],
    "gold_by_trip_len": [("long", 1, 7.5, 12.0), ("mid", 1, 15.0, 3.0), ("short", 1, 5.0, 1.0)],
}


@pytest.fixture
def config(spark, tmp_path):
    source = str(tmp_path / "trips")
    spark.createDataFrame(TRIPS, "fare_amount double, trip_distance double, pickup_zip int, dropoff_zip int").write.parquet(source)
    path = tmp_path / "run.yaml"
    path.write_text(YAML.format(source=source))
    return load_config(path)


def test_layers(spark, config, rows):
    raw = bronze(spark, config)
    clean, bad = silver(raw, config), quarantined(raw, config)
    assert (raw.count(), clean.count(), bad.count()) == (6, 3, 3)
    assert {name: rows(df) for name, df in gold_tables(clean, config).items()} == GOLD


def test_one_scan_holds_all_gold_tables(spark, config, rows):
    both = gold_in_one_scan(silver(bronze(spark, config), config), config)
    assert rows(both) == sorted((name, str(r[0]), *r[1:]) for name, table in GOLD.items() for r in table)


def test_stored_layers(spark, config, rows, tmp_path):
    tables = materialize(spark, config, str(tmp_path / "run"))
    assert list(tables) == ["bronze_trips", "silver_trips_clean", "quarantine", *GOLD]
    assert tables["silver_trips_clean"].columns == tables["bronze_trips"].columns
    assert (tables["silver_trips_clean"].count(), tables["quarantine"].count()) == (3, 3)
    assert {name: rows(tables[name]) for name in GOLD} == GOLD


def test_stored_gold_keeps_dimension_types(spark, config, rows, tmp_path):
    dimensions = {"n": "fare_amount", "b": "fare_amount > 6", "a": "array(pickup_zip)", "z": "nullif(pickup_zip, 1)"}
    more = load_config({**vars(config), "gold_tables": [{"name": k, "dimension": v} for k, v in dimensions.items()]})
    tables = materialize(spark, more, str(tmp_path / "run"))
    lazily = gold_tables(tables["silver_trips_clean"], more)
    for name in dimensions:
        assert tables[name].dtypes == lazily[name].dtypes
        assert rows(tables[name]) == rows(lazily[name])


def test_update_in_two_runs(spark, config, rows, tmp_path):
    landing, changes, orders = (str(tmp_path / p) for p in ("landing", "changes", "orders"))
    full = load_config({**vars(config), "landing_table": landing, "cdc_source": changes, "orders_source": orders})

    def arrive(ids, feed, amounts):
        spark.createDataFrame([(i,) for i in ids], "id long").write.mode("append").parquet(landing)
        spark.createDataFrame(feed, SCHEMA).write.mode("append").parquet(changes)
        spark.createDataFrame([(i, a) for i, a in enumerate(amounts)], "order_id long, amount double").write.mode(
            "append"
        ).parquet(orders)

    root = str(tmp_path / "root")
    arrive(range(1000), FEED[:3], [1.0, 0.0, 5.0])
    first = update(spark, full, root, minimum=6.0)
    assert (first["streamed"].count(), first["scd1"].count(), first["scd2"].count()) == (1000, 3, 3)
    assert (first["validated"].count(), first["gold_high_value"].count(), first["quarantine"].count()) == (3, 2, 3)
    arrive(range(1000, 1050), FEED[3:], [2.0, 3.0])
    second = update(spark, full, root, minimum=10.0)
    assert (second["streamed"].count(), second["validated"].count(), second["gold_high_value"].count()) == (1050, 5, 1)
    assert rows(second["scd1"]) == expected_scd1(FEED) and rows(second["scd2"]) == expected_scd2(FEED)
    arrive([1050], FEED[:1], [-50.0])
    with pytest.raises(PySparkException, match="amount_non_negative"):
        update(spark, full, root)
    assert second["validated"].count() == 5


def test_null_dimension_is_a_group(spark, config, rows):
    by_dropoff = load_config({**vars(config), "gold_tables": [{"name": "g", "dimension": "dropoff_zip"}]})
    assert (None, 1, 15.0, 3.0) in rows(gold_tables(silver(bronze(spark, config), config), by_dropoff)["g"])


def test_one_more_line_one_more_table(config):
    more = load_config({**vars(config), "gold_tables": [*config.gold_tables, {"name": "g", "dimension": "fare_amount"}]})
    assert list(more.dimensions) == [*GOLD, "g"]


def test_config_forms(tmp_path, config):
    path = tmp_path / "run.json"
    path.write_text(json.dumps(vars(config)))
    assert load_config(path) == config
    minimal = {"source": "s", "bronze_table": "b", "silver_table": "v", "gold_tables": []}
    assert load_config(minimal).expectations == {} == load_config({**minimal, "expectations": None}).expectations
    with pytest.raises(ValueError, match="gold_tables"):
        load_config({k: v for k, v in minimal.items() if k != "gold_tables"})
    with pytest.raises(ValueError, match="expectation'"):
        load_config({**minimal, "expectation": {}})


def test_order_page_and_totals(spark, rows):
    df = spark.range(10).withColumn("g", F.col("id") % 2)
    assert [r["id"] for r in top_k(df, [F.desc("g")], 3, ["id"]).collect()] == [1, 3, 5]
    assert [r["id"] for r in page(df, ["id"], 2, 3).collect()] == [2, 3, 4]
    assert rows(totals(df, ["g"])) == [(10, 2)]
