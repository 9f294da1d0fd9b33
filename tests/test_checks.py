import datetime as dt
from collections import Counter

import pytest
from pyspark.sql import functions as F

from siltstone.operators import checks
from siltstone.operators.checks import (
    apply_checks,
    has_errors,
    split_checks,
    validate_checks,
    verdict_counts,
)
from siltstone.operators.scan import NON_NULL, RANGE, REGEX, SET, scan_report, scan_verdict
from siltstone.sources.writers import read_split, write_split
from siltstone.workloads import QUERIES

SCHEMA = "device_id string, value double, battery int, ts timestamp, seq long"
T = dt.datetime(2024, 1, 1)
DATA = [
    ("a", 1.0, 50, T, 1),
    ("b", 2.0, -5, T, 2),
    (None, 3.0, 50, T, 3),
    ("a", 999.0, 50, T, 4),
    ("z", 1.0, 50, T, 5),
    ("a", 1.0, None, T, 6),
    ("b", 1.0, 50, T, 6),
    ("a", None, 50, T + dt.timedelta(days=2), None),
    ("a", 1.0, 50, T, None),
]


def spec(name, criticality, function, **arguments):
    return {"name": name, "criticality": criticality, "check": {"function": function, "arguments": arguments}}


CHECKS = [
    spec("device", "error", "is_not_null", column="device_id"),
    spec("range", "error", "sql_expression", expression="value < 100", msg="too large"),
    spec("battery", "warn", "is_in_range", column="battery", min_limit=0, max_limit=100),
    spec("floor", "warn", "is_not_less_than", column="value", limit=1),
    spec("future", "warn", "is_not_in_future", column="ts", offset=3600),
    spec("unique", "error", "is_unique", columns=["seq"]),
    spec("known", "error", "foreign_key", columns=["device_id"], ref_columns=["id"], ref_table="devices"),
    spec("volume", "error", "is_aggr_not_greater_than", column="*", aggr_type="count", limit=100),
]
AS_OF = "2024-01-01 12:00:00"


def devices(spark):
    return spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "id string")


def annotate(spark, checks=CHECKS, data=DATA):
    df = spark.createDataFrame(data, SCHEMA)
    return apply_checks(df, checks, {"devices": devices(spark)}, AS_OF)


def names(found):
    return [d["name"] for d in found] if found is not None else None


def test_every_check_on_every_row(spark):
    got = annotate(spark)
    assert got.columns == ["device_id", "value", "battery", "ts", "seq", "_errors", "_warnings"]
    found = sorted(((tuple(r)[:5], names(r["_errors"]), names(r["_warnings"])) for r in got.collect()), key=repr)
    verdicts = {
        DATA[0]: (None, None),
        DATA[1]: (None, ["battery"]),
        DATA[2]: (["device"], None),
        DATA[3]: (["range"], None),
        DATA[4]: (["known"], None),
        DATA[5]: (["unique"], None),
        DATA[6]: (["unique"], None),
        DATA[7]: (None, ["future"]),
        DATA[8]: (None, None),
    }
    assert found == sorted(((row, *v) for row, v in verdicts.items()), key=repr)


def test_diagnostics_fields(spark):
    row = annotate(spark).where("value = 999").first()
    assert row["_errors"][0].asDict() == {"name": "range", "message": "too large", "columns": [], "check": "sql_expression"}


def test_aggregate_limit_marks_all_rows(spark):
    over = annotate(spark, [spec("volume", "error", "is_aggr_not_greater_than", column="value", aggr_type="max", limit=10)])
    assert over.where(has_errors()).count() == len(DATA)


def test_null_fails_option(spark):
    strict = [
        spec("battery", "error", "is_in_range", column="battery", min_limit=-10, max_limit=100, null_fails=True),
        spec("known", "error", "foreign_key", columns=["device_id"], ref_columns=["id"], ref_table="devices", null_fails=True),
    ]
    assert annotate(spark, strict).where(has_errors()).count() == 3


def test_rows_do_not_shuffle_for_few_bad_keys(spark, tmp_path, capsys):
    path = str(tmp_path / "t")
    spark.createDataFrame(DATA, SCHEMA).write.parquet(path)
    apply_checks(spark.read.parquet(path), CHECKS[:-1], {"devices": devices(spark)}, AS_OF).explain()
    main = capsys.readouterr().out
    assert "BroadcastHashJoin" in main and "hashpartitioning" not in main


def test_split_and_counts(spark, tmp_path):
    annotated = annotate(spark)
    valid, bad = split_checks(annotated)
    assert (valid.count(), bad.count()) == (4, 5)
    assert tuple(verdict_counts(annotated).first()) == (9, 4, 5, 2)
    path = write_split(annotated, str(tmp_path / "split"))
    assert read_split(spark, path, "valid").count() == 4
    assert read_split(spark, path).count() == 9


def test_no_checks_and_no_rows(spark):
    assert annotate(spark, []).where("_errors IS NULL AND _warnings IS NULL").count() == len(DATA)
    assert annotate(spark, CHECKS, []).count() == 0
    assert tuple(verdict_counts(annotate(spark, CHECKS, [])).first()) == (0, 0, 0, 0)


@pytest.mark.parametrize("few", [True, False], ids=["few bad keys", "many bad keys"])
def test_unique_on_a_hot_key_keeps_every_row(spark, monkeypatch, few):
    monkeypatch.setattr(checks, "fits_broadcast", lambda df: few)
    df = spark.range(9000).select(F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"), "id")
    got = apply_checks(df, [spec("unique", "error", "is_unique", columns=["k"])])
    assert got.count() == 9000
    assert got.where(has_errors()).select("k").distinct().count() == 1
    assert got.where(has_errors()).count() == 3000


def test_many_bad_keys_shuffle_the_rows_once(spark, monkeypatch, capsys):
    monkeypatch.setattr(checks, "fits_broadcast", lambda df: False)
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        # a third of all rows has one k, a fifth no n, a fifth of the rest one pair, a seventh of them no k
        k = F.when(F.col("id") % 3 == 0, 1).when(F.col("id") % 7 == 0, None).otherwise(F.col("id") % 300)
        n = F.when(F.col("id") % 5 == 0, None).when(F.col("id") % 4 == 0, 0).otherwise(F.col("id") % 700)
        df = spark.range(7000).select(k.alias("k"), n.alias("n"), "id")
        ref = spark.range(2, 300, 2).select(F.col("id").alias("r"))
        specs = [
            spec("pair", "error", "is_unique", columns=["k", "n"]),
            spec("known", "error", "foreign_key", columns=["k"], ref_columns=["r"], ref=ref),
            spec("turned", "error", "is_unique", columns=["n", "k"]),
            spec("alone", "warn", "is_unique", columns=["k"]),
        ]
        got = apply_checks(df, specs)
        got.explain()
        assert capsys.readouterr().out.count("Exchange hashpartitioning") == 1
        found = [(r.k, r.n, r.id, set(names(r["_errors"]) or ()), bool(r["_warnings"])) for r in got.collect()]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)
    rows, known = df.collect(), {r.r for r in ref.collect()}
    pairs, keys = Counter((r.k, r.n) for r in rows), Counter(r.k for r in rows)
    wanted = []
    for r in rows:
        twice = r.k is not None and r.n is not None and pairs[r.k, r.n] > 1
        errors = {"pair", "turned"} if twice else set()
        errors |= {"known"} if r.k is not None and r.k not in known else set()
        wanted.append((r.k, r.n, r.id, errors, r.k is not None and keys[r.k] > 1))
    assert sorted(found, key=lambda x: x[2]) == sorted(wanted, key=lambda x: x[2])


def test_many_bad_keys_sort_the_rows_once(spark, monkeypatch, capsys):
    monkeypatch.setattr(checks, "fits_broadcast", lambda df: False)
    df = spark.range(600).select((F.col("id") % 70).alias("k"), (F.col("id") % 9).alias("n"), "id")
    specs = [
        spec("pair", "error", "is_unique", columns=["n", "k"]),
        spec("known", "error", "foreign_key", columns=["k"], ref_columns=["r"], ref=spark.range(1, 70).toDF("r")),
        spec("other", "warn", "foreign_key", columns=["k"], ref_columns=["r"], ref=spark.range(2, 70).toDF("r")),
    ]
    got = apply_checks(df.union(df.where("id < 20")), specs)
    got.explain()
    assert capsys.readouterr().out.count("Sort [") == 1
    found = {(r.id, tuple(sorted(names(r["_errors"]) or ())), bool(r["_warnings"])) for r in got.collect()}
    errors = lambda i: (("known",) if i % 70 == 0 else ()) + (("pair",) if i < 20 else ())
    assert found == {(i, errors(i), i % 70 < 2) for i in range(600)}


@pytest.mark.parametrize("name", ["checks_annotated", "checks_verdict_counts", "checks_stored_split"])
def test_queries_share_the_shuffle_of_many_bad_keys(spark, rows, monkeypatch, tmp_path, name):
    line = ["1D", "100D", "0.05D", "0.1D", "'R'", "'O'", "timestamp'1999-01-01'"]
    named = "l_quantity l_extendedprice l_discount l_tax l_returnflag l_linestatus l_shipdate".split()
    keys = ["if(id % 11 = 0, null, id % 50) AS l_orderkey", "id AS l_partkey", "id AS l_suppkey", "int(id % 7) AS l_linenumber"]
    spark.range(500).selectExpr(*keys, *(f"{v} AS {n}" for v, n in zip(line, named, strict=True))).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.range(40).selectExpr("id AS o_orderkey", "if(id % 3 = 0, 'F', 'O') AS o_orderstatus").write.parquet(f"{tmp_path}/orders.parquet")
    few = rows(QUERIES[name](spark, str(tmp_path)))
    monkeypatch.setattr(checks, "fits_broadcast", lambda df: False)
    monkeypatch.setattr(checks, "skew_left_join", None)  # a join of one set alone
    assert rows(QUERIES[name](spark, str(tmp_path))) == few


def test_validation_reports_each_problem(spark):
    bad = [
        spec("fine", "error", "is_not_null", column="device_id"),
        spec("column", "error", "is_not_null", column="nope"),
        spec("function", "error", "is_lucky", column="device_id"),
        spec("severity", "fatal", "is_not_null", column="device_id"),
        spec("argument", "warn", "is_in_range", column="battery", lowest=0),
        spec("syntax", "error", "sql_expression", expression="value <"),
        spec("aggregate", "error", "is_aggr_not_greater_than", column="*", aggr_type="mode", limit=1),
    ]
    problems = validate_checks(spark, bad, SCHEMA)
    assert [p.split(":")[0] for p in problems] == ["column", "function", "severity", "argument", "syntax", "aggregate"]
    assert validate_checks(spark, CHECKS, SCHEMA, {"devices": devices(spark)}) == []


RULES = [
    {"column": "device_id", "dimension": "COMPLETENESS", "type": NON_NULL},
    {"column": "battery", "type": RANGE, "min": "0", "max": "100"},
    {"column": "value", "type": RANGE, "min": "1", "ignore_null": True},
    {"column": "device_id", "type": SET, "values": ["a", "b"]},
    {"column": "device_id", "type": REGEX, "regex": "^[a-z]$", "threshold": 0.8},
]


def test_scan_report(spark):
    df = spark.createDataFrame(DATA, SCHEMA)
    got = [(r["passed"], r["pass_ratio"]) for r in scan_report(df, RULES).collect()]
    assert got == [(False, 0.89), (False, 0.78), (True, 1.0), (False, 0.78), (True, 0.89)]
    verdict = scan_verdict(df, RULES).first()
    assert (verdict["passed"], verdict["row_count"], len(verdict["rules"])) == (False, 9, 5)
    empty = scan_verdict(df.where("false"), RULES).first()
    assert (empty["passed"], empty["row_count"]) == (True, 0)


def test_scan_of_the_vitals_example(spark):
    vitals = spark.createDataFrame(
        [("P001", 72, 120), ("P001", 75, 122), ("P002", 68, 118), ("P003", 88, 130), ("P004", 95, 140)],
        "patient_id string, heart_rate int, systolic int",
    )
    rules = [
        {"column": "patient_id", "dimension": "COMPLETENESS", "type": NON_NULL},
        {"column": "heart_rate", "dimension": "VALIDITY", "type": RANGE, "min": "20", "max": "300"},
        {"column": "systolic", "dimension": "VALIDITY", "type": RANGE, "min": "50", "max": "250"},
    ]
    verdict = scan_verdict(vitals, rules).first()
    assert (verdict["passed"], verdict["row_count"]) == (True, 5)
    assert [(r["column"], r["passed"], r["pass_ratio"]) for r in verdict["rules"]] == [
        ("patient_id", True, 1.0),
        ("heart_rate", True, 1.0),
        ("systolic", True, 1.0),
    ]
