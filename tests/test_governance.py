import json

import pytest
from pyspark.sql import functions as F

from siltstone.operators import governance as gov
from siltstone.operators.eventlog import expectation_log, flow_history, run_metrics
from siltstone.operators.reconcile import reconciliation_passes
from siltstone.operators.scan import scan_report
from siltstone.sources.readers import load_event_log, load_inventory

# A harbour's tables.  Fixed values: field names of an inventory, rule types, and PHI as the mark of what is classified.
INVENTORY = {
    "metadata": {
        "vessels": {
            "description": "ships that have called here",
            "labels": {"keeper": "harbour office", "layer": "raw"},
            "columns": {"imo": "registry number (PHI)", "owner": "who to write to (PHI)", "built": "launched in", "flag": "home port's country"},
        },
        "soundings": {
            "description": None,
            "labels": {"keeper": "survey boat", "layer": "raw", "unit": "metre", "datum": "low water"},
            "columns": {"imo": "registry number (PHI)", "depth": "below the keel", "swell": "", "wind": None},
        },
        "soundings_by_tide": {
            "description": "one line per tide",
            "labels": {"layer": "summary"},
            "columns": {"imo": None, "tide": None},
        },
    },
    "aspects": {
        "vessels": {
            "aspect_type": "port.authority.access-policy",
            "data": {"reader": "pilots", "writer": "clerks", "kept_for": "10 years"},
        }
    },
    "data_quality": {
        "target": "soundings",
        "rules": [
            {"column": "imo", "dimension": "COMPLETENESS", "type": "non_null_expectation"},
            {"column": "depth", "dimension": "VALIDITY", "type": "range_expectation", "min": "1", "max": "40"},
            {"column": "swell", "dimension": "VALIDITY", "type": "range_expectation", "min": "0", "max": "9"},
            {"column": "datum", "dimension": "VALIDITY", "type": "set_expectation"},
        ],
        "latest_result": {"passed": False, "row_count": 812, "rules": [{"column": "depth", "passed": False, "pass_ratio": 0.97}]},
    },
    "lineage": [],
}


@pytest.fixture
def inventory(spark, tmp_path):
    path = tmp_path / "inventory.json"
    path.write_text(json.dumps(INVENTORY, indent=2))
    return load_inventory(spark, str(path))


@pytest.fixture
def described(inventory):
    return gov.tables(inventory, exclude=["soundings_by_tide"])


def test_comments(described, rows):
    assert rows(gov.inventory_comments(described)) == sorted(
        [
            ("vessels", 0, None, "ships that have called here"),
            ("vessels", 1, "imo", "registry number (PHI)"),
            ("vessels", 2, "owner", "who to write to (PHI)"),
            ("vessels", 3, "built", "launched in"),
            ("vessels", 4, "flag", "home port's country"),
            ("soundings", 1, "imo", "registry number (PHI)"),
            ("soundings", 2, "depth", "below the keel"),
        ],
        key=repr,
    )
    listed = gov.list_comments(gov.inventory_comments(described)).collect()
    assert [r["column_name"] for r in listed] == ["imo", "depth", "imo", "owner", "built", "flag"]


def test_derived_table_has_no_column_comments(inventory, rows):
    derived = gov.tables(inventory).where("table_name = 'soundings_by_tide'")
    assert rows(gov.inventory_comments(derived)) == [("soundings_by_tide", 0, None, "one line per tide")]


def test_tags(described, inventory, rows):
    labels = gov.inventory_tags(described)
    assert labels.count() == 6 and ("soundings", "datum", "low water") in rows(labels)
    flat = gov.flatten_aspects(gov.aspects(inventory))
    assert rows(flat) == [
        ("vessels", "access_policy_kept_for", "10 years"),
        ("vessels", "access_policy_reader", "pilots"),
        ("vessels", "access_policy_writer", "clerks"),
    ]
    listed = gov.list_tags(labels.unionByName(flat)).collect()
    assert [r["tag_name"] for r in listed][4:] == ["access_policy_kept_for", "access_policy_reader", "access_policy_writer", "keeper", "layer"]
    assert rows(reconciliation_passes(labels, labels.where("tag_name <> 'keeper'"), labels.columns)) == [(2, 0, False)]


def test_classification(described, rows):
    tags = gov.classify_columns(described)
    assert [(r[0], r[1], r[2], r[3]) for r in gov.list_column_tags(tags).collect()] == [
        ("soundings", "imo", "classification", "PHI"),
        ("vessels", "imo", "classification", "PHI"),
        ("vessels", "owner", "classification", "PHI"),
    ]


def test_checks(inventory, rows):
    checks = gov.rules_to_checks(gov.rules(inventory))
    assert rows(gov.list_checks(checks)) == [("chk_depth", "depth BETWEEN 1 AND 40"), ("chk_swell", "swell BETWEEN 0 AND 9")]
    assert rows(gov.list_required(checks)) == [("soundings", "imo")]
    assert inventory.select("data_quality.latest_result.row_count").first()[0] == 812


def test_rules_are_measured(spark, inventory):
    soundings = spark.createDataFrame([("9074729", 12, 2), ("9176187", 55, 1)], "imo string, depth int, swell int")
    rules = gov.scan_rules(gov.rules(inventory), "soundings")
    report = scan_report(soundings, rules).collect()
    assert [(r["column"], r["passed"], r["pass_ratio"]) for r in report] == [("imo", True, 1.0), ("depth", False, 0.5), ("swell", True, 1.0)]
    with pytest.raises(ValueError, match="more than 2"):
        gov.scan_rules(gov.rules(inventory), "soundings", most=2)


def test_ranges_with_one_bound_or_none(spark, rows):
    kind = "range_expectation"
    given = spark.createDataFrame(
        [("t", "a", "V", kind, "1", None), ("t", "b", "V", kind, None, "9"), ("t", "c", "V", kind, None, None)],
        "table_name string, column string, dimension string, type string, min string, max string",
    )
    assert rows(gov.rules_to_checks(given).select("clause")) == [("a >= 1",), ("b <= 9",)]
    assert rows(gov.invalid_rules(given).select("column", "problem")) == [("c", "no bound")]
    found = gov.scan_rules(given, "t")
    data = spark.createDataFrame([(0, 9), (1, 10)], "a int, b int")
    assert [(r["column"], r["pass_ratio"]) for r in scan_report(data, found).collect()] == [("a", 0.5), ("b", 0.5)]
    with pytest.raises(ValueError, match="neither min nor max"):
        scan_report(data, [{"column": "a", "type": kind}])


def test_lineage(spark, inventory, rows):
    assert gov.lineage_edges(inventory).count() == 0
    edges = spark.createDataFrame([("a", "t"), ("a", "t"), (None, "t"), ("b", "u")], "source string, target string")
    assert rows(gov.lineage_of(edges, "t")) == [("a", "t")]


def test_inventory_per_line(spark, tmp_path):
    path = tmp_path / "many.json"
    path.write_text("\n".join(json.dumps(INVENTORY) for _ in range(3)))
    assert gov.tables(load_inventory(spark, str(path), one_per_line=True)).count() == 9


def test_mask_and_row_filter(spark):
    df = spark.createDataFrame([("Alice", "east"), ("Bob", "west"), (None, "west")], "name string, dept string")
    shown = [r["name"] for r in gov.mask(df, ["name"], F.col("dept") == "east").collect()]
    assert shown[0] == "Alice" and len(shown[1]) == 64 and shown[2] is None
    policy = {"east": "dept = 'east'", "all": "true"}
    assert [gov.row_filter(df, policy, role).count() for role in ("east", "all", "nobody")] == [1, 3, 0]


def test_profile_and_drift(spark, rows):
    before = spark.createDataFrame([(1, "a"), (2, None), (2, "b"), (3, "b")], "n int, s string")
    exact = gov.profile(before, ["n", "s"], exact=True)
    assert rows(exact) == [("n", 4, 0, 3, "1", "3"), ("s", 4, 1, 2, "a", "b")]
    assert rows(gov.profile(before, ["n", "s"])) == rows(exact)
    after = before.where("n < 3")
    assert rows(gov.drift(exact, gov.profile(after, ["n", "s"], exact=True))) == [("n", -1, 0.0, -1), ("s", -1, 0.083333, 0)]


def test_exact_profile_counts_each_column_alone(spark, rows, capsys):
    values = [(1, "a", 0.0), (1, "a", -0.0), (None, None, float("nan")), (2, "", float("nan")), (3, "b", None)]
    df = spark.createDataFrame(values, "n int, s string, d double")
    profile = gov.profile(df, ["n", "s", "d"], exact=True)
    profile.explain()
    assert "Expand" not in capsys.readouterr().out  # no rows as wide as all columns
    assert [r[:4] for r in rows(profile)] == [("d", 5, 1, 2), ("n", 5, 1, 3), ("s", 5, 1, 3)]
    assert [r[:4] for r in rows(gov.profile(df.limit(0), ["n", "d"], exact=True))] == [("d", 0, 0, 0), ("n", 0, 0, 0)]


def test_drift_of_exact_profiles_counts_each_column_alone(spark, rows, capsys):
    df = spark.createDataFrame([(1, "a", 5.0), (1, None, -1.0), (2, "b", 0.0), (None, "b", None)], "n int, s string, d double")
    found = gov.drift(gov.profile(df, ["n", "s", "d"], exact=True), gov.profile(df.where("d >= 0"), ["n", "s", "d"], exact=True))
    found.explain()
    assert "Expand" not in capsys.readouterr().out
    assert rows(found) == [("d", -2, -0.25, -1), ("n", -2, -0.25, 0), ("s", -2, -0.25, 0)]


def event(ts, passed, failed, flow="silver", status="COMPLETED", name="valid_fare"):
    entry = {"name": name, "dataset": flow, "passed_records": passed, "failed_records": failed}
    details = {"flow_progress": {"data_quality": {"expectations": [entry]}}}
    return {"timestamp": ts, "flow": flow, "status": status, "output_rows": passed, "details": json.dumps(details)}


def test_event_log(spark, tmp_path, rows):
    lines = [
        event("2026-07-27T10:00:00Z", 5, 5),
        event("2026-07-28T10:00:00Z", 21922, 10),
        event("2026-07-26T10:00:00Z", 1, 1, status="FAILED"),
        event("2026-07-28T09:00:00Z", 7, 0, name="pickup_present"),
        {"timestamp": "2026-07-28T11:00:00Z", "flow": "silver", "status": "RUNNING", "output_rows": None, "details": "{}"},
    ]
    path = tmp_path / "log.json"
    path.write_text("\n".join(json.dumps(line) for line in lines) + "\nnot json\n")
    log = load_event_log(spark, str(path))
    assert rows(expectation_log(log)) == [("silver", "pickup_present", 7, 0), ("silver", "valid_fare", 21922, 10)]
    assert rows(flow_history(log.where("flow IS NOT NULL"))) == [("silver", 5, 21935, 1, "RUNNING")]


def test_run_metrics(spark, tmp_path, rows):
    spark.range(6).write.parquet(str(tmp_path / "in"))
    query = (
        spark.readStream.schema("id long").parquet(str(tmp_path / "in")).writeStream.format("parquet")
        .option("checkpointLocation", str(tmp_path / "mark")).trigger(availableNow=True).start(str(tmp_path / "out"))
    )
    query.awaitTermination()
    assert [(r["batch_id"], r["input_rows"]) for r in run_metrics(spark, query).collect()] == [(0, 6)]
