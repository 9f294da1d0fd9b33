import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from siltstone.functions.names import VERDICT
from siltstone.functions.rules import passes, range_rule
from siltstone.operators.quality import (
    assert_rows,
    at_least,
    expect_or_drop,
    expect_or_fail,
    expectation_metrics,
    forced_fault,
    observed,
    observed_metrics,
    quarantine,
    validated_table,
    with_reason,
    with_verdict,
)

TRIP = "fare double, distance double, zip int"
RULES = {"valid_fare": "fare > 0", "non_negative_distance": "distance >= 0", "zip_present": "zip IS NOT NULL"}
TRIPS = [
    (5.0, 1.0, 1),
    (-1.0, 1.0, 1),
    (0.0, 2.0, 2),
    (7.0, None, 3),
    (None, 1.0, 4),
    (9.0, 0.0, None),
    (None, None, None),
]


@pytest.fixture
def trips(spark):
    return spark.createDataFrame(TRIPS, TRIP)


def test_null_rule_counts_as_broken(trips, rows):
    assert rows(expect_or_drop(trips, RULES)) == [(5.0, 1.0, 1)]
    assert quarantine(trips, RULES).count() == 6


def test_no_rules_keeps_all_and_quarantines_none(trips):
    assert expect_or_drop(trips, {}).count() == 7
    assert quarantine(trips, {}).count() == 0


def test_metrics_per_rule(trips, rows):
    assert rows(expectation_metrics(trips, RULES)) == sorted(
        [("non_negative_distance", 5, 2), ("valid_fare", 3, 4), ("zip_present", 5, 2)], key=repr
    )
    assert expectation_metrics(trips, {}).count() == 0


def test_metrics_while_writing(trips, tmp_path):
    df, observation = observed(trips, RULES)
    df.write.parquet(str(tmp_path / "out"))
    assert observed_metrics(observation, RULES)[0] == {"name": "valid_fare", "passed_records": 3, "failed_records": 4}


def test_drop_reaches_the_scan(spark, trips, tmp_path, capsys):
    path = str(tmp_path / "t")
    trips.write.parquet(path)
    expect_or_drop(spark.read.parquet(path), {"valid_fare": "fare > 0"}).explain("formatted")
    assert "PushedFilters: [IsNotNull(fare), GreaterThan(fare,0.0)]" in capsys.readouterr().out


def test_first_reason_wins(spark, rows):
    df = spark.createDataFrame([(None, 500.0, -1), ("a", 500.0, -1), ("a", 5.0, -1), ("a", 5.0, None)], "d string, v double, b int")
    reasons = [("d IS NULL", "null_device_id"), ("NOT (v <= 100)", "value_out_of_range"), ("b < 0", "negative_battery")]
    got = [r[-1] for r in with_reason(df, reasons).collect()]
    assert got == ["null_device_id", "value_out_of_range", "negative_battery", "null_rule_input"]


def test_range_rule_quotes_and_bounds(spark):
    rule = range_rule("m", "v", {"o'clock": (0, 1.5), "b": (-2, 2)})
    df = spark.createDataFrame([("o'clock", 1.5), ("o'clock", 1.6), ("b", -2.0), ("x", 1.0), (None, 1.0), ("b", None)], "m string, v double")
    assert [r[0] for r in df.select(passes({"r": rule})).collect()] == [True, False, True, False, False, False]
    assert [r[0] for r in df.select(passes({"r": range_rule("m", "v", {})})).collect()] == [False] * 6


def test_fail_fast_names_the_rule(spark, trips, tmp_path):
    # rows that break this one rule; with several broken, whichever task fails first is reported
    with pytest.raises(PySparkException, match="valid_fare"):
        validated_table(spark, trips.where("fare <= 0"), RULES, str(tmp_path / "bad"))
    with pytest.raises(PySparkException, match="rule .* broken"):
        validated_table(spark, trips, RULES, str(tmp_path / "worse"))
    good = trips.where("fare = 5")
    assert validated_table(spark, good, RULES, str(tmp_path / "good")).count() == 1


def test_fail_fast_counts_null_as_broken_and_survives_pruning(trips):
    with pytest.raises(PySparkException, match="zip_present"):
        expect_or_fail(trips.where("fare = 9"), {"zip_present": "zip > 0"}).select("fare").count()


def test_fault_switch(trips, rows):
    assert rows(forced_fault(trips.where("fare = 5"), "zip", "fare < 0", "forced", inject=False)) == [(1, "recovered")]
    with pytest.raises(PySparkException, match="forced"):
        forced_fault(trips, "zip", "fare < 0", "forced", inject=True).collect()
    assert forced_fault(trips.where("false"), "zip", "fare < 0", "forced", inject=True).count() == 0
    assert assert_rows(trips, "fare < 0", "off", enabled=False).count() == 7


def test_independent_branch(spark):
    assert spark.range(100).selectExpr("id", "'ok' AS status").count() == 100


def test_parameter(trips):
    assert [at_least(trips, "fare", m).count() for m in (0, 6, 100)] == [4, 2, 0]


number = st.one_of(st.none(), st.sampled_from([-1.0, 0.0, 0.5, 3.0, float("nan")]))


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(number, number, st.one_of(st.none(), st.integers(0, 3))), max_size=12))
def test_silver_and_quarantine_make_up_bronze(spark, data):
    bronze = spark.createDataFrame(data, TRIP)
    silver, bad = expect_or_drop(bronze, RULES), quarantine(bronze, RULES)
    both = silver.unionByName(bad)
    assert both.exceptAll(bronze).count() == 0 and bronze.exceptAll(both).count() == 0
    assert with_verdict(bronze, RULES).where(F.col(VERDICT) == "silver").count() == silver.count()
