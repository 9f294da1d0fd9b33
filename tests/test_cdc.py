import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from siltstone.operators.cdc import _cuts, _with_chunk, latest_changes, scd1, scd2

SCHEMA = "id int, name string, city string, op string, seq long"
FEED = [
    (1, "Alice", "Seoul", "INSERT", 1),
    (2, "Bob", "Busan", "INSERT", 2),
    (3, "Carol", "Daegu", "INSERT", 3),
    (2, "Bob", "Incheon", "UPDATE", 4),
    (3, None, None, "DELETE", 5),
    (4, "Dave", "Jeju", "INSERT", 6),
]
ARGS = (["id"], "seq", "op = 'DELETE'", ["op", "seq"])


def expected_scd1(changes):
    newest = {}
    for id_, name, city, op, seq in changes:
        rank = (seq, op == "DELETE", (name is not None, name or ""), (city is not None, city or ""))
        if id_ not in newest or rank > newest[id_][0]:
            newest[id_] = (rank, (id_, name, city), op)
    return sorted((row for _, row, op in newest.values() if op != "DELETE"), key=repr)


def expected_scd2(changes):
    best = {}
    for id_, name, city, op, seq in changes:
        rank = (op == "DELETE", (name is not None, name or ""), (city is not None, city or ""))
        if (id_, seq) not in best or rank > best[id_, seq][0]:
            best[id_, seq] = (rank, name, city, op)
    out = []
    for (id_, seq), (_, name, city, op) in best.items():
        later = [s for i, s in best if i == id_ and s > seq]
        if op != "DELETE":
            out.append((id_, name, city, seq, min(later, default=None)))
    return sorted(out, key=repr)


def test_worked_example(spark, rows):
    feed = spark.createDataFrame(FEED, SCHEMA)
    assert rows(scd1(feed, *ARGS)) == [(1, "Alice", "Seoul"), (2, "Bob", "Incheon"), (4, "Dave", "Jeju")]
    history = scd2(feed, *ARGS)
    assert history.columns == ["id", "name", "city", "__START_AT", "__END_AT"]
    assert [(r[0], r[3], r[4]) for r in history.orderBy("__START_AT").collect()] == [
        (1, 1, None),
        (2, 2, 4),
        (3, 3, 5),
        (2, 4, None),
        (4, 6, None),
    ]
    assert rows(scd2(feed, *ARGS, distinct=True)) == rows(history)


@pytest.mark.parametrize(
    "extra",
    [
        [(3, "Late", "X", "UPDATE", 4)],
        [(3, "Again", "Y", "INSERT", 9)],
        FEED,
        [(1, "Null", "Z", None, 7)],
        [(1, "Tie A", "Z", "UPDATE", 8), (1, "Tie B", "A", "UPDATE", 8), (1, None, None, "DELETE", 8)],
    ],
    ids=["late change before a delete", "insert after delete", "replay", "NULL operation", "tie"],
)
def test_variants(spark, rows, extra):
    changes = FEED + extra
    random.Random(1).shuffle(changes)
    feed = spark.createDataFrame(changes, SCHEMA).repartition(3)
    assert rows(scd1(feed, *ARGS)) == expected_scd1(changes)
    assert rows(scd2(feed, *ARGS)) == expected_scd2(changes)


def test_latest_keeps_deletes_and_columns(spark, rows):
    latest = latest_changes(spark.createDataFrame(FEED, SCHEMA), *ARGS)
    assert latest.columns == ["id", "name", "city", "op", "seq"]
    assert (3, None, None, "DELETE", 5) in rows(latest)


change = st.tuples(
    st.integers(1, 3),
    st.sampled_from(["a", "b", None]),
    st.sampled_from(["x", None]),
    st.sampled_from(["INSERT", "DELETE", None]),
    st.integers(1, 8),
)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(change, max_size=25))
def test_any_feed_matches_brute_force(spark, changes):
    feed = spark.createDataFrame(changes, SCHEMA).repartition(4)
    collect = lambda df: sorted((tuple(r) for r in df.collect()), key=repr)
    assert collect(scd1(feed, *ARGS)) == expected_scd1(changes)
    assert collect(scd2(feed, *ARGS)) == expected_scd2(changes)


def skewed(spark, n=6000):
    """One key with a third of all rows, text sequences to be safe about types."""
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"),
        F.col("id").alias("seq"),
        (F.col("id") * 7 % 11).alias("v"),
    )


def test_hot_key_history_is_cut_into_chunks(spark):
    feed = skewed(spark).withColumn("__seq", F.col("seq"))
    cuts = _cuts(feed.select("k", "__seq"), ["k"], 64)
    assert cuts.count() == 1
    sizes = [r["count"] for r in _with_chunk(feed, ["k"], cuts).where("k = 0").groupBy("__chunk").count().collect()]
    assert len(sizes) >= 12 and max(sizes) < 2000 / 5


@pytest.mark.parametrize("kind", ["bigint", "string", "timestamp", "NULL key"])
def test_hot_key_history_is_exact(spark, rows, kind):
    feed = skewed(spark)
    if kind == "NULL key":
        feed = feed.withColumn("k", F.nullif("k", F.lit(0)))
    if kind == "string":
        feed = feed.withColumn("seq", F.lpad(F.col("seq").cast("string"), 8, "0"))
    if kind == "timestamp":
        feed = feed.withColumn("seq", F.timestamp_seconds("seq"))
    got = scd2(feed, ["k"], "seq", "v = 3", ["seq"], shares=64)
    plain = (
        feed.selectExpr("*", "lead(seq) OVER (PARTITION BY k ORDER BY seq) AS e").where("v <> 3").select("k", "v", "seq", "e")
    )
    assert rows(got) == rows(plain)
