"""Conflicting and needless rules against trying values; rules of many tables; reachability against a plain search."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from siltstone.operators.lineage import closure
from siltstone.operators.rules import NOT_ABOVE, column_limits, normal_form, rule_conflicts
from siltstone.operators.scan import NON_NULL, RANGE, SET, measured_rules

SCHEMA = "table_name string, name string, `column` string, type string, min string, max string, `values` array<string>, other string, ignore_null boolean"
CANDIDATES = [None, *range(-3, 14)]


def passes(rule, value):
    _, _, _, kind, low, high, values, _, ignore_null = rule
    if value is None:
        return bool(ignore_null) and kind != NON_NULL
    if kind == RANGE:
        return (low is None or value >= float(low)) and (high is None or value <= float(high))
    return str(value) in values if kind == SET else True


def random_rules(seed, n, orders):
    source = random.Random(seed)
    rules = []
    for i in range(n):
        kind = source.choice([RANGE] * 3 + [NON_NULL, SET] + [NOT_ABOVE] * orders)
        low = source.choice([None, source.randrange(-2, 9)])
        high = source.choice([None, source.randrange(3, 12)])
        values = sorted({str(source.randrange(0, 11)) for _ in range(8)}) if kind == SET else None
        column = source.choice("abc")
        other = source.choice([c for c in "abcd" if c != column]) if kind == NOT_ABOVE else None
        rules.append((f"t{source.randrange(4)}", f"r{i:02}", column, kind, None if low is None else str(low), None if high is None else str(high), values, other, source.choice([True, False, None])))
    return rules


@pytest.mark.parametrize("seed", range(4))
def test_verdicts(spark, seed):
    """What is needed lets the same values pass as all rules; contradicted columns let none pass."""
    rules = random_rules(seed, 60, 0)
    verdicts = {r.name: r.verdict for r in rule_conflicts(spark.createDataFrame(rules, SCHEMA)).collect()}
    assert len(verdicts) == len(rules)
    columns = defaultdict(list)
    for rule in rules:
        columns[rule[0], rule[2]].append(rule)
    for own in columns.values():
        allowed = [v for v in CANDIDATES if all(passes(r, v) for r in own)]
        found = {verdicts[r[1]] for r in own}
        assert (found == {"contradicted"}) == (not allowed)
        if allowed:
            kept = [r for r in own if verdicts[r[1]] == "needed"]
            assert [v for v in CANDIDATES if all(passes(r, v) for r in kept)] == allowed
            for r in own:  # none of bounds or NULL is kept that others make needless
                if verdicts[r[1]] == "needed" and not any(x[3] == SET for x in own):
                    less = [x for x in kept if x is not r]
                    wider = [v for v in [None, *range(-50, 50)] if all(passes(x, v) for x in less)]
                    assert wider != [v for v in [None, *range(-50, 50)] if all(passes(x, v) for x in kept)]


@pytest.mark.parametrize("seed", range(3))
def test_bounds_travel(spark, seed):
    rules = random_rules(seed, 50, 2) + [("t9", "c1", "a", NOT_ABOVE, None, None, None, "b", False), ("t9", "c2", "b", NOT_ABOVE, None, None, None, "a", False), ("t9", "c3", "b", RANGE, "2", "5", None, None, False)]
    got = {(r.table_name, r.column_name): (r.low, r.high) for r in column_limits(normal_form(spark.createDataFrame(rules, SCHEMA))).collect()}
    limits, edges = defaultdict(lambda: [float("-inf"), float("inf")]), set()
    for table, _, column, kind, low, high, _, other, _ in rules:
        own = limits[table, column]
        if kind == RANGE:
            own[0], own[1] = max(own[0], float(low or "-inf")), min(own[1], float(high or "inf"))
        if kind == NOT_ABOVE:
            edges.add((table, column, other))
            limits[table, other]  # noqa: B018 - a column that is only compared with has a row too
    for _ in range(10):
        for table, below, above in edges:
            limits[table, below][1] = min(limits[table, below][1], limits[table, above][1])
            limits[table, above][0] = max(limits[table, above][0], limits[table, below][0])
    assert got == {k: tuple(v) for k, v in limits.items()}
    assert got["t9", "a"] == (2.0, 5.0)


def test_rules_of_many_tables(spark, rows):
    rules = [("t1", "a", RANGE, "0", "5"), ("t1", "a", NON_NULL, None, None), ("t2", "a", RANGE, None, "1"), ("t3", "b", RANGE, "1", None), ("t1", "zz", NON_NULL, None, None), ("t2", "b", "regex_expectation", None, None)]
    data = [("t1", 3.0, 1), ("t1", 9.0, 1), ("t1", None, 1), ("t1", 3.0, 1), ("t2", 1.0, 0), ("t4", 1.0, 0)]
    rule_rows = spark.createDataFrame(rules, "table_name string, `column` string, type string, min string, max string")
    got = measured_rules(rule_rows, spark.createDataFrame(data, "table_name string, a double, b int"), ["a", "b"])
    assert rows(got.select("table_name", "column", "type", "row_count", "passed_rows", "passed")) == [
        ("t1", "a", NON_NULL, 4, 3, False), ("t1", "a", RANGE, 4, 2, False), ("t2", "a", RANGE, 1, 1, True), ("t3", "b", RANGE, 0, 0, True)
    ]


def search(edges, starts):
    following, out = defaultdict(set), {}
    for a, b in edges:
        if a is not None and b is not None:
            following[a].add(b)
    for start in starts:
        frontier, hops, seen = following[start], 1, set()
        while frontier := frontier - seen:
            out |= {(start, node): hops for node in frontier}
            seen |= frontier
            frontier, hops = set().union(*(following[n] for n in frontier)), hops + 1
    return out


@pytest.mark.parametrize("nodes, n", [(12, 40), (60, 70), (3, 9)])
def test_closure(spark, nodes, n):
    source = random.Random(nodes)
    edges = [(f"n{source.randrange(nodes)}", f"n{source.randrange(nodes)}") for _ in range(n)] + [(None, "n1"), ("n1", None), ("n0", "n0")]
    df = spark.createDataFrame(edges, "source string, target string").repartition(3)
    got = {(r.start, r.node): r.hops for r in closure(df).collect()}
    assert got == search(edges, {a for a, b in edges if a and b})
    up = {(r.start, r.node): r.hops for r in closure(df, spark.createDataFrame([("n2",), ("n2",), ("other",)], "x string"), upstream=True).collect()}
    assert up == search([(b, a) for a, b in edges], ["n2"])
    near = closure(df, most_hops=2)
    assert {(r.start, r.node): r.hops for r in near.collect()} == {k: h for k, h in got.items() if h <= 2}


def test_long_ways_and_nothing(spark):
    chain = spark.range(25).select(F.col("id").alias("source"), (F.col("id") + 1).alias("target"))
    got = closure(chain, spark.createDataFrame([(0,)], "id long"))
    assert got.agg(F.max("hops"), F.count("*")).first() == (25, 25)
    assert closure(chain.limit(0)).collect() == []
