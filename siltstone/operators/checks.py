"""Checks on stored tables: rows and whole datasets, errors and warnings.

A check list holds entries of the form::

    {"name": ..., "criticality": "error" | "warn",
     "check": {"function": ..., "arguments": {...}}}

Every row keeps its columns and gains ``_errors`` and ``_warnings``: arrays of
what failed, NULL when nothing did.  NULL input passes every check except
``is_not_null``, unless the check sets ``null_fails: true``.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from siltstone.functions.casts import struct_of
from siltstone.operators.skew import FAN, ROWS, any_null, fan_of, fits_broadcast, key_counts, skew_left_join, skew_left_flags
from siltstone.session import fresh_path

ERRORS = "_errors"
WARNINGS = "_warnings"

_BAD = "__bad"


@dataclass(frozen=True)
class Outcome:
    """How one check shows on a row."""

    broken: Column
    message: str
    columns: Sequence[str] = ()


@dataclass
class Frame:
    """The table under check, with the flag columns dataset checks have added."""

    df: DataFrame
    source: DataFrame
    refs: Mapping[str, DataFrame]
    as_of: Any = None
    run: bool = True
    flags: list[str] = field(default_factory=list)
    large: list[tuple[DataFrame, list[str], DataFrame]] = field(default_factory=list)

    def flag(self, verdicts: DataFrame, keys: Sequence[str]) -> Column:
        """Mark the rows whose key has ``__bad`` set in ``verdicts`` (one row per key, with counts).

        Bad and hot keys are worked out first and stored in the shared folder.
        While the bad ones are few, which is what a check is for, marking rows
        is a broadcast join on the way through the table and its rows never
        shuffle; only large sets of bad keys are joined by shuffle, by :meth:`join_large`.
        """
        name = f"__flag_{len(self.flags)}"
        self.flags.append(name)
        marks = verdicts.select(*keys, _BAD, fan_of(verdicts).alias(FAN)).where(F.col(_BAD) | (F.col(FAN) > 1))
        if not self.run:
            marks.schema  # noqa: B018 - analysed only
            return F.lit(False)
        spark = self.source.sparkSession
        path = fresh_path(spark, "flagged-keys")
        marks.write.parquet(path)
        stored = spark.read.schema(marks.schema).parquet(path)
        bad = stored.where(_BAD).select(*keys, F.lit(True).alias(name))
        if fits_broadcast(bad):
            self.df = self.df.join(F.broadcast(bad), list(keys), "left")
        else:
            self.large.append((bad, list(keys), stored.where(F.col(FAN) > 1)))
        return F.coalesce(F.col(name), F.lit(False))

    def join_large(self) -> None:
        """Join the large sets of bad keys; the rows shuffle once for two kinds of keys if one has all columns of the other."""
        waiting = sorted(self.large, key=lambda x: len(x[1]))
        while waiting:
            fewest = set(waiting[0][1])
            more = next((set(keys) for _, keys, _ in waiting if fewest < set(keys) and self._hashes_alike(set(keys) - fewest)), fewest)
            together = [x for x in waiting if set(x[1]) in (fewest, more)]
            waiting = [x for x in waiting if set(x[1]) not in (fewest, more)]
            if len(together) == 1:
                self.df = skew_left_join(self.df, *together[0])
            else:
                self.df = skew_left_flags(self.df, together)

    def _hashes_alike(self, columns: set[str]) -> bool:
        """Whether equal values have equal hashes, which texts with a collation need not have."""
        return "collate" not in self.source.select(*columns).schema.simpleString()

    def mark_missing(self, found: DataFrame, keys: Sequence[str]) -> Column:
        """Rows whose key is not among the few of ``found``; a NULL part is not missing.

        The keys are stored in the shared folder, so the reference is worked out once, and broadcast.
        """
        name = f"__flag_{len(self.flags)}"
        self.flags.append(name)
        few, path = found.withColumnRenamed("__found", name), fresh_path(self.source.sparkSession, "known-keys")
        few.write.parquet(path)
        few = self.source.sparkSession.read.schema(few.schema).parquet(path)
        self.df = self.df.join(F.broadcast(few), list(keys), "left")
        return F.col(name).isNull() & ~any_null(keys)

    def reference(self, args: Mapping[str, Any]) -> DataFrame:
        if args.get("ref") is not None:
            return args["ref"]
        table = args["ref_table"]
        return self.refs[table] if table in self.refs else self.source.sparkSession.read.table(table)


def _unless(ok: Column, null_fails: bool) -> Column:
    return ~F.coalesce(ok, F.lit(not null_fails))


def is_not_null(frame: Frame, column: str) -> Outcome:
    return Outcome(F.col(column).isNull(), f"{column} is null", [column])


def sql_expression(
    frame: Frame, expression: str, msg: str | None = None, name: str | None = None, null_fails: bool = False
) -> Outcome:
    return Outcome(_unless(F.expr(expression), null_fails), msg or f"not true: {expression}")


def is_in_range(frame: Frame, column: str, min_limit: Any, max_limit: Any, null_fails: bool = False) -> Outcome:
    ok = F.col(column).between(F.lit(min_limit), F.lit(max_limit))
    return Outcome(_unless(ok, null_fails), f"{column} outside {min_limit}..{max_limit}", [column])


def is_not_less_than(frame: Frame, column: str, limit: Any, null_fails: bool = False) -> Outcome:
    return Outcome(_unless(F.col(column) >= F.lit(limit), null_fails), f"{column} below {limit}", [column])


def is_not_in_future(frame: Frame, column: str, offset: int = 0, null_fails: bool = False) -> Outcome:
    now = F.current_timestamp() if frame.as_of is None else F.lit(frame.as_of).cast("timestamp")
    ok = F.col(column).cast("timestamp") <= now + F.make_interval(secs=F.lit(offset))
    return Outcome(_unless(ok, null_fails), f"{column} lies in the future", [column])


def is_unique(frame: Frame, columns: Sequence[str]) -> Outcome:
    """Every member of a repeated key is flagged; a key with a NULL part passes.

    Keys are counted, combined before the shuffle, and only repeated ones are
    joined back, so no task ever holds a whole group of copies.
    """
    counts = key_counts(frame.source, columns).withColumn(_BAD, F.col(ROWS) > 1)
    return Outcome(frame.flag(counts, columns), f"{', '.join(columns)} not unique", columns)


def foreign_key(
    frame: Frame,
    columns: Sequence[str],
    ref_columns: Sequence[str],
    ref_table: str | None = None,
    ref: DataFrame | None = None,
    null_fails: bool = False,
) -> Outcome:
    """The key occurs in the reference; a key with a NULL part passes unless ``null_fails``.

    A small reference marks the rows on their way through the table, without a
    count or a shuffle of it.  With a large one the verdict is found once per
    distinct key, then joined back.
    """
    columns = list(columns)
    known = frame.reference({"ref_table": ref_table, "ref": ref}).select(
        *(F.col(r).alias(c) for r, c in zip(ref_columns, columns, strict=True))
    )
    found = known.distinct().withColumn("__found", F.lit(True))
    if frame.run and fits_broadcast(found.drop("__found")):
        broken = frame.mark_missing(found, columns)
    else:
        broken = _flag_missing(frame, found, columns)
    if null_fails:
        broken = broken | any_null(columns)
    return Outcome(broken, f"{', '.join(columns)} not in {ref_table or 'reference'}", columns)


def _flag_missing(frame: Frame, found: DataFrame, columns: list[str]) -> Column:
    verdicts = key_counts(frame.source, columns).join(found, columns, "left")
    return frame.flag(verdicts.withColumn(_BAD, F.col("__found").isNull()), columns)


def is_aggr_not_greater_than(frame: Frame, column: str, aggr_type: str, limit: Any) -> Outcome:
    """One aggregate of the whole table against a limit; every row carries the verdict."""
    value = frame.source.agg(_aggregate(column, aggr_type)).scalar()
    return Outcome(_unless(value <= F.lit(limit), False), f"{aggr_type}({column}) above {limit}", [])


def _aggregate(column: str, aggr_type: str) -> Column:
    functions = {"count": F.count, "sum": F.sum, "avg": F.avg, "min": F.min, "max": F.max}
    if aggr_type not in functions:
        raise ValueError(f"unknown aggr_type {aggr_type!r}")
    return functions[aggr_type](F.lit(1) if column == "*" else F.col(column))


FUNCTIONS: dict[str, Callable[..., Outcome]] = {
    f.__name__: f
    for f in (
        is_not_null,
        sql_expression,
        is_in_range,
        is_not_less_than,
        is_not_in_future,
        is_unique,
        foreign_key,
        is_aggr_not_greater_than,
    )
}

CRITICALITIES = {"error": ERRORS, "warn": WARNINGS}


def apply_checks(
    df: DataFrame,
    specs: Sequence[Mapping[str, Any]],
    refs: Mapping[str, DataFrame] | None = None,
    as_of: Any = None,
) -> DataFrame:
    """Attach diagnostics; never adds, drops or reorders columns or rows of the input.

    Row checks are one projection.  A uniqueness or reference check first runs
    over the key columns alone, so apply this to a stored table rather than to
    a frame that is costly to compute.
    """
    return _annotated(df, specs, Frame(df, df, refs or {}, as_of))


def _annotated(df: DataFrame, specs: Sequence[Mapping[str, Any]], frame: Frame) -> DataFrame:
    found: dict[str, list[Column]] = {ERRORS: [], WARNINGS: []}
    for spec in specs:
        function, args = spec["check"]["function"], dict(spec["check"].get("arguments", {}))
        outcome = FUNCTIONS[function](frame, **args)
        entry = F.struct(
            F.lit(spec.get("name") or function).alias("name"),
            F.lit(outcome.message).alias("message"),
            F.array(*(F.lit(c) for c in outcome.columns)).cast("array<string>").alias("columns"),
            F.lit(function).alias("check"),
        )
        found[CRITICALITIES[spec.get("criticality", "error")]].append(F.when(outcome.broken, entry))
    frame.join_large()
    return frame.df.select(*df.columns, *(_collected(cols).alias(side) for side, cols in found.items()))


def _collected(entries: list[Column]) -> Column:
    kind = "array<struct<name:string,message:string,columns:array<string>,check:string>>"
    if not entries:
        return F.lit(None).cast(kind)
    # a nested coalesce is a cheap "any": most rows never build the array
    return F.when(F.coalesce(*entries).isNotNull(), F.array_compact(F.array(*entries))).cast(kind)


def has_errors() -> Column:
    return F.expr(f"{ERRORS} IS NOT NULL AND size({ERRORS}) > 0")


def has_warnings() -> Column:
    return F.expr(f"{WARNINGS} IS NOT NULL AND size({WARNINGS}) > 0")


def split_checks(annotated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, quarantine): errors go to quarantine, rows with warnings alone stay valid."""
    return annotated.filter(~has_errors()), annotated.filter(has_errors())


def verdict_counts(annotated: DataFrame) -> DataFrame:
    """total, valid, quarantine, warned_valid in a single pass."""
    return annotated.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(~has_errors()).alias("valid"),
        F.count_if(has_errors()).alias("quarantine"),
        F.count_if(has_warnings() & ~has_errors()).alias("warned_valid"),
    )


def validate_checks(
    spark: SparkSession,
    specs: Sequence[Mapping[str, Any]],
    schema: str | StructType,
    refs: Mapping[str, DataFrame] | None = None,
) -> list[str]:
    """What is wrong with a check list, found by analysing it against an empty table.

    A sound list is analysed once; only a broken one is taken apart.
    """
    empty = spark.createDataFrame([], struct_of(schema))
    if all(_shape_problem(spec) is None for spec in specs) and _analysis_problem(empty, specs, refs) is None:
        return []
    problems = []
    for position, spec in enumerate(specs):
        problem = _shape_problem(spec) or _analysis_problem(empty, [spec], refs)
        if problem:
            problems.append(f"{spec.get('name') or f'check {position}'}: {problem}")
    return problems


def _shape_problem(spec: Mapping[str, Any]) -> str | None:
    function = (spec.get("check") or {}).get("function")
    if spec.get("criticality", "error") not in CRITICALITIES:
        return f"unknown criticality {spec['criticality']!r}"
    return None if function in FUNCTIONS else f"unknown function {function!r}"


def _analysis_problem(
    empty: DataFrame, specs: Sequence[Mapping[str, Any]], refs: Mapping[str, DataFrame] | None
) -> str | None:
    try:
        _annotated(empty, specs, Frame(empty, empty, refs or {}, run=False)).schema  # noqa: B018 - forces analysis
    except (PySparkException, TypeError, ValueError, KeyError) as fault:
        return str(fault).strip().splitlines()[0]
    return None
