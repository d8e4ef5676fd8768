"""Data-quality checks: every check runs, all are reported, and the job fails once at the end.

Checks that are aggregates over the same table are computed in one pass over it.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recollect.operators.sync import reconcile_counts
from recollect.sources.tables import table_properties

REPORT_COLUMNS = ("check", "status", "detail")
# Jobs of a report that run side by side.
CHECKS_AT_ONCE = 8


class CheckFailed(RuntimeError):
    """At least one check failed; holds every failure."""

    def __init__(self, failed: Sequence[str]):
        super().__init__("checks failed:\n  - " + "\n  - ".join(failed))
        self.failed = list(failed)


@dataclass(frozen=True)
class Aggregate:
    """A check that is one aggregate over a table: it passes when `passes(value)` holds."""

    name: str
    table: DataFrame
    value: Column
    passes: Callable[[Column], Column]
    detail: str


@dataclass(frozen=True)
class Report:
    """A check that needs its own query: `build` returns (check, status, detail) rows."""

    name: str
    build: Callable[[], DataFrame]


Check = Aggregate | Report


def _is_zero(value: Column) -> Column:
    return F.coalesce(value, F.lit(0)) == 0


def no_null_keys(table: DataFrame, key: str, name: str | None = None) -> Aggregate:
    """No row has a NULL key."""
    return Aggregate(
        name or f"{key} is never null", table, F.count_if(F.col(key).isNull()), _is_zero,
        "%d rows with a null key",
    )


def min_text_length(
    table: DataFrame, column: str, least: int = 20, name: str | None = None
) -> Aggregate:
    """No text is shorter than `least` characters."""
    return Aggregate(
        name or f"{column} has at least {least} characters", table,
        F.count_if(F.length(column) < least), _is_zero, "%d texts too short",
    )


def min_rows(table: DataFrame, least: int, name: str | None = None) -> Aggregate:
    """The table has at least `least` rows."""
    return Aggregate(
        name or f"at least {least} rows", table, F.count(F.lit(1)), lambda n: n >= least, "%d rows"
    )


def vector_width(table: DataFrame, column: str, width: int, name: str | None = None) -> Aggregate:
    """Every stored vector has the declared width; rows without a vector are not counted."""
    return Aggregate(
        name or f"{column} has width {width}", table, F.count_if(F.size(column) != width), _is_zero,
        "%d vectors of another width",
    )


def scope_isolation(table: DataFrame, in_scope: Column, name: str = "scope isolation") -> Report:
    """The result is not empty and every row of it is in scope; an empty result proves nothing."""

    def build() -> DataFrame:
        outside = F.count_if(~F.coalesce(in_scope, F.lit(False)))
        counted = table.agg(F.count(F.lit(1)).alias("n"), outside.alias("bad"))
        passed = (F.col("n") > 0) & (F.col("bad") == 0)
        return counted.select(
            *_row(name, passed, F.format_string("%d rows, %d out of scope", "n", "bad"))
        )

    return Report(name, build)


def unique_key(table: DataFrame, keys: Sequence[str], name: str | None = None) -> Report:
    """No non-null key occurs twice."""
    title = name or f"{', '.join(keys)} is unique"

    def build() -> DataFrame:
        known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
        repeated = (
            table.where(known).groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        )
        counted = repeated.agg(F.count(F.lit(1)).alias("n"))
        return counted.select(
            *_row(title, F.col("n") == 0, F.format_string("%d keys occur more than once", "n"))
        )

    return Report(title, build)


def values_present(
    table: DataFrame, column: str, expected: Sequence[str], name: str | None = None
) -> Report:
    """Every expected value occurs in the column."""
    title = name or f"{column} has all expected values"

    def build() -> DataFrame:
        found = [F.coalesce(F.bool_or(F.col(column) == v), F.lit(False)) for v in expected]
        absent = F.filter(
            F.array(*[F.when(~f, F.lit(v)) for f, v in zip(found, expected, strict=True)]),
            lambda v: v.isNotNull(),
        )
        counted = table.agg(absent.alias("absent"))
        detail = F.concat(F.lit("missing: "), F.array_join("absent", ", "))
        return counted.select(*_row(title, F.size("absent") == 0, detail))

    return Report(title, build)


def tables_present(
    found: DataFrame, expected: Sequence[str], name: str = "required tables"
) -> Report:
    """Every expected name is among the `table_name`s found."""

    def build() -> DataFrame:
        return values_present(found, "table_name", expected, name).build()

    return Report(name, build)


def property_set(spark: SparkSession, table: str, key: str, value: str) -> Report:
    """A catalog table has the property with the value."""
    title = f"{table}: {key} = {value}"

    def build() -> DataFrame:
        same = (F.col("key") == key) & (F.col("value") == value)
        counted = table_properties(spark, table).agg(
            F.coalesce(F.bool_or(same), F.lit(False)).alias("ok")
        )
        return counted.select(*_row(title, F.col("ok"), F.lit(f"{key} is not {value}")))

    return Report(title, build)


def counts_match(pairs: Mapping[str, tuple[DataFrame, DataFrame | None]]) -> Report:
    """Every mirror exists and has as many rows as its source; one report row per table."""

    def build() -> DataFrame:
        detail = F.concat_ws(
            " ", F.col("status"), F.concat(F.lit("source="), F.col("src_rows").cast("string")),
            F.concat(F.lit("mirror="), F.col("dst_rows").cast("string")),
        )
        name = F.concat(F.lit("mirror "), F.col("table_name"))
        ok = F.col("status") == "ok"
        return reconcile_counts(pairs).select(
            name.alias("check"), F.when(ok, "pass").otherwise("fail").alias("status"),
            detail.alias("detail"),
        )

    return Report("mirror counts", build)


def _row(name: str, passed: Column, detail: Column) -> list[Column]:
    return [
        F.lit(name).alias("check"),
        F.when(passed, "pass").otherwise("fail").alias("status"),
        F.when(passed, F.lit("ok")).otherwise(detail).alias("detail"),
    ]


def _one_pass(table: DataFrame, checks: Sequence[Aggregate]) -> DataFrame:
    """All aggregate checks of one table from a single pass over it."""
    counted = table.agg(*[c.value.alias(f"v{i}") for i, c in enumerate(checks)])
    rows = []
    for i, check in enumerate(checks):
        value = F.col(f"v{i}")
        rows.append(
            F.struct(*_row(check.name, check.passes(value), F.format_string(check.detail, value)))
        )
    return counted.select(F.explode(F.array(*rows)).alias("row")).select("row.*")


def run_checks(checks: Sequence[Check]) -> DataFrame:
    """`(check, status, detail)` of every check.

    The checks run here, as separate jobs side by side, each giving a row (or a row per mirror). One
    that fails, whether it cannot be planned or breaks while it runs, is reported as failed with the
    reason and does not keep the others from running. Aggregates of one table share a pass; when it
    breaks, each runs alone.
    """
    if not checks:
        raise ValueError("no checks given")
    groups: dict[object, list[Check]] = {}
    for i, check in enumerate(checks):
        groups.setdefault(id(check.table) if isinstance(check, Aggregate) else f"own {i}", []).append(check)

    def rows_of(group: Sequence[Check]) -> list[tuple]:
        try:
            first = group[0]
            built = _one_pass(first.table, group) if isinstance(first, Aggregate) else first.build()
            return [tuple(row) for row in built.select(*REPORT_COLUMNS).collect()]
        except Exception as error:
            if len(group) > 1:
                return [row for check in group for row in rows_of([check])]
            lines = str(error).strip().splitlines() or [""]
            return [(group[0].name, "fail", f"{type(error).__name__}: {lines[0]}")]

    with ThreadPoolExecutor(CHECKS_AT_ONCE) as pool:
        parts = list(pool.map(rows_of, groups.values()))
    return SparkSession.active().createDataFrame(
        [row for part in parts for row in part], "check string, status string, detail string"
    )


def failures(report: DataFrame) -> list[str]:
    """`check: detail` of every failed check; one row per check, so small."""
    bad = report.where(F.col("status") == "fail").orderBy("check").collect()
    return [f"{r['check']}: {r['detail']}" for r in bad]


def raise_if_failed(report: DataFrame) -> None:
    """Fail once, with all failures."""
    bad = failures(report)
    if bad:
        raise CheckFailed(bad)


def table_counts(tables: Mapping[str, DataFrame | None]) -> DataFrame:
    """`(table_name, present, n_rows)` of each expected table; None stands for a missing one."""
    parts = []
    spark = SparkSession.active()
    for name, table in tables.items():
        if table is None:
            counted = spark.range(1).select(F.lit(False).alias("present"), F.lit(None).cast("bigint").alias("n_rows"))
        else:
            counted = table.agg(F.lit(True).alias("present"), F.count(F.lit(1)).alias("n_rows"))
        parts.append(counted.select(F.lit(name).alias("table_name"), "present", "n_rows"))
    return reduce(DataFrame.unionByName, parts)
