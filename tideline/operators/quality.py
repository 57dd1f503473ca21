"""Data-quality checks: each returns its violations, an empty DataFrame is a pass.

Column rules of one table share a single scan. Checks that compare keys aggregate per key first, so
a frequent key costs one row per map task.
"""

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.operators.latest import Keys, as_list
from tideline.operators.scd import current

ERROR, WARN = "error", "warn"

# Checks evaluated at the same time.
THREADS = 4


def _rules(df: DataFrame, bad: Mapping[str, Column]) -> DataFrame:
    """One row per violated rule with its number of rows, from a single aggregate over `df`."""
    counts = df.agg(*[F.count_if(c).alias(f"r{i}") for i, c in enumerate(bad.values())])
    pairs = [F.struct(F.lit(name).alias("rule"), F.col(f"r{i}").alias("n_rows")) for i, name in enumerate(bad)]
    return counts.select(F.inline(F.array(*pairs))).filter("n_rows > 0")


def not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Columns that hold nulls, with the number of rows."""
    return _rules(df, {c: F.col(c).isNull() for c in columns})


def expression_is_true(df: DataFrame, rules: Sequence[str]) -> DataFrame:
    """SQL conditions that some rows break. A condition that is null counts as kept."""
    return _rules(df, {r: ~F.expr(r) for r in rules})


def column_rules(df: DataFrame, columns: Sequence[str] = (), rules: Sequence[str] = ()) -> DataFrame:
    """`not_null` and `expression_is_true` of one table in one scan."""
    nulls = {f"{c} is not null": F.col(c).isNull() for c in columns}
    return _rules(df, nulls | {r: ~F.expr(r) for r in rules})


def unique(df: DataFrame, key: Keys) -> DataFrame:
    """Non-null keys with more than one row."""
    keys = as_list(key)
    counts = df.dropna(subset=keys).groupBy(*keys).agg(F.count("*").alias("n_rows"))
    return counts.filter("n_rows > 1")


def fan_out(df: DataFrame, key: Keys) -> DataFrame:
    """Keys that would multiply the rows of a join with `df`: the check before a lookup join."""
    return unique(df, key)


def relationships(child: DataFrame, foreign_key: str, parent: DataFrame, key: str) -> DataFrame:
    """Non-null foreign keys without a parent row, with the number of child rows."""
    used = child.filter(F.col(foreign_key).isNotNull()).groupBy(foreign_key).agg(F.count("*").alias("n_rows"))
    known = parent.select(F.col(key).alias("_known")).distinct()
    return used.join(known, F.col(foreign_key) == F.col("_known"), "left_anti")


def open_versions(dim: DataFrame, key: Keys) -> DataFrame:
    """Keys with several open versions."""
    return unique(current(dim), key)


def null_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows in which any of the columns is null: lookups that found nothing."""
    return df.filter(reduce(Column.__or__, [F.col(c).isNull() for c in columns]))


def counts_of(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row with the row count of every table, by output name."""
    parts = [df.agg(F.count("*").alias("n")).select(F.lit(name).alias("name"), "n") for name, df in tables.items()]
    rows = reduce(DataFrame.unionByName, parts)
    return rows.agg(*[F.max(F.when(F.col("name") == name, F.col("n"))).alias(name) for name in tables])


def grain(output: DataFrame, source: DataFrame) -> DataFrame:
    """The two row counts where they differ."""
    return counts_of({"output_rows": output, "source_rows": source}).filter("output_rows <> source_rows")


def distinct_grain(output: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """Rows of `output` and distinct keys of `source`, where they differ."""
    keys = source.filter(F.col(key).isNotNull()).select(key).distinct()
    return counts_of({"output_rows": output, "source_keys": keys}).filter("output_rows <> source_keys")


def count_consistency(tables: Mapping[str, DataFrame], broken: str) -> DataFrame:
    """The row counts of several tables where the condition `broken` over them holds."""
    return counts_of(tables).filter(broken)


@dataclass(frozen=True)
class Measures:
    """What a quality gate counts on one table, by output name: nulls of columns, and duplicates of a key."""

    table: DataFrame
    nulls: Mapping[str, str]
    duplicates: str
    key: str


def gate_measures(parts: Sequence[Measures]) -> DataFrame:
    """One row with all measures of a quality gate. A null key with several rows counts as one duplicate key.

    Each table is scanned once: null counts ride on the aggregate by key that finds the duplicates.
    """
    rows = []
    for part in parts:
        nulls = [F.count_if(F.col(c).isNull()).alias(f"_{n}") for n, c in part.nulls.items()]
        per_key = part.table.groupBy(part.key).agg(F.count("*").alias("_rows"), *nulls)
        sums = [F.coalesce(F.sum(f"_{n}"), F.lit(0)).alias(n) for n in part.nulls]
        totals = per_key.agg(*sums, F.count_if(F.col("_rows") > 1).alias(part.duplicates))
        pairs = [F.struct(F.lit(n).alias("name"), F.col(n).alias("n")) for n in totals.columns]
        rows.append(totals.select(F.inline(F.array(*pairs))))
    names = [n for part in parts for n in [*part.nulls, part.duplicates]]
    every = reduce(DataFrame.unionByName, rows)
    return every.agg(*[F.max(F.when(F.col("name") == n, F.col("n"))).alias(n) for n in names])


def quality_gate(parts: Sequence[Measures]) -> DataFrame:
    """The measures of a gate when any of them is above zero."""
    measures = gate_measures(parts)
    return measures.filter(reduce(Column.__or__, [F.col(c) > 0 for c in measures.columns]))


def freshness(df: DataFrame, cursor: str, now: datetime, limit: timedelta) -> DataFrame:
    """The latest cursor value when it is older than `limit` at `now`, or when there is none."""
    oldest = F.lit((now - limit).isoformat(sep=" ")).cast("timestamp_ntz")
    latest = df.agg(F.max(cursor).cast("timestamp_ntz").alias("latest"))
    return latest.filter(F.col("latest").isNull() | (F.col("latest") < oldest))


@dataclass(frozen=True)
class Check:
    """A named check, evaluated when its stage is tested: rows that violate it, or their number where it is known."""

    name: str
    violations: Callable[[], DataFrame | int]
    severity: str = ERROR
    tags: frozenset[str] = frozenset()


@dataclass(frozen=True)
class Result:
    check: Check
    failures: int


class GateFailed(RuntimeError):
    """Checks of severity error found violations."""


def run_checks(checks: Sequence[Check], tags: Sequence[str] = ()) -> list[Result]:
    """Evaluate the checks, or those with one of the tags: one counting job each, several side by side."""
    chosen = [c for c in checks if not tags or c.tags & set(tags)]
    with ThreadPoolExecutor(THREADS) as pool:
        return list(pool.map(lambda c: Result(c, _failures(c.violations())), chosen))


def _failures(found: DataFrame | int) -> int:
    return found if isinstance(found, int) else found.count()


def gate(stage: str, checks: Sequence[Check], tags: Sequence[str] = ()) -> list[Result]:
    """Run the checks of a stage and stop on violations of severity error."""
    results = run_checks(checks, tags)
    failed = [f"{r.check.name}: {r.failures}" for r in results if r.failures and r.check.severity == ERROR]
    if failed:
        raise GateFailed(f"{stage}: " + "; ".join(failed))
    return results
