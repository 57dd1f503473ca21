"""Latest row per key."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

Keys = str | Sequence[str]


def as_list(cols: Keys) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


def total_order(df: DataFrame, key: Keys, order_by: Keys, tiebreak: Keys | None = None) -> list[Column]:
    """Descending order that leaves no ties: order columns, then `tiebreak` or all other columns."""
    first = as_list(order_by)
    if tiebreak is None:
        used = {*as_list(key), *first}
        rest = [c for c in df.columns if c not in used]
    else:
        rest = as_list(tiebreak)
    return [F.col(c).desc_nulls_last() for c in [*first, *rest]]


def deciding(df: DataFrame, key: Keys, order_by: Keys, columns: Sequence[str]) -> DataFrame:
    """The columns that settle the values of `columns` in the last row per key by `order_by` and all other columns.

    Rows alike in every column of the order down to the last wanted one have the wanted values in common, so the
    columns behind it need not move."""
    first = [*as_list(key), *as_list(order_by)]
    rest = [c for c in df.columns if c not in first]
    last = max((i for i, c in enumerate(rest) if c in columns), default=-1)
    kept = {*first, *rest[: last + 1]}
    return df.select(*[c for c in df.columns if c in kept])


def latest_row(df: DataFrame, key: Keys, order_by: Keys, tiebreak: Keys | None = None, columns: Sequence[str] | None = None) -> DataFrame:
    """Keep the last row per key by `order_by`, with all of its columns or with `columns`.

    The rank filter becomes a group limit that runs in every map task before the shuffle, so a key
    sends at most one row per task, however many rows it has.
    """
    if columns is not None:
        slim = deciding(df, key, order_by, columns) if tiebreak is None else df
        return latest_row(slim, key, order_by, tiebreak).select(*columns)
    w = Window.partitionBy(*as_list(key)).orderBy(*total_order(df, key, order_by, tiebreak))
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def earliest_row(df: DataFrame, key: Keys, order_by: str) -> DataFrame:
    """Keep the first row per key by a column that is unique within the key."""
    w = Window.partitionBy(*as_list(key)).orderBy(F.col(order_by).asc_nulls_last())
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def distinct_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct combinations of the given columns (not a substitute for `latest_row`)."""
    return df.select(*columns).distinct()
