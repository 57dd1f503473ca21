"""Hot keys, and time slices that spread their timelines over many tasks.

A window partitioned by key puts all rows of a key into one task. Where a key holds a large part of
the rows, its timeline is cut at common quantiles, the window runs per key and slice, and what must
cross a slice edge travels in a summary with one row per hot key and slice.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.operators.latest import as_list, Keys

# Rows of one key above which its timeline is sliced, unless the session sets another number.
HOT_ROWS = 5_000_000
HOT_ROWS_SETTING = "spark.tideline.hotRows"
# Cells by the hash of the key in which rows are counted first, and cells that a filter names at most.
CELLS, NAMED_CELLS = 1 << 14, 256
# Slices of a broadcast dimension, and rows that are enough to place slice bounds.
MAX_SLICES = 256
SAMPLE_ROWS = 1_000_000


def token(keys: Sequence[str]) -> Column:
    return F.xxhash64(*keys)


def hot_limit(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get(HOT_ROWS_SETTING, str(HOT_ROWS)))


def hot_tokens(df: DataFrame, key: Keys) -> dict[int, int]:
    """Hashes of the keys with more than `hot_limit` rows, with their row counts.

    Counts are formed in the map tasks. The first ones are by cells of many keys: where no cell is above the limit, no
    key is, and the shuffle carries no more than a number per cell and task. Else keys of the cells above it are counted,
    a hash and a number per key and task. However many keys are above the limit, all of them come back: at most
    the number of rows divided by the limit.
    """
    limit = hot_limit(df)
    tokens, cell = df.select(token(as_list(key)).alias("t")), F.pmod("t", F.lit(CELLS))
    full = [row["cell"] for row in tokens.groupBy(cell.alias("cell")).count().filter(F.col("count") > limit).collect()]
    if not full:
        return {}
    counts = (tokens.filter(cell.isin(full)) if len(full) <= NAMED_CELLS else tokens).groupBy("t").count().filter(F.col("count") > limit)
    return {row["t"]: row["count"] for row in counts.collect()}


def is_hot(key: Keys, hot: dict[int, int]) -> Column:
    return token(as_list(key)).isin(list(hot))


def slice_bounds(df: DataFrame, at: str, rows: int, rows_per_slice: int) -> list:
    """Quantiles of `at` that cut `rows` rows into slices of about `rows_per_slice`.

    The rows are those of all hot keys, so no key has more than that in a slice. The bounds steer the balance only, not the result, so a sample of the rows places them.
    """
    n = max(2, -(-rows // rows_per_slice))
    some = df if rows <= SAMPLE_ROWS else df.sample(SAMPLE_ROWS / rows, seed=1)
    cuts = some.agg(F.percentile_approx(at, [i / n for i in range(1, n)], 10 * max(n, MAX_SLICES)).alias("cuts")).first()["cuts"]
    return sorted(set(cuts or []))


def slice_of(at: Column, bounds: list) -> Column:
    """Number of bounds at or below the value, as a balanced tree of comparisons."""

    def pick(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(at < F.lit(bounds[mid]), pick(lo, mid)).otherwise(pick(mid + 1, hi))

    return pick(0, len(bounds))


def slice_column(df: DataFrame, key: Keys, at: str, hot: dict[int, int]) -> Column:
    """The quantile slice of `at` for hot keys, 0 for the others; `df` holds the rows to be spread."""
    bounds = slice_bounds(df.filter(is_hot(key, hot)), at, sum(hot.values()), hot_limit(df))
    return F.when(is_hot(key, hot), slice_of(F.col(at), bounds)).otherwise(F.lit(0))
