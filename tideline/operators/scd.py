"""Slowly changing dimensions, type 1 and type 2.

A type-2 dimension holds its attributes, `scd_id`, `valid_from` and `valid_to`. Versions cover
[valid_from, valid_to); the open version ends at 9999-12-31.
"""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideline.functions import literal, open_end, version_id
from tideline.operators.latest import Keys, as_list, latest_row, total_order
from tideline.operators.skew import hot_tokens, is_hot, slice_column

VERSION_COLUMNS = ["scd_id", "valid_from", "valid_to"]


def scd1(df: DataFrame, key: str, order_by: Keys, columns: Sequence[str], surrogate: str) -> DataFrame:
    """Latest attributes per key; the natural key also serves as surrogate."""
    rows = latest_row(df.select(key, *columns, *[c for c in as_list(order_by) if c not in columns]), key, order_by)
    return rows.select(F.col(key).alias(surrogate), key, *columns)


def _versions(rows: DataFrame, key: list[str], updated_at: str, valid_to: Column) -> DataFrame:
    kind = rows.schema[updated_at].dataType
    attributes = [c for c in rows.columns if c != updated_at and not c.startswith("_")]
    return rows.select(
        *attributes,
        version_id(key, updated_at).alias("scd_id"),
        F.col(updated_at).alias("valid_from"),
        F.coalesce(valid_to, open_end(kind.simpleString())).alias("valid_to"),
    )


def scd2_rebuild(changes: DataFrame, key: Keys, updated_at: str) -> DataFrame:
    """All versions from a change log; each change closes the one before it.

    Of several rows with one key and time the greatest by the other columns counts. One window per
    key finds both the winners and the ends: in descending order a row survives if the time above it
    differs, and that time is its end. Timelines of hot keys are cut into slices first. Rows without a change
    time begin no version and are left out.
    """
    keys = as_list(key)
    changes = changes.filter(F.col(updated_at).isNotNull())
    hot = hot_tokens(changes, keys)
    if hot:
        return _rebuild_sliced(changes, keys, updated_at, hot)
    return _versions(_close(changes, keys, keys, updated_at), keys, updated_at, F.col("_next"))


def scd2_open(changes: DataFrame, key: Keys, updated_at: str) -> DataFrame:
    """The open version of every key of a change log: the open rows of `scd2_rebuild`.

    Only the latest change of a key counts, so a key sends one row per map task through the shuffle, and there
    is no timeline to be sliced.
    """
    changes = changes.filter(F.col(updated_at).isNotNull())
    return scd2_first(latest_row(changes, key, updated_at), key, updated_at)


def _close(rows: DataFrame, group: list[str], key: list[str], updated_at: str) -> DataFrame:
    plain = rows.drop("_slice")
    w = Window.partitionBy(*group).orderBy(*total_order(plain, key, updated_at))
    later = rows.withColumn("_next", F.lag(updated_at).over(w))
    return later.filter(F.col("_next").isNull() | (F.col("_next") != F.col(updated_at)))


def _rebuild_sliced(changes: DataFrame, key: list[str], updated_at: str, hot: dict[int, int]) -> DataFrame:
    # Copies of one key and time cannot be sliced apart; reduce them in the map tasks first.
    single = latest_row(changes, [*key, updated_at], updated_at)
    in_slice = slice_column(changes, key, updated_at, hot)
    closed = _close(single.withColumn("_slice", in_slice), [*key, "_slice"], key, updated_at)
    # The last version of a slice ends where the next slice of its key begins: one row per hot key and
    # slice, few enough for Spark to send to every task. Null keys are a key here, as they are for the window.
    cut = changes.filter(is_hot(key, hot)).withColumn("_slice", in_slice)
    starts = cut.groupBy(*key, "_slice").agg(F.min(updated_at).alias("_start"))
    following = F.lead("_start").over(Window.partitionBy(*key).orderBy("_slice"))
    edges = starts.select(*[F.col(k).alias(f"_{k}") for k in key], F.col("_slice").alias("_at_slice"), following.alias("_following"))
    same = F.col("_slice") == F.col("_at_slice")
    for k in key:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    joined = closed.join(edges, same, "left").drop(*[f"_{k}" for k in key])
    return _versions(joined, key, updated_at, F.coalesce("_next", "_following"))


def scd2_first(batch: DataFrame, key: Keys, updated_at: str) -> DataFrame:
    """Open versions for a batch with one row per key: the first snapshot."""
    return _versions(batch, as_list(key), updated_at, F.lit(None))


def scd2_apply(dim: DataFrame, batch: DataFrame, key: Keys, updated_at: str) -> DataFrame:
    """Apply one snapshot of the source to a dimension.

    New key: open a version. Newer `updated_at`: close the open version at it and open a new one.
    Same or older, or a key missing from the batch: nothing changes. Applying a batch twice is the
    same as applying it once. Of several batch rows per key the latest counts.
    """
    keys = as_list(key)
    now = latest_row(batch, keys, updated_at)
    fresh = scd2_first(now, keys, updated_at)
    # Only open versions meet the batch; closed history is passed through without a shuffle.
    old = current(dim).select(*keys, F.struct(*dim.columns).alias("_old"))
    new = fresh.select(*keys, F.struct(*dim.columns).alias("_new"))
    newer = F.col("_new.valid_from") > F.col("_old.valid_from")
    closed = F.col("_old").withField("valid_to", F.col("_new.valid_from"))
    versions = (
        F.when(F.col("_old").isNull(), F.array("_new"))
        .when(newer, F.array(closed, "_new"))
        .otherwise(F.array("_old"))
    )
    merged = old.join(new, keys, "full").select(F.inline(versions)).select(*dim.columns)
    return dim.filter(~is_open()).unionByName(merged)


def is_open() -> Column:
    return F.col("valid_to") == open_end()


def current(dim: DataFrame) -> DataFrame:
    """The open version of every key."""
    return dim.filter(is_open())


def as_of(dim: DataFrame, at) -> DataFrame:
    """The versions valid at an instant."""
    instant = literal(at)
    return dim.filter((F.col("valid_from") <= instant) & (F.col("valid_to") > instant))


def prepare(df: DataFrame, columns: Mapping[str, str], updated_at: str) -> DataFrame:
    """Attributes of a dimension under their output names, with the time they last changed.

    The input is a table with one row per key, so no de-duplication is needed, and processing stamps
    stay out.
    """
    return df.select(*[F.col(c).alias(name) for c, name in columns.items()], updated_at)


def version_floor(dim: DataFrame, key: Keys) -> DataFrame:
    """Start of the earliest version per key."""
    return dim.groupBy(*as_list(key)).agg(F.min("valid_from").alias("earliest_valid_from"))


def snowflake_as_of(dim: DataFrame, outer: DataFrame, key: str, at) -> DataFrame:
    """Two dimensions, each at one instant by its own validity, joined on their natural key."""
    left = as_of(dim, at).drop("valid_from", "valid_to")
    right = as_of(outer, at).drop("valid_from", "valid_to")
    return left.join(right, key, "left")
