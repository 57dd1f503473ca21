"""Type-2 dimensions over all of time: two timelines overlaid, and changes that arrive inside closed history."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideline.operators.latest import Keys, as_list
from tideline.operators.scd import VERSION_COLUMNS, scd2_rebuild
from tideline.operators.skew import hot_tokens, slice_column

# Order of marks at one time: an end looks at what began before it, a start also at what begins with it.
ENDS, BEGINS, STARTS = 0, 1, 2


def late_versions(dim: DataFrame, changes: DataFrame, key: Keys, updated_at: str) -> DataFrame:
    """The versions that changes add to a dimension or give another end or value, wherever in its history they fall.

    A change inside a closed version splits it, one before the first version opens the history earlier, and one at the
    start of a version counts if it is the greater by the other columns, as in `scd2_rebuild`. No version ever goes,
    so a merge of these rows by `scd_id` is all that a stored dimension needs. Only keys in `changes` are read beyond
    a semi-join; hot ones are sliced as in the rebuild. Changes without a time are left out.
    """
    keys = as_list(key)
    attributes = [c for c in changes.columns if c not in {*keys, updated_at}]
    batch = changes.filter(F.col(updated_at).isNotNull())
    own = _of_keys(dim, batch, keys, "left_semi")
    columns = [*keys, *attributes]
    known = own.select(*columns, F.col("valid_from").alias(updated_at))
    rebuilt = scd2_rebuild(known.unionByName(batch.select(*columns, updated_at)), keys, updated_at)
    # Versions that stay as they are come in pairs, one from either side.
    order = [*columns, *VERSION_COLUMNS]
    sides = rebuilt.select(*order, F.lit(1).alias("_new")).unionByName(own.select(*order, F.lit(0).alias("_new")))
    alone = sides.groupBy(*order).agg(F.count("*").alias("_n"), F.max("_new").alias("_new")).filter("_n = 1 AND _new = 1")
    return alone.select(*order)


def scd2_late(dim: DataFrame, changes: DataFrame, key: Keys, updated_at: str) -> DataFrame:
    """The dimension with changes of any age applied: equal to `scd2_rebuild` over all changes, in whatever order they came.

    `scd2_apply`, which passes over changes that are not newer than the open version, stays the way to take snapshots.
    Applying changes again changes nothing.
    """
    fresh = late_versions(dim, changes, key, updated_at)
    kept = dim.join(fresh.select("scd_id"), "scd_id", "left_anti")
    return kept.select(*dim.columns).unionByName(fresh.select(*dim.columns))


def _of_keys(dim: DataFrame, batch: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Rows whose key is among the batch's; a null key is a key here, as it is for a window."""
    wanted = batch.select(*[F.col(k).alias(f"_{k}") for k in keys]).distinct()
    on = F.lit(True)
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"_{k}"))
    return dim.join(wanted, on, how)


def numbered(marks: DataFrame, key: str, at: str) -> DataFrame:
    """Marks with `_n`, how many outer versions of their key began up to them, in the order of time and kind of mark.

    One window per key; keys with more marks than a task should hold are cut into time slices, and the counts of
    earlier slices travel in one row per key and slice.
    """
    began = F.sum(F.when(F.col("_mark") == BEGINS, 1).otherwise(0))
    hot = hot_tokens(marks, key)
    if not hot:
        return marks.withColumn("_n", began.over(Window.partitionBy(key).orderBy(at, "_mark").rowsBetween(Window.unboundedPreceding, 0)))
    sliced = marks.withColumn("_slice", slice_column(marks, key, at, hot))
    totals = sliced.groupBy(key, "_slice").agg(began.alias("_total"))
    earlier = Window.partitionBy(key).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(F.col(key).alias("_k"), F.col("_slice").alias("_s"), F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_before"))
    inside = Window.partitionBy(key, "_slice").orderBy(at, "_mark").rowsBetween(Window.unboundedPreceding, 0)
    counted = sliced.withColumn("_n", began.over(inside))
    on = (F.col(key) == F.col("_k")) & (F.col("_slice") == F.col("_s"))
    return counted.join(offsets, on).withColumn("_n", F.col("_n") + F.col("_before")).drop("_slice", "_k", "_s", "_before")


def snowflake_timeline(dim: DataFrame, outer: DataFrame, key: str, dim_key: Keys) -> DataFrame:
    """Every version of `dim` cut at the starts of the `outer` versions its `key` refers to, with their columns.

    Looking at the result at an instant gives what `snowflake_as_of` gives there. `dim_key` and `valid_from` tell the
    versions of `dim` apart. Versions of an outer key follow each other without a gap, as type-2 dimensions here do; a
    time before the first of them, and a key that is null or unknown, has null outer columns.

    Outer versions are numbered along their key, and a version of `dim` counts those begun by its start and before its
    end. These two numbers name the outer versions it overlaps, so pieces come from an equality join on key and number: as
    many rows as pieces, and no interval is ever compared with one that it misses.
    """
    others = [c for c in outer.columns if c not in {key, "valid_from", "valid_to"}]
    own = [c for c in dim.columns if c not in {"valid_from", "valid_to"}]
    ident = as_list(dim_key)
    known = dim.filter(F.col(key).isNotNull())
    payload = F.struct(*own, F.col("valid_from").alias("_from"), F.col("valid_to").alias("_to"))
    body = F.struct(*[F.col(c) for c in others], F.col("valid_from").alias("_from"), F.col("valid_to").alias("_to"))
    ids = F.struct(*[F.col(c).alias(f"k{i}") for i, c in enumerate(ident)], F.col("valid_from").alias("at"))

    def marks(df: DataFrame, at: str, kind: int, row: Column, version: Column, number: Column) -> DataFrame:
        columns = [F.col(key), F.col(at).alias("_at"), F.lit(kind).alias("_mark")]
        return df.select(*columns, number.alias("_id"), row.alias("_row"), version.alias("_version"))

    no_row, no_version, no_id = (F.lit(None).cast(df.select(c.alias("x")).schema["x"].dataType) for df, c in ((dim, payload), (outer, body), (dim, ids)))
    every = marks(known, "valid_from", STARTS, payload, no_version, ids)
    every = every.unionByName(marks(known, "valid_to", ENDS, no_row, no_version, ids))
    versions = outer.filter(F.col(key).isNotNull())
    every = every.unionByName(marks(versions, "valid_from", BEGINS, no_row, body, no_id))
    counted = numbered(every, key, "_at")

    numbers = counted.filter(F.col("_mark") == BEGINS).select(F.col(key).alias("_key"), F.col("_n").alias("_number"), "_version")
    # Number nought stands for the time before the first version, which ends where that one starts.
    before = numbers.filter("_number = 1").select(
        "_key", F.lit(0).cast("long").alias("_number"), no_version.alias("_version"), F.col("_version._from").alias("_end")
    )
    numbers = numbers.withColumn("_end", F.col("_version._to")).unionByName(before)
    spans = (
        counted.filter(F.col("_mark") != BEGINS)
        .groupBy(key, "_id")
        .agg(
            F.max(F.when(F.col("_mark") == STARTS, F.col("_n"))).alias("_first"),
            F.max(F.when(F.col("_mark") == ENDS, F.col("_n"))).alias("_last"),
            F.first("_row", ignorenulls=True).alias("_row"),
        )
    )
    pieces = spans.select(key, "_row", F.explode(F.sequence("_first", F.greatest("_first", "_last"))).alias("_n"))
    joined = pieces.join(numbers, (F.col(key) == F.col("_key")) & (F.col("_n") == F.col("_number")), "left")
    start = F.greatest(F.col("_row._from"), F.col("_version._from"))
    end = F.least(F.col("_row._to"), F.col("_end"))
    found = joined.select(
        *[F.col(f"_row.{c}").alias(c) for c in own], *[F.col(f"_version.{c}").alias(c) for c in others], start.alias("valid_from"), end.alias("valid_to")
    )
    nulls = [F.lit(None).cast(outer.schema[c].dataType).alias(c) for c in others]
    return found.unionByName(dim.filter(F.col(key).isNull()).select(*own, *nulls, "valid_from", "valid_to"))
