"""Keys of a growing table as bitmaps per load: distinct counts that merge, and the buckets worth an exact look.

A bucket covers 32,768 neighbouring positions, so whole-number keys that lie close together cost about a bit each. The
position of a key may be any whole number computed from it. If different keys share one, repeats are still found exactly,
only more rows are read for it; distinct counts need a position per key.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.operators.latest import Keys
from tideline.operators.quality import unique


def key_bitmaps(rows: DataFrame, position: Column, load: str) -> DataFrame:
    """(load, bucket, bits, n_rows) of the rows of one or more loads; rows without a position are left out.

    Rows are counted per position before they move, so a position with a large part of all rows is no burden, and bitmaps
    are made after the shuffle, one bucket at a time, so that scattered keys do not send a bitmap each.
    """
    placed = rows.select(F.col(load).alias("load"), position.cast("long").alias("position")).filter("position is not null")
    counts = placed.groupBy("load", "position").agg(F.count("*").alias("n"))
    bits = counts.select("load", F.bitmap_bucket_number("position").alias("bucket"), F.bitmap_bit_position("position").alias("bit"), "n")
    made = bits.repartition("load", "bucket").groupBy("load", "bucket")
    return made.agg(F.bitmap_construct_agg("bit").alias("bits"), F.sum("n").alias("n_rows"))


def merged(bitmaps: DataFrame) -> DataFrame:
    """(bucket, n_positions, n_rows) over all loads."""
    positions = F.bitmap_count(F.bitmap_or_agg("bits"))
    return bitmaps.groupBy("bucket").agg(positions.alias("n_positions"), F.sum("n_rows").alias("n_rows"))


def distinct_positions(bitmaps: DataFrame) -> DataFrame:
    """One row: distinct positions and rows over all loads, without reading the table."""
    sums = merged(bitmaps).agg(F.sum("n_positions").alias("n_keys"), F.sum("n_rows").alias("n_rows"))
    return sums.select(F.coalesce("n_keys", F.lit(0)).alias("n_keys"), F.coalesce("n_rows", F.lit(0)).alias("n_rows"))


def doubtful(bitmaps: DataFrame) -> DataFrame:
    """(load, bucket) of all rows that may repeat a key: buckets with fewer positions than rows, in every load that has them.

    Equal keys have equal positions, so no repeat lies outside them.
    """
    return bitmaps.join(merged(bitmaps).filter("n_positions < n_rows").select("bucket"), "bucket", "left_semi").select("load", "bucket")


def repeated_keys(rows: DataFrame, bitmaps: DataFrame, key: Keys, position: Column, load: str) -> DataFrame:
    """Non-null keys with more than one row over all loads, as `unique` gives them, from the doubtful rows alone.

    Where rows are stored by load, loads without a doubtful bucket are not read.
    """
    look = doubtful(bitmaps).select(F.col("load").alias("_load"), F.col("bucket").alias("_bucket"))
    here = (F.col(load) == F.col("_load")) & (F.bitmap_bucket_number(position.cast("long")) == F.col("_bucket"))
    return unique(rows.join(look, here, "left_semi"), key)
