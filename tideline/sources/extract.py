"""Query-based incremental extract: rows above a cursor, latest state only."""

from pyspark.sql import DataFrame, SparkSession

from tideline.operators.incremental import newer_than
from tideline.operators.latest import Keys, latest_row


def extract_since(source: DataFrame, cursor: str, key: Keys, since=None, tiebreak: Keys | None = None) -> DataFrame:
    """Latest state of every row changed after `since`; everything when `since` is None.

    The bound is a literal, so parquet and JDBC sources evaluate it themselves.
    """
    return latest_row(newer_than(source, cursor, since), key, cursor, tiebreak)


def jdbc_table(
    spark: SparkSession, url: str, table: str, key: str, bounds: tuple[int, int], partitions: int, **options: str
) -> DataFrame:
    """A database table read in parallel ranges of its numeric key; filters are pushed to the database."""
    return spark.read.jdbc(
        url, table, column=key, lowerBound=bounds[0], upperBound=bounds[1], numPartitions=partitions, properties=options
    )
