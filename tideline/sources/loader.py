"""Bulk load of the source tables from CSV files: only rows with unseen keys are inserted."""

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from tideline.schemas import PRIMARY_KEY, SOURCE_TABLES
from tideline.sources.catalog import table_counts
from tideline.sources.store import StoredTable


def read_source_csv(spark: SparkSession, path: str, name: str) -> DataFrame:
    """One source table from CSV files with a header; a value that does not fit its type is an error."""
    reader = spark.read.schema(SOURCE_TABLES[name]).option("header", True).option("mode", "FAILFAST")
    return reader.csv(path)


def load_sources(spark: SparkSession, root: str, files: Mapping[str, str], buckets: int = 16) -> DataFrame:
    """Insert the new rows of each file into its table below `root`; returns the row count per table.

    Existing rows never change, so loading a file again inserts nothing.
    """
    tables = {name: StoredTable(spark, f"{root}/{name}", PRIMARY_KEY[name], buckets) for name in files}
    for name, path in files.items():
        tables[name].insert_if_absent(read_source_csv(spark, path, name), "updated_timestamp")
    return table_counts({name: table.read() for name, table in tables.items()})
