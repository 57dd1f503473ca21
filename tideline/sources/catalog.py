"""Tables by logical name, and their row counts."""

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


class Catalog:
    """Logical names mapped to parquet paths, catalog tables (`table:name`) or DataFrames."""

    def __init__(self, spark: SparkSession, entries: Mapping[str, str | DataFrame]):
        self.spark = spark
        self.entries = dict(entries)
        # Schemas of parquet entries, inferred by one job each at the first read.
        self.schemas: dict[str, StructType] = {}

    @classmethod
    def of_folder(cls, spark: SparkSession, folder: str, names: list[str]) -> "Catalog":
        return cls(spark, {n: f"{folder}/{n}.parquet" for n in names})

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self.entries:
            raise KeyError(f"unknown table {name!r}; known: {sorted(self.entries)}")
        entry = self.entries[name]
        if isinstance(entry, DataFrame):
            return entry
        if entry.startswith("table:"):
            return self.spark.table(entry.removeprefix("table:"))
        if entry not in self.schemas:
            self.schemas[entry] = self.spark.read.parquet(entry).schema
        return self.spark.read.schema(self.schemas[entry]).parquet(entry)

    def __setitem__(self, name: str, entry: str | DataFrame) -> None:
        self.entries[name] = entry


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table: its name and number of rows (read from file footers where possible)."""
    counts = [df.agg(F.count("*").alias("n_rows")).select(F.lit(n).alias("table_name"), "n_rows") for n, df in tables.items()]
    return reduce(DataFrame.unionByName, counts)
