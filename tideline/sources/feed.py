"""The supplier feed: CSV files with a header, one per month."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tideline.schemas import FEED_COLUMNS


# Column with the whole line where its number of fields is not that of the header.
BROKEN = "_corrupt_record"


def text_schema(columns: list[str]) -> StructType:
    """All columns as text: malformed values are handled by `clean_feed`, not by the reader."""
    schema = StructType()
    for name in [*columns, BROKEN]:
        schema.add(name, "string")
    return schema


# A file whose header does not name the columns in order is an error; lines with missing or surplus fields are kept
# as such, for the reject table. Fields are counted only where all of them are parsed, so no columns are pruned.
READING = {"header": True, "enforceSchema": False, "columnNameOfCorruptRecord": BROKEN, "columnPruning": False}


def with_origin(raw: DataFrame) -> DataFrame:
    return raw.withColumn("source_file", F.col("_metadata.file_path"))


def read_feed(spark: SparkSession, path: str, columns: list[str] = FEED_COLUMNS) -> DataFrame:
    """All files of the feed, as text, with the file each row came from. Blank values are null."""
    return with_origin(spark.read.schema(text_schema(columns)).options(**READING).csv(path))


def stream_feed(
    spark: SparkSession, path: str, columns: list[str] = FEED_COLUMNS, files_per_batch: int = 1000
) -> DataFrame:
    """The same feed as a stream of newly arrived files."""
    reader = spark.readStream.schema(text_schema(columns)).options(**READING)
    return with_origin(reader.option("maxFilesPerTrigger", files_per_batch).csv(path))


def _typed() -> dict[str, Column]:
    return {
        "delivery_id": F.col("delivery_id"),
        "product_id": F.expr("try_cast(product_id AS bigint)"),
        "supplier_id": F.col("supplier_id"),
        "supplier_name": F.col("supplier_name"),
        "delivery_date": F.expr("try_cast(delivery_date AS date)"),
        "quantity": F.expr("try_cast(quantity_received AS int)"),
        "unit_cost": F.expr("try_cast(unit_cost AS decimal(10,2))"),
    }


def reject_reason() -> Column:
    """Why a row is malformed, null for a sound one: `fields` for a wrong number of fields, `delivery_id` for a missing
    id, or the first column whose value is present but does not fit its type."""
    typed = _typed()
    reason = F.when(F.col(BROKEN).isNotNull(), "fields").when(F.col("delivery_id").isNull(), "delivery_id")
    for raw, name in [
        ("product_id", "product_id"),
        ("delivery_date", "delivery_date"),
        ("quantity_received", "quantity"),
        ("unit_cost", "unit_cost"),
    ]:
        reason = reason.when(F.col(raw).isNotNull() & typed[name].isNull(), raw)
    return reason


def clean_feed(raw: DataFrame) -> DataFrame:
    """Typed delivery rows with a flag for a missing cost; malformed rows are left to `rejected_feed`."""
    typed = [c.alias(n) for n, c in _typed().items()]
    extra = [c for c in raw.columns if c == "source_file"]
    rows = raw.filter(reject_reason().isNull()).select(*typed, *extra)
    return rows.withColumn("is_unit_cost_missing", F.col("unit_cost").isNull())


def rejected_feed(raw: DataFrame) -> DataFrame:
    """The malformed rows, as text, with the reason and an id made of all their values, for a reject table.

    `line` is the whole line where the number of fields is wrong."""
    row_id = F.md5(F.to_json(F.struct(*raw.columns)))
    named = raw.withColumns({"reason": reject_reason(), "reject_id": row_id})
    return named.filter(F.col("reason").isNotNull()).withColumnRenamed(BROKEN, "line")


def counted_rejects(raw: DataFrame) -> DataFrame:
    """One row per rejected line of a file, with the number of times the file holds it; a file arrives in one batch."""
    rejected = rejected_feed(raw)
    return rejected.groupBy(*rejected.columns).agg(F.count("*").alias("n_lines"))
