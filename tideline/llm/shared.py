"""Helpers of the text operators: written tables, safe column names, sliced Arrow batches."""

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.session import scratch_dir

# Bytes of text that one vectorised step inside a task takes at once.
SLICE_BYTES = 2 << 20


def written(df: DataFrame, label: str) -> DataFrame:
    """Write a table below the shared scratch folder and read it back: cuts lineage, survives lost executors."""
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def let(value: Column, body) -> Column:
    """`body(value)` with `value` computed once, however often the body uses it."""
    return F.transform(F.array(value), body)[0]


def fresh(df: DataFrame, name: str) -> str:
    """A column name that `df` does not have yet, whatever its letter case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def as_rows(batch: pa.RecordBatch, **columns: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*batch.columns, *columns.values()], [*batch.schema.names, *columns])


def slices(batch: pa.RecordBatch, column: int, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that the texts of a slice hold about `limit` bytes; a longer text is a slice of its own."""
    sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0).to_pylist()
    start = total = 0
    for i, size in enumerate(sizes):
        if total and total + size > limit:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += size
    if start < len(sizes):
        yield batch.slice(start)


def most_frequent(counts: DataFrame, limit: int, n: str = "n") -> DataFrame:
    """The rows of `counts` with the highest numbers in column `n`, at most `limit` of them.

    Rows are taken down to a number found from a histogram in steps of a 16th of a power of two, so that no task
    and not the driver sees more than `limit` rows; the rows of a step are taken together or not at all."""
    step = F.floor(F.log2(n) * 16)
    least, total = None, 0
    for row in counts.groupBy(step.alias("step")).agg(F.count("*").alias("size")).orderBy(F.desc("step")).collect():
        total += row["size"]
        if total > limit:
            break
        least = row["step"]
    return counts.limit(0) if least is None else counts.filter(step >= least)
