"""Tables stored by hash bucket, so that joins and groupings on the key start from the scan."""

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.session import scratch_dir


def bucketed_table(df: DataFrame, key: str, buckets: int, name: str | None = None, path: str | None = None) -> DataFrame:
    """Write a catalog table with one sorted file per bucket of `key`, and read it.

    Tables with the same number of buckets join on their keys, and group by them, without a shuffle. Choose about one
    bucket per GB of the largest. Without a name the table gets one of its own, and without a path its files go to the
    scratch folder; dropping it leaves them there. Rows with a null key share a bucket. A key with a large part of all
    rows fills one bucket, which no plan can split: readers join such keys another way.
    """
    name = name or f"bucketed_{uuid.uuid4().hex[:12]}"
    rows = df.repartition(buckets, F.col(key))  # hashed as buckets are, so that each bucket is one file
    writer = rows.write.format("parquet").bucketBy(buckets, key).sortBy(key)
    writer.option("path", path or scratch_dir(df.sparkSession, "bucketed")).saveAsTable(name)
    return df.sparkSession.table(name)
