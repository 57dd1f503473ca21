"""Session settings and the shared scratch folder."""

import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime SQL settings the operators rely on: adaptive execution picks broadcast joins from
# measured sizes, merges small partitions and splits skewed join partitions, also where the
# split costs the next join its partitioning. A union must not rely on the partitioning its inputs
# were planned with: adaptive execution may read them in different numbers of partitions. Stored
# tables are mostly ids and times, which zstd packs far better than the default codec.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.unionOutputPartitioning": "false",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.session.timeZone": "UTC",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new, unused folder below the shared checkpoint folder of the session.

    Every executor must reach it, so a machine-local default is only made in local mode.
    """
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not base:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="tideline-"))
        base = context.getCheckpointDir()
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex[:12]}"
