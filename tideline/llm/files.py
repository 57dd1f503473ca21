"""Files in folders that the driver and all tasks share."""

from urllib.parse import urlsplit

from pyarrow import fs
from pyspark.sql import SparkSession


def qualified(spark: SparkSession, location: str) -> str:
    """The location with a scheme: one without is a path of Spark's default file system."""
    path = spark._jvm.org.apache.hadoop.fs.Path(location)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return path.makeQualified(system.getUri(), system.getWorkingDirectory()).toString()


def file_system(location: str) -> tuple[fs.FileSystem, str]:
    """The file system and path of a qualified location."""
    parts = urlsplit(location)
    if parts.scheme == "file":
        # Spark writes file:/path, which has no empty host as file:///path has.
        return fs.LocalFileSystem(), parts.path
    return fs.FileSystem.from_uri(location)


def put(spark: SparkSession, location: str, data: bytes) -> str:
    """Write a small file from the driver and return its qualified location."""
    location = qualified(spark, location)
    path = spark._jvm.org.apache.hadoop.fs.Path(location)
    stream = path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path, False)
    try:
        stream.write(bytearray(data))
    finally:
        stream.close()
    return location
