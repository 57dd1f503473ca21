"""Column functions shared by the operators."""

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the end of a version that is still open.
OPEN_END = "9999-12-31"


def open_end(kind: str = "timestamp_ntz") -> Column:
    return F.lit(OPEN_END).cast(kind)


def day_key(day: Column) -> Column:
    """Integer day key of the form yyyyMMdd, without a string round trip."""
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")


def literal(value, kind="timestamp_ntz") -> Column:
    """A value as a literal of a type. Times go through text: as Python objects they would shift with the driver's zone."""
    return F.lit(str(value) if isinstance(value, date) else value).cast(kind)


def version_id(keys: list[str], at: str) -> Column:
    """Surrogate id of a row version: a hash of its key and start.

    The parts of a composite key carry their lengths, and nulls are marked, so that different keys stay apart.
    """
    parts = [F.col(c).cast("string") for c in keys]
    if len(parts) > 1:
        parts = [F.coalesce(F.concat(F.length(p).cast("string"), F.lit(":"), p), F.lit("-")) for p in parts]
    return F.md5(F.concat_ws("|", *parts, F.col(at).cast("string")))


def full_name(first: str, last: str) -> Column:
    """Both parts with a blank between; null when either part is null."""
    return F.concat(F.col(first), F.lit(" "), F.col(last))
