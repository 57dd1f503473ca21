"""A table extracted by cursor, as a batch and a streaming source whose offsets are cursor values."""

from collections.abc import Iterator
from dataclasses import dataclass
from datetime import date, datetime, timedelta
from urllib.parse import urlsplit

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.dataset as ds
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition
from pyspark.sql.pandas.types import from_arrow_schema, to_arrow_schema
from pyspark.sql.types import StructType

Value = int | date | datetime
# Rows decoded at once, and bytes read ahead per column.
BATCH_ROWS, BUFFER = 32_768, 1 << 20


@dataclass(frozen=True)
class CursorRange(InputPartition):
    """Rows with `low` < cursor <= `high`; no lower bound where `low` is None."""

    low: str | None
    high: str


def shown(value: Value) -> str:
    return value.isoformat() if isinstance(value, date) else str(value)


def cut(low: Value, high: Value, parts: int) -> list[Value]:
    """At most `parts` ascending ends that divide (low, high] evenly; the last one is `high`."""
    if isinstance(low, datetime):
        span, unit = (high - low) // timedelta(microseconds=1), timedelta(microseconds=1)
    elif isinstance(low, date):
        span, unit = (high - low).days, timedelta(days=1)
    else:
        span, unit = high - low, 1
    steps = sorted({span * i // parts for i in range(1, parts)} - {0, span})
    return [low + unit * step for step in steps] + [high]


class CursorTable:
    """A parquet table seen through its cursor: highest value, ranges, and the rows of a range.

    The cursor is a column of whole numbers, dates or timestamps. Bounds come from file footers; a file whose footer
    has none for the cursor is read for that column alone.
    """

    def __init__(self, options: dict[str, str], schema: StructType | None = None):
        missing = [name for name in ("path", "cursor") if not options.get(name)]
        if missing:
            raise ValueError(f"the cursor source needs the options {missing}")
        self.path, self.cursor = options["path"], options["cursor"]
        self.slices, self.since = int(options.get("slices", 8)), options.get("since")
        if self.slices < 1:
            raise ValueError(f"slices must be positive, not {self.slices}")
        self.schema = schema

    def dataset(self) -> ds.Dataset:
        parts = urlsplit(self.path)
        # Spark writes file:/path for file:///path.
        system, path = (None, parts.path) if parts.scheme in ("", "file") else fs.FileSystem.from_uri(self.path)
        found = ds.dataset(path, format=ds.ParquetFileFormat(coerce_int96_timestamp_unit="us"), filesystem=system)
        if self.cursor not in found.schema.names:
            raise ValueError(f"no column {self.cursor!r} in {self.path}")
        return found

    def kind(self) -> pa.DataType:
        kind = self.dataset().schema.field(self.cursor).type
        if not (pa.types.is_integer(kind) or pa.types.is_date32(kind) or pa.types.is_timestamp(kind)):
            raise ValueError(f"a cursor must be a whole number, a date or a timestamp, not {kind}")
        # Nanoseconds are finer than a Spark timestamp, so offsets would not tell all values apart.
        return pa.timestamp("us", kind.tz) if pa.types.is_timestamp(kind) else kind

    def parse(self, text: str) -> Value:
        kind = self.kind()
        if pa.types.is_integer(kind):
            return int(text)
        return date.fromisoformat(text) if pa.types.is_date32(kind) else datetime.fromisoformat(text)

    def footer_bounds(self, fragment: ds.ParquetFileFragment) -> list[Value] | None:
        """Bounds of all row groups of a file; None if one has none."""
        try:
            groups = [(group.statistics or {}).get(self.cursor) for group in fragment.row_groups if group.num_rows]
        except pa.ArrowNotImplementedError:  # a column without ordered statistics, such as a 96-bit timestamp
            return None
        if any(found is None or found["min"] is None for found in groups):
            return None
        return [end for found in groups for end in (found["min"], found["max"])]

    def bounds(self) -> tuple[Value, Value] | None:
        """Lowest and highest cursor value; None for a table without any."""
        kind, ends = self.kind(), []
        for fragment in self.dataset().get_fragments():
            found = self.footer_bounds(fragment)
            if found is not None:
                ends += found
                continue
            for batch in fragment.to_batches(columns=[self.cursor]):
                both = pc.min_max(batch.column(0))
                ends += [both["min"].as_py(), both["max"].as_py()] if both["min"].is_valid else []
        # The type of the offsets: file statistics may come in the file's own unit.
        values = [pa.scalar(end, type=kind).as_py() for end in ends]
        return (min(values), max(values)) if values else None

    def ranges(self, low: str | None, high: str) -> list[CursorRange]:
        """(low, high] in at most `slices` ranges; an open start reaches down to the lowest value."""
        last = self.parse(high)
        if low is None:
            bounds = self.bounds()
            if bounds is None:
                return []
            first = min(bounds[0], last)
        else:
            first = self.parse(low)
            if first >= last:
                return []
        starts = [low]
        ranges = []
        for end in cut(first, last, self.slices):
            ranges.append(CursorRange(starts[-1], shown(end)))
            starts.append(shown(end))
        return ranges

    def rows(self, part: CursorRange) -> Iterator[pa.RecordBatch]:
        """Rows of a range, with the columns of the schema; files and row groups outside it are not read.

        A row group is decoded a batch at a time, from a buffer per column, so memory does not grow with the size of files
        or row groups. A data set's scanner would decode whole row groups, and several ahead.
        """
        kind, field, whole = self.kind(), ds.field(self.cursor), self.dataset()
        high = pa.scalar(self.parse(part.high), type=kind)
        low = None if part.low is None else pa.scalar(self.parse(part.low), type=kind)
        wanted = field <= high if low is None else (field <= high) & (field > low)
        target = to_arrow_schema(self.schema)
        for fragment in whole.get_fragments():
            groups = [group.id for group in fragment.subset(filter=wanted, schema=whole.schema).row_groups]
            if not groups:
                continue
            with fragment.open() as opened:
                file = pq.ParquetFile(opened, buffer_size=BUFFER, pre_buffer=False, coerce_int96_timestamp_unit="us")
                names = [n for n in dict.fromkeys([*target.names, self.cursor]) if n in file.schema_arrow.names]
                if self.cursor not in names:
                    continue
                for batch in file.iter_batches(BATCH_ROWS, row_groups=groups, columns=names, use_threads=False):
                    at = batch.column(self.cursor)
                    inside = pc.less_equal(at, high)
                    batch = batch.filter(inside if low is None else pc.and_(inside, pc.greater(at, low)))
                    if batch.num_rows:
                        columns = [batch.column(n) if n in names else pa.nulls(batch.num_rows, whole.schema.field(n).type) for n in target.names]
                        yield pa.RecordBatch.from_arrays(columns, target.names).cast(target)


class CursorBatch(DataSourceReader):
    """All rows above `since`, or all with a cursor value."""

    def __init__(self, table: CursorTable):
        self.table = table

    def partitions(self) -> list[CursorRange]:
        try:
            bounds = self.table.bounds()
            return [] if bounds is None else self.table.ranges(self.table.since, shown(bounds[1]))
        except NotImplementedError as error:  # which Spark takes for a source that cannot be split
            raise RuntimeError(f"cannot read the cursor of {self.table.path}") from error

    def read(self, partition: CursorRange | None) -> Iterator[pa.RecordBatch]:
        # An empty list of ranges arrives as one task without a range.
        return iter(()) if partition is None else self.table.rows(partition)


class CursorStream(DataSourceStreamReader):
    """Rows above the last offset, up to the highest value there is when a micro-batch starts.

    An offset is the cursor value up to which rows were taken, so a retried micro-batch reads the same range again.
    """

    def __init__(self, table: CursorTable):
        self.table = table

    def initialOffset(self) -> dict:
        return {"cursor": self.table.since}

    def latestOffset(self) -> dict:
        bounds = self.table.bounds()
        return {"cursor": self.table.since if bounds is None else shown(bounds[1])}

    def partitions(self, start: dict, end: dict) -> list[CursorRange]:
        return [] if end["cursor"] is None else self.table.ranges(start["cursor"], end["cursor"])

    def read(self, partition: CursorRange) -> Iterator[pa.RecordBatch]:
        return self.table.rows(partition)

    def commit(self, end: dict) -> None:
        """Nothing to release: the checkpoint holds the offset."""


class CursorSource(DataSource):
    """`spark.read` or `spark.readStream.format("cursor")` with options `path`, `cursor`, `since` and `slices`.

    Rows are those with a cursor value strictly above `since`; rows with a null cursor are not part of an extract. A
    cursor must not pass a value before all its rows are visible: rows that appear later at or below the offset are not
    seen, as with any cursor extract. Partitions are even ranges of the cursor, read in the tasks, which skip files and
    row groups outside their range. The driver reads only footers, so it suits sources of some ten thousand files. Every
    executor must reach `path`.
    """

    @classmethod
    def name(cls) -> str:
        return "cursor"

    def schema(self) -> StructType:
        return from_arrow_schema(CursorTable(self.options).dataset().schema, prefer_timestamp_ntz=True)

    def reader(self, schema: StructType) -> CursorBatch:
        return CursorBatch(CursorTable(self.options, schema))

    def streamReader(self, schema: StructType) -> CursorStream:
        return CursorStream(CursorTable(self.options, schema))


def cursor_stream(spark: SparkSession, path: str, cursor: str, slices: int = 8, since: Value | None = None) -> DataFrame:
    """Rows of a parquet table as a stream that goes on where its checkpoint's cursor stands."""
    spark.dataSource.register(CursorSource)
    options = {"path": path, "cursor": cursor, "slices": str(slices)}
    return spark.readStream.format(CursorSource.name()).options(**options, **({} if since is None else {"since": shown(since)})).load()
