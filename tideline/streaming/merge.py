"""Streams merged into stored tables, each micro-batch exactly once."""

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from tideline.operators.latest import Keys, as_list
from tideline.sources.store import StoredTable

ARRIVAL = "_arrived"


@dataclass(frozen=True)
class Sink:
    """A table a stream is merged into; with `insert_only` the first row of a key stays."""

    table: StoredTable
    order_by: Keys
    transform: Callable[[DataFrame], DataFrame] = lambda df: df
    insert_only: bool = False


def merge_stream(stream: DataFrame, sinks: Sequence[Sink], checkpoint: str) -> StreamingQuery:
    """Merge all files that have arrived into every sink, and stop.

    The checkpoint records which files were read. Each table records the last micro-batch it
    committed, so a batch that is retried after a failure is not applied twice. Late rows are kept:
    merging goes by key, and newer stored rows stay.
    """

    def apply(batch: DataFrame, number: int) -> None:
        # The query id belongs to the checkpoint, so a new checkpoint starts a new count of batches.
        query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        for sink in sinks:
            merge = sink.table.insert_if_absent if sink.insert_only else sink.table.upsert
            merge(sink.transform(batch), sink.order_by, batch_id=(query, number))

    writer = stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()


def run_to_end(query: StreamingQuery) -> None:
    """Wait for a query that stops by itself; raises its error if it failed."""
    query.awaitTermination()


def suppress_duplicates(stream: DataFrame, key: Keys, event_time: str, delay: str) -> DataFrame:
    """Drop repeats that arrive within `delay` of each other, before the merge.

    State is bounded by the delay. Rows that arrive later than the delay are dropped by the watermark,
    so use it only where the source bounds its lateness; the keyed merge alone is exact.
    """
    stamped = stream.withColumn(event_time, F.col(event_time).cast("timestamp"))
    return stamped.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(as_list(key))


def suppress_repeats(stream: DataFrame, key: Keys, delay: str) -> DataFrame:
    """Drop repeats delivered within `delay` of each other, whatever their event time; no row counts as late.

    The watermark follows the arrival of rows, which is the time of their micro-batch, so state holds the keys that
    arrived within the delay and nothing is dropped for being old. A repeat that arrives after its key was forgotten
    passes again; the keyed merge behind it (`Sink.insert_only`) is what drops it, so together they are exact. Rows with
    a null in the key are compared like any other; of different rows with one key the first to arrive passes.
    """
    keys = as_list(key)
    if ARRIVAL in stream.columns:
        raise ValueError(f"the stream has a column {ARRIVAL}, which is reserved")
    arrived = stream.withColumn(ARRIVAL, F.current_timestamp()).withWatermark(ARRIVAL, delay)
    return arrived.dropDuplicatesWithinWatermark(keys).drop(ARRIVAL)


def state_rows(query: StreamingQuery) -> list[int]:
    """Rows of state that each reported micro-batch left behind, over all stateful operators."""
    return [sum(op.numRowsTotal for op in progress.stateOperators) for progress in query.recentProgress]
