"""Incremental models: a stored table fed from a source by cursor, latest row per key."""

from datetime import datetime, timedelta

from pyspark.sql import DataFrame

from tideline.operators.incremental import newer_than, stamp
from tideline.operators.latest import Keys, as_list
from tideline.sources.store import StoredTable


def incremental_model(
    source: DataFrame,
    target: StoredTable,
    cursor: str,
    tiebreak: Keys | None = None,
    run_ts: datetime | None = None,
    lookback: timedelta | None = None,
    batch_id: tuple[str, int] | None = None,
) -> None:
    """Merge what is new in the source, by the high-water mark of the target's last commit.

    Stored rows never give way to older ones, so a lookback may read rows again. A run on an
    unchanged source merges nothing.
    """
    batch = newer_than(source, cursor, target.high_water(cursor), lookback)
    if run_ts is not None:
        batch = batch.withColumn("processed_at", stamp(run_ts))
    target.upsert(batch, [cursor, *as_list(tiebreak or [])], batch_id)


def layer_model(source: StoredTable, target: StoredTable, cursor: str, run_ts: datetime, lookback: timedelta | None = None) -> None:
    """`incremental_model` from one stored table to the next: only the units that the source wrote since the target
    last read it are read. The target's commit keeps the source's version it has seen."""
    state, seen = source.state(), (target.state() or {"batches": {}})["batches"].get("source", 0)
    if state is not None and state["version"] > seen:
        rows = source.changed(seen, state)
        incremental_model(rows, target, cursor, None, run_ts, lookback, ("source", state["version"]))
