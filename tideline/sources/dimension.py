"""Type-2 dimensions kept in stored tables."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tideline.operators.latest import Keys, latest_row
from tideline.operators.scd import VERSION_COLUMNS, is_open, scd2_apply, scd2_first
from tideline.sources.store import UNIT, StoredTable, replace_unit

OPEN = "open-"


class DimensionTable(StoredTable):
    """A dimension by natural key, with open versions and closed history in separate units.

    A snapshot reads and rewrites open versions only; versions it closes are appended to the history,
    which is never read for it.
    """

    def __init__(self, spark: SparkSession, root: str, key: Keys, buckets: int = 16):
        super().__init__(spark, root, key, buckets, F.when(is_open(), "open").otherwise("closed"))

    def read_open(self, state: dict | None = None) -> DataFrame | None:
        """The current version of every key."""
        state = state or self.state()
        return None if state is None else self.read([u for u in state["units"] if u.startswith(OPEN)], state)

    def _snapshot_rows(self, batch: DataFrame, updated_at: str, state: dict | None) -> DataFrame:
        """The batch, if it has the dimension's attributes and no null key: both would change it for good."""
        if state is not None:
            stored = {f.name: f.dataType for f in StructType.fromJson(state["schema"]) if f.name not in VERSION_COLUMNS}
            given = {f.name: f.dataType for f in batch.schema if f.name != updated_at}
            if given != stored:
                raise ValueError(f"{self.root} has the attributes {sorted(stored)}, not {sorted(given)}, or other types")
        return self._with_keys(batch)

    def snapshot(self, batch: DataFrame, updated_at: str, mark: tuple[str, int] | None = None) -> None:
        """Apply one snapshot of the source, or its changes since an earlier one.

        Rows that already are the open version are left out first, by a narrow join, so an unchanged
        source writes nothing. Null keys fail the write, and other attributes than the stored ones raise. `mark` is a (writer, number) pair kept with the commit, for the caller to find
        where it stopped.
        """
        state = self.state()
        batch = self._snapshot_rows(batch, updated_at, state)
        if state is None:
            first = scd2_first(latest_row(batch, self.key, updated_at), self.key, updated_at)
            self._write(self.placed(first), None, mark, replace_unit)
            return
        known = self.read_open(state).select(*self.key, F.col("valid_from").alias(updated_at))
        changed = batch.join(known, [*self.key, updated_at], "left_anti")
        staged = self.stage(changed, self.bucket())
        versions = self.read([OPEN + u for u in staged.units], state)
        rows = scd2_apply(versions, staged.rows.drop(UNIT), self.key, updated_at)
        self.merge(state, staged, self.placed(rows), mark, replace=lambda unit: unit.startswith(OPEN))
