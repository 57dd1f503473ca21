"""Checks that cost no scan of their own: counts taken while a table is written.

`DataFrame.observe` adds aggregates to a plan; their values arrive with the job that writes the rows. The counts
belong at the end of the plan, after the last shuffle, where a task that is run again counts once.
"""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

ROWS = "rows"


class Watch:
    """Row count and column rules of a table, counted by its write.

    `rows.transform(watch)` returns the rows with the counts attached; once they were written, `rows`, `broken` and
    `violations` tell what was counted, without a job. Conditions that are null count as kept, as in
    `quality.column_rules`, whose names the rules have. Counts of several writes through one watch are those of the
    last one.
    """

    def __init__(self, not_null: Sequence[str] = (), rules: Sequence[str] = ()):
        self.conditions: dict[str, Column] = {f"{c} is not null": F.col(c).isNull() for c in not_null}
        self.conditions |= {r: ~F.expr(r) for r in rules}
        self._observation: Observation | None = None

    def __call__(self, df: DataFrame) -> DataFrame:
        self._observation = Observation()
        counts = [F.count_if(bad).alias(f"r{i}") for i, bad in enumerate(self.conditions.values())]
        return df.observe(self._observation, F.count(F.lit(1)).alias(ROWS), *counts)

    def _counts(self) -> dict[str, int]:
        if self._observation is None:
            raise RuntimeError("no table was written through this watch")
        # A write without rows or tasks reports nothing: no rows, nothing broken.
        return self._observation.get or {}

    @property
    def rows(self) -> int:
        return self._counts().get(ROWS, 0)

    def broken(self) -> dict[str, int]:
        """Rows per rule that some rows break."""
        counts = self._counts()
        found = {rule: counts.get(f"r{i}", 0) for i, rule in enumerate(self.conditions)}
        return {rule: n for rule, n in found.items() if n}

    def violations(self, spark: SparkSession) -> DataFrame:
        """The broken rules as `quality.column_rules` gives them."""
        return spark.createDataFrame(list(self.broken().items()), "rule string, n_rows long")


def written_counts(watches: Mapping[str, Watch]) -> dict[str, int]:
    """Rows of each written table."""
    return {name: watch.rows for name, watch in watches.items()}
