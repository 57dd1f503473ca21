"""Connected components of a link table, by alternating contraction of stars."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.shared import written


def _minimum(links: DataFrame) -> DataFrame:
    """Each link (a, b) with m, the least node next to a. The minimum is formed before the shuffle,
    and the join has one row per node on one side, so adaptive execution can split a hot node."""
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    return links.join(least, "a")


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of the undirected links (a, b), root the least node of its component.

    Rounds of large and small stars until nothing changes, about log(diameter) of them; each round is
    written to the shared folder. Null ends and self-links are ignored; no links give no rows.
    """
    links = links.select("a", "b").filter("a <> b")
    links = written(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    state = None
    while True:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = _minimum(both).filter("b > a").select(F.col("b").alias("a"), F.least("a", "m").alias("b")).distinct()
        near = _minimum(large)
        small = near.filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        links = written(small.unionByName(near.select("a", F.col("m").alias("b"))).distinct(), "links")
        row = links.agg(F.count("*").alias("n"), F.expr("sum(cast(xxhash64(a, b) as decimal(38)))").alias("s")).first()
        if row == state:
            break
        state = row
    roots = links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
