"""Connected components of a link table, by alternating stars; every round is a stored table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import attach, stored


def _with_least(links: DataFrame) -> DataFrame:
    """Links (u, v) with the least of u and its neighbours v; a busy u is not gathered in one task."""
    links = stored(links)
    total = links.count()
    least = stored(links.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n")))
    return attach(links, least, "u", "n", total).select("u", "v", F.least("u", "m").alias("m"))


def _state(links: DataFrame):
    return tuple(links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b): root is the smallest node of its component.

    Links to oneself and repeated links do no harm.  No links give no rows.
    """
    loops = F.col("a") == F.col("b")
    links = stored(
        links.where(~loops).select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    )
    before = _state(links)
    for _ in range(rounds):
        if not before[0]:
            break
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _with_least(both).where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = _with_least(large.distinct())
        kept = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(small.select("u", F.col("m").alias("v")))
        links = stored(kept.where(F.col("u") != F.col("v")).distinct())
        after = _state(links)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    roots = links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return links.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
