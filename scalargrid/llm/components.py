"""Connected components of a link table, by alternating star rounds, each written and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scalargrid.llm.common import stage


def _mark(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first())


def _with_least(pairs: DataFrame) -> DataFrame:
    """Pairs ``(a, b)`` with the least of ``a`` and all its ``b``; the least is staged, so a hub's join can be split."""
    least = stage(pairs.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "least")
    return pairs.join(least, "a")


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``links`` (``a``, ``b``); ``root`` is the least node it can reach.

    Large stars link larger neighbours to the least one, small stars the smaller ones; the number of
    rounds grows as the logarithm of the longest chain. Rounds stop when nothing changes.
    """
    ordered = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    current = stage(ordered, "links")
    mark = _mark(current)
    while mark[0]:
        both = current.union(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = _with_least(both).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        small = _with_least(stage(large, "large"))
        moved = small.select(F.col("b").alias("a"), F.col("m").alias("b")).union(small.select("a", F.col("m").alias("b")))
        current = stage(moved.where("a <> b").distinct(), "links")
        before, mark = mark, _mark(current)
        if before == mark:
            break
    roots = current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return current.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)
