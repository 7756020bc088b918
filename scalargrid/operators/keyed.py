"""Attach a decision per key to many rows, whatever share of them one key holds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A key with at least one row in HEAVY_SHARE is heavy; there are at most HEAVY_SHARE such keys.
HEAVY_SHARE = 2000
# Rows of a key, as counted with its decision.
KEY_ROWS = "_key_rows"


def fits_broadcast(df: DataFrame) -> bool:
    """Whether Spark broadcasts a stored table by its known size."""
    limit = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return limit > 0 and int(str(size)) <= limit


def attach(rows: DataFrame, decided: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Inner join of ``rows`` with ``decided``, a stored table of one row per key with ``KEY_ROWS``.

    A table that Spark can broadcast by its size is joined as it is. Otherwise heavy keys go by broadcast,
    which is bounded by their definition, and their rows stay where they are; the rows of all other keys
    are few per key, so their shuffle is even. ``rows`` are then read twice and should be stored.
    """
    keys, side = list(keys), decided.select(*keys, *columns)
    if fits_broadcast(decided):
        return rows.join(side, keys).select(*rows.columns, *columns)
    total = decided.agg(F.sum(KEY_ROWS)).first()[0] or 0
    heavy = F.col(KEY_ROWS) * HEAVY_SHARE >= F.lit(total)
    hot, cold = decided.where(heavy).select(*keys, *columns), decided.where(~heavy).select(*keys, *columns)
    settled = rows.join(F.broadcast(hot), keys)
    rest = rows.join(F.broadcast(hot.select(*keys)), keys, "left_anti").join(cold, keys)
    names = [*rows.columns, *columns]
    return settled.select(*names).unionByName(rest.select(*names))
