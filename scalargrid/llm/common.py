"""Reading, staging, keyed attachment and bitmaps of keys shared by the operators of this folder."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from scalargrid.runtime import stage

__all__ = [
    "attach", "bitmaps_of", "documents", "held_out", "keep_marked", "keep_rows", "maybe_among", "partitions", "stage", "table", "tested", "whole_row"
]

# A key with at least one row in HEAVY_SHARE is heavy; there are at most HEAVY_SHARE such keys.
HEAVY_SHARE = 2000
# Bits for each key of ``maybe_among``, and at most: 8 MB to broadcast. One key in 16 or fewer is a false hit up to 4 million keys.
KEY_BITS, MOST_BITS = 16, 1 << 26
_MAP_BITS = 32_768  # of one bitmap, as bitmap_construct_agg makes it


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def held_out(doc_id: str = "doc_id", folds: int = 5) -> Column:
    """True for the fold that is never learned from: crc32 of the id's text divisible by ``folds``."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds == 0, F.lit(False))


def attach(rows: DataFrame, groups: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Left join of ``rows`` with ``groups``, a staged table of one row per key with ``group_rows``.

    Groups that hold at least one row in ``HEAVY_SHARE`` go by broadcast: there cannot be more
    than ``HEAVY_SHARE`` of them. All other groups are small by this choice, so the shuffle by
    key is even. ``key`` may be NULL; such rows get NULLs.
    """
    total = groups.agg(F.sum("group_rows")).first()[0] or 0
    heavy = F.col("group_rows") * HEAVY_SHARE >= F.lit(total)
    side = [F.col(key), *(F.col(c) for c in columns)]
    hot = groups.where(heavy).select(*side, F.lit(True).alias("_hot"))
    cold = groups.where(~heavy).select(*side)
    first = rows.join(F.broadcast(hot), key, "left")
    settled = first.where(F.col("_hot") | F.col(key).isNull()).drop("_hot")
    # A NULL-free rest: what no heavy group has taken.
    rest = first.where(F.col("_hot").isNull() & F.col(key).isNotNull()).drop("_hot", *columns)
    return settled.unionByName(rest.join(cold, key, "left").select(*settled.columns))


def bitmaps_of(keys: DataFrame, key: Column, bits: int) -> DataFrame:
    """Bits at the hashes ``key`` of all rows, staged: at most ``bits`` / ``_MAP_BITS`` rows, however many keys there are."""
    bit = F.pmod(key, F.lit(bits))
    maps = keys.groupBy((bit / _MAP_BITS).cast("int").alias("_map")).agg(F.bitmap_construct_agg((bit % _MAP_BITS).cast("long")).alias("_bitmap"))
    return stage(maps, "bitmaps")


def tested(rows: DataFrame, key: Column, bitmaps: DataFrame, bits: int) -> DataFrame:
    """``rows`` with ``_maybe``: false only if the hash ``key`` is not among those of ``bitmaps_of``. Nothing is shuffled."""
    bit = F.pmod(key, F.lit(bits))
    placed = rows.select("*", (bit / _MAP_BITS).cast("int").alias("_map"), (bit % _MAP_BITS).cast("int").alias("_at"))
    byte = F.conv(F.hex(F.expr("substring(_bitmap, int(_at div 8) + 1, 1)")), 16, 10).cast("int")
    found = placed.join(F.broadcast(bitmaps), "_map", "left").withColumn("_byte", byte)
    maybe = F.coalesce(F.expr("shiftright(_byte, _at % 8)").bitwiseAND(F.lit(1)) == 1, F.lit(False))
    return found.select(*rows.columns, maybe.alias("_maybe"))


def maybe_among(rows: DataFrame, column: str, keys: DataFrame) -> DataFrame:
    """``rows`` with ``_maybe``: false only if ``column`` is not in ``keys``, a staged table of one column of its type.

    Rows that need no join with ``keys`` are told apart before it, so that their texts are not shuffled.
    False hits cost a shuffle and change nothing.
    """
    bits = min(MOST_BITS, max(_MAP_BITS, 1 << (KEY_BITS * keys.count()).bit_length()))
    return tested(rows, F.xxhash64(column), bitmaps_of(keys, F.xxhash64(keys.columns[0]), bits), bits)


def whole_row(docs: DataFrame) -> Column:
    """All columns of a row in one, so that names of other columns cannot clash with theirs."""
    return F.struct(*(F.col(f"`{c}`") for c in docs.columns))


def keep_rows(docs: DataFrame, mark: Column, decided: DataFrame) -> DataFrame:
    """``docs`` without rows that are not kept, all columns as they were; see ``keep_marked``."""
    return keep_marked(docs.select(whole_row(docs).alias("row"), F.col("doc_id").alias("key"), mark.alias("own")), decided)


def keep_marked(rows: DataFrame, decided: DataFrame) -> DataFrame:
    """What is in ``row`` of rows that are kept, and of one of rows that a kept decision repeats.

    ``rows`` has ``row``, its ``doc_id`` as ``key``, and its mark as ``own``. ``decided`` is staged, has
    a row per row of ``rows`` at most, and ``doc_id``, ``mark``, ``kept``. A decision holds for rows
    of its ``doc_id`` (NULL is equal to NULL) and ``mark``; rows without any, or without a mark, stay.
    """
    sides = [F.col("doc_id").alias("_id"), F.col("mark").alias("_mark")]
    dropped = stage(decided.where(~F.col("kept")).select(*sides).distinct(), "dropped")
    again = stage(decided.where("kept").groupBy(*sides).count().where("count > 1").drop("count"), "again")
    told = maybe_among(rows, "own", dropped.unionByName(again).select("_mark"))
    # Most rows have a mark of which nothing was decided but that it stays: only others, whole, meet the decisions.
    settled = told.where(~F.col("_maybe")).select("row.*")
    same = F.col("key").eqNullSafe(F.col("_id")) & (F.col("own") == F.col("_mark"))
    left = told.where("_maybe").select("row", "key", "own").join(dropped, same, "left_anti")
    if again.isEmpty():
        return settled.unionByName(left.select("row.*"))
    text = F.coalesce(F.col("row.text"), F.lit(""))
    order = Window.partitionBy("key", "own").orderBy(F.length(text).desc(), text)
    one = left.join(again, same, "left_semi").withColumn("_place", F.row_number().over(order)).where("_place = 1")
    return settled.unionByName(left.join(again, same, "left_anti").select("row.*")).unionByName(one.select("row.*"))
