"""Operator 7: temperature mixing of sources to target weights.

A source's weight is its share of all tokens to the power of an exponent, normalised: 1 keeps the
shares, 0 gives every source the same weight. The exponent is bisected to meet a target: a given
entropy of the weights (as a part of the highest possible), or a limit on how often the text of a
source may be repeated when every source is used at least once (the flattest mixture within it).

Weights become budgets: the source that the mixture favours least is used exactly once, and the
others in proportion to their weights, so nothing is dropped and no source is repeated more often
than the limit allows. A budget is realised by block permutations: a source's documents are dealt
into blocks by a hash of their id; each pass over the source takes whole blocks in an order of
that pass's own hash, until the budget ends within a block, which then gives its first documents
by hash. ``mix_order`` spreads every source evenly over the whole stream.

The plan is a row per source, pass and block, and says up to which hash documents of the block are
taken. So documents meet it by an equality on source and block, and no text is shuffled or sorted.
Sums are taken per source and block: a source with a third of all rows is dealt over ``blocks``
groups, and only block sums are ordered per source. In a block that is cut, sums of parts tell in
which part the budget ends, and only that one, a millionth of the source, is ordered by document.

Defined results: NULL texts have no tokens, and no budget is spent on them; they are in the first
pass like any other; a NULL source is a source of its own; rows that repeat a ``doc_id`` are taken
together; a table without tokens gives all rows once; an empty table gives no rows; other columns,
whatever their names, are kept by ``mixed``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from scalargrid.llm.common import documents, stage

MAX_REPEATS = 1.5
BLOCKS = 256
PART_BITS = 12  # a block in which a budget ends is summed in 4,096 parts first
SENT_ROWS = 200_000  # of a plan that is broadcast, about 60 bytes each


def tokens(text: Column) -> Column:
    """Number of words between white space."""
    plain = F.trim(F.coalesce(text.cast("string"), F.lit("")), F.lit(" \t\n\x0b\x0c\r"))
    return F.when(plain == "", 0).otherwise(F.size(F.split(plain, r"[\x20\x09-\x0D]+"))).cast("long")


def weights(sizes: dict, exponent: float) -> dict:
    """Normalised powers of the shares; sources without tokens have weight 0."""
    total = sum(sizes.values())
    powers = {s: (n / total) ** exponent if n else 0.0 for s, n in sizes.items()} if total else dict.fromkeys(sizes, 0.0)
    norm = sum(powers.values()) or 1.0
    return {s: p / norm for s, p in powers.items()}


def repeats(sizes: dict, exponent: float) -> dict:
    """How often each source is used if the one used least is used once."""
    ratio = {s: w / sizes[s] for s, w in weights(sizes, exponent).items() if sizes[s]}
    least = min(ratio.values(), default=1.0)
    return {s: ratio[s] / least if s in ratio else 1.0 for s in sizes}


def entropy(sizes: dict, exponent: float) -> float:
    """Entropy of the weights as a part of the highest possible one."""
    used = [w for w in weights(sizes, exponent).values() if w > 0]
    return -sum(w * math.log(w) for w in used) / math.log(len(used)) if len(used) > 1 else 1.0


def bisected(sizes: dict, max_repeats: float | None = None, target_entropy: float | None = None, steps: int = 60) -> float:
    """The exponent in 0..1: repeats and entropy both fall as it rises."""
    if (max_repeats is None) == (target_entropy is None):
        raise ValueError("give either max_repeats or target_entropy")

    def too_flat(exponent: float) -> bool:
        if max_repeats is not None:
            return max(repeats(sizes, exponent).values(), default=1.0) > max_repeats
        return entropy(sizes, exponent) > target_entropy

    low, high = 0.0, 1.0
    if not too_flat(low):
        return low
    for _ in range(steps):
        middle = (low + high) / 2
        low, high = (middle, high) if too_flat(middle) else (low, middle)
    return high


def _source(source: Column) -> Column:
    """Key of a source; NULL is one of its own."""
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit("-"))


def _block(doc_id: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(doc_id.cast("string"), F.lit("block")), F.lit(blocks)).cast("int")


def _turn(doc_id: Column, copy: Column) -> Column:
    """Place of a document within its block in a pass."""
    return F.xxhash64(doc_id.cast("string"), copy, F.lit("turn"))


def mixture(docs: DataFrame, max_repeats: float | None = MAX_REPEATS, target_entropy: float | None = None, blocks: int = BLOCKS) -> DataFrame:
    """The plan: ``source_key, block, copy, weight, rank, last, times``, a row per block that a pass takes.

    Documents of the block belong to the pass if their turn is not after ``last``. Sums per source
    come to the driver: a source is a data set, not a document.
    """
    spark = docs.sparkSession
    rows = stage(
        docs.select(
            _source(F.col("source")).alias("source_key"), F.col("doc_id").cast("string").alias("id"),
            tokens(F.col("text")).alias("tokens"), _block(F.col("doc_id"), blocks).alias("block"),
        ), "mix-rows",
    )
    sums = stage(rows.groupBy("source_key", "block").agg(F.sum("tokens").alias("tokens")), "mix-blocks")
    sizes = dict(map(tuple, sums.groupBy("source_key").agg(F.sum("tokens")).orderBy("source_key").collect()))
    exponent = bisected(sizes, max_repeats, target_entropy)
    weight, times = weights(sizes, exponent), repeats(sizes, exponent)
    turns = []
    for source, n in sizes.items():
        for copy in range(max(1, math.ceil(times[source] - 1e-9))):
            part = min(1.0, times[source] - copy)
            turns.append((source, weight[source], float(times[source]), copy, part > 1 - 1e-9, n * part))
    passes = spark.createDataFrame(turns, "source_key string, weight double, times double, copy int, full boolean, budget double")
    order = Window.partitionBy("source_key", "copy").orderBy(F.xxhash64("block", "copy"), "block")
    upto = sums.join(passes, "source_key").withColumn("upto", F.sum("tokens").over(order.rowsBetween(Window.unboundedPreceding, 0))).withColumn(
        "rank", F.row_number().over(order)
    )
    before = F.col("upto") - F.col("tokens")
    used = stage(
        upto.where(F.col("full") | (before < F.col("budget"))).select(
            "source_key", "block", "copy", "weight", "times", "rank", (F.col("budget") - before).alias("room"),
            (F.col("full") | (F.col("upto") <= F.col("budget"))).alias("whole"),
        ), "mix-used",
    )
    # One block per source and pass is cut at most: its first documents in turn, as far as the budget goes.
    cut = rows.join(used.where(~F.col("whole")), ["source_key", "block"]).withColumn("turn", _turn(F.col("id"), F.col("copy")))
    one = ["source_key", "copy"]
    turns = stage(
        cut.groupBy(*one, "turn").agg(F.sum("tokens").alias("tokens"), F.max("room").alias("room")).withColumn(
            "part", F.shiftright("turn", 64 - PART_BITS)
        ), "mix-turns",
    )
    # First the part of the block in which the budget ends, by sums, then the place in it.
    until = Window.partitionBy(*one).orderBy("part").rowsBetween(Window.unboundedPreceding, 0)
    parts = turns.groupBy(*one, "part").agg(F.sum("tokens").alias("tokens"), F.max("room").alias("room")).withColumn(
        "passed", F.sum("tokens").over(until) - F.col("tokens")
    ).where("passed < room")
    ends = parts.groupBy(*one).agg(F.max("part").alias("part"), F.max("passed").alias("passed"))
    within = Window.partitionBy(*one).orderBy("turn").rowsBetween(Window.unboundedPreceding, 0)
    last = turns.join(ends, [*one, "part"]).withColumn("upto", F.col("passed") + F.sum("tokens").over(within)).where(
        F.col("upto") - F.col("tokens") < F.col("room")
    ).groupBy(*one).agg(F.max("turn").alias("last"))
    plan = used.join(last, ["source_key", "copy"], "left").select(
        "source_key", "block", "copy", "weight", "rank", "times", F.when(F.col("whole"), F.lit(2**63 - 1)).otherwise(F.col("last")).alias("last")
    )
    return stage(plan, "mixture")


def _placed(docs: DataFrame, plan: DataFrame, kept: Column, blocks: int) -> DataFrame:
    """``kept`` and the plan's columns, a row per use of a document; texts move only if the plan is too long to send around."""
    rows = docs.select(kept.alias("kept"), F.col("doc_id").alias("id"), _source(F.col("source")).alias("source_key"), _block(F.col("doc_id"), blocks).alias("block"))
    sent = F.broadcast(plan) if plan.count() <= SENT_ROWS else plan
    return rows.join(sent, ["source_key", "block"]).where(_turn(F.col("id"), F.col("copy")) <= F.col("last"))


def mixed(docs: DataFrame, max_repeats: float | None = MAX_REPEATS, target_entropy: float | None = None, blocks: int = BLOCKS) -> DataFrame:
    """``docs``, each row as often as the mixture uses it, all columns as they were."""
    plan = mixture(docs, max_repeats, target_entropy, blocks)
    return _placed(docs, plan, F.struct(*(F.col(f"`{c}`") for c in docs.columns)), blocks).select("kept.*")


def draws(docs: DataFrame, max_repeats: float | None = MAX_REPEATS, target_entropy: float | None = None, blocks: int = BLOCKS) -> DataFrame:
    """``doc_id, source, copy, weight, block, mix_order`` of every use of a document; sources are spread evenly over ``mix_order``."""
    plan = mixture(docs, max_repeats, target_entropy, blocks)
    used = _placed(docs, plan, F.struct("doc_id", "source"), blocks)
    share = F.pmod(F.xxhash64(F.col("id").cast("string"), F.col("copy"), F.lit("place")), F.lit(1 << 30)) / float(1 << 30)
    place = (F.col("copy") + (F.col("rank") - 1 + share) / blocks) / F.col("times")
    return used.select("kept.doc_id", "kept.source", "copy", "weight", "block", place.alias("mix_order"))


def op7_temperature_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return draws(documents(spark, sf_dir))
