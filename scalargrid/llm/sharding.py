"""Operator 9: consistent hashing with bounded loads.

Every shard owns ``VIRTUAL_NODES`` points of a ring. A document belongs to the first point
clockwise from its own hash. A shard takes no more rows than its capacity; documents that find
it full go on clockwise to the next point, until one with room. Capacities are exact shares of
the row count (the first ``n mod shards`` shards take one more), so the law is ``rows``:
counts differ by one at most.

Who overflows is decided by counts, not by looking at documents one after the other: an arc
(the stretch before a point) holds its documents in hash order; its shard takes the first of
them, the rest of the arc goes on. Arcs are offered round by round: in round 0 to their own
point, in round r to the r-th next. Counts per arc are one small aggregate of at most
``shards * VIRTUAL_NODES`` rows, and so the plan is made on them alone. Where a document lands
follows from its rank within its arc; ranks come from short pieces of the ring (``CELLS`` even
cells, cut at the points), with counts summed along the arc, so that no task sees a whole arc.
Rows that repeat one ``doc_id`` share a place of the ring. Where they are far more than a piece
has on average, the piece is cut before and behind that place, and its rows are dealt evenly into
parts, which follow one another; there can be no more such places than a quarter of the pieces.

Defined results: NULL texts have size 1 and crc32 0; a NULL ``doc_id`` has a hash like any
other; rows that repeat a ``doc_id`` lie side by side on the ring, those of a crowded place in no
fixed order, and each take a slot; an empty
table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections import defaultdict

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from scalargrid.llm.common import documents, stage

SHARDS = 16
VIRTUAL_NODES = 64
RING_BITS = 60
CELL_BITS = 13
CELLS = 1 << CELL_BITS
CROWD = 50_000  # a piece with fewer rows is never cut


def ring(shards: int, virtual_nodes: int = VIRTUAL_NODES) -> list[tuple[int, int]]:
    """Points in order, each with its shard. More shards add points and move none."""
    return sorted(
        (int.from_bytes(hashlib.sha256(f"{s}/{v}".encode()).digest()[:8], "big") >> (64 - RING_BITS), s)
        for s in range(shards) for v in range(virtual_nodes)
    )


def capacities(rows: int, shards: int) -> list[int]:
    return [rows // shards + (s < rows % shards) for s in range(shards)]


def plan(counts: list[int], owners: list[int], room: list[int]) -> list[tuple[int, int, int, int, int]]:
    """``(arc, first, end, shard, slot)``: ranks of an arc that go to a shard, and the slot of the first.

    ``counts`` and ``owners`` are per arc in ring order; ``room`` is the capacity of each shard.
    """
    n, left, taken = len(counts), list(counts), [0] * len(room)
    found = []
    waiting = [a for a in range(n) if left[a]]
    for step in range(n):
        for arc in waiting:
            shard = owners[(arc + step) % n]
            part = min(left[arc], room[shard] - taken[shard])
            if part > 0:
                first = counts[arc] - left[arc]
                found.append((arc, first, first + part, shard, taken[shard]))
                taken[shard] += part
                left[arc] -= part
        waiting = [a for a in waiting if left[a]]
        if not waiting:
            break
    return found


def stretches(points: list[tuple[int, int]], cells: int = CELLS) -> list[tuple[int, int, int, int, int]]:
    """``(cell, piece, low, high, arc)``: the ring cut at every point and at even cells, clockwise from 0.

    A document hashed to ``low..high`` (both included) belongs to that piece. What lies past the
    last point belongs to the first one's arc.
    """
    width = (1 << RING_BITS) // cells
    cuts = sorted({*(c * width for c in range(cells)), *(p + 1 for p, _ in points if p + 1 < 1 << RING_BITS)})
    ends = [p for p, _ in points]
    found = []
    for piece, (low, high) in enumerate(zip(cuts, [*cuts[1:], 1 << RING_BITS], strict=True)):
        found.append((low // width, piece, low, high - 1, bisect_left(ends, low) % len(points)))
    return found


def uncrowded(rows: DataFrame, sizes: dict[int, int], pieces: int, crowd: int = CROWD) -> DataFrame:
    """``rows`` with ``level`` and ``part``, which follow the ring within a piece and cut crowded places.

    ``rows`` is staged and has ``piece``, ``place`` and ``salt``, a number of its own for each row.
    """
    most = max(crowd, 4 * sum(sizes.values()) // pieces)
    full = [(p,) for p, n in sizes.items() if n > most]  # fewer than a quarter of the pieces
    if not full:
        return rows.withColumns({"level": F.lit(0), "part": F.lit(0)})
    spark = rows.sparkSession
    seen = rows.join(F.broadcast(spark.createDataFrame(full, "piece int")), "piece").groupBy("piece", "place").agg(F.count("*").alias("n"))
    cuts = seen.where(F.col("n") > most).groupBy("piece").agg(
        F.collect_list(F.struct("place", F.ceil(F.col("n") / most).cast("int").alias("parts"))).alias("cuts")
    )
    cut = rows.join(F.broadcast(stage(cuts, "crowded")), "piece", "left")
    below = F.size(F.filter("cuts", lambda c: c["place"] < F.col("place")))
    own = F.get(F.filter("cuts", lambda c: c["place"] == F.col("place")), 0)["parts"]
    return cut.withColumns({
        "level": F.when(F.col("cuts").isNull(), 0).otherwise(2 * below + F.when(own.isNull(), 0).otherwise(1)),
        "part": F.when(own.isNull(), 0).otherwise(F.pmod(F.xxhash64("salt"), own)).cast("int"),
    }).drop("cuts")


def assign(docs: DataFrame, shards: int = SHARDS, virtual_nodes: int = VIRTUAL_NODES, crowd: int = CROWD) -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot`` of every row."""
    spark = docs.sparkSession
    points = ring(shards, virtual_nodes)
    pieces = stretches(points)
    known = spark.createDataFrame(pieces, "cell int, piece int, low long, high long, arc int")
    raw = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    place = F.shiftrightunsigned(F.xxhash64(F.col("doc_id").cast("string"), F.lit("ring")), 64 - RING_BITS)
    sized = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(raw) + 1).cast("long").alias("size"),
        F.crc32(raw).cast("long").alias("text_crc32"), place.alias("place"),
    ).withColumn("cell", F.shiftright("place", RING_BITS - CELL_BITS).cast("int"))
    within = (F.col("place") >= F.col("low")) & (F.col("place") <= F.col("high"))
    placed = sized.join(F.broadcast(known.withColumnRenamed("cell", "_cell")), (F.col("cell") == F.col("_cell")) & within)
    salted = placed.select("doc_id", "size", "text_crc32", "place", "piece", F.monotonically_increasing_id().alias("salt"))
    staged = stage(salted, "ring")
    # As many as there are pieces at most; with crowded places cut, less than three times as many.
    cut = uncrowded(staged, dict(map(tuple, staged.groupBy("piece").count().collect())), len(pieces), crowd)
    sizes = defaultdict(list)
    for piece, level, part, n in sorted(map(tuple, cut.groupBy("piece", "level", "part").count().collect())):
        sizes[piece].append((level, part, n))
    # An arc is passed clockwise: the stretch past the last point comes before the start of the ring.
    wrapped = [p for p in pieces if p[4] == 0 and p[2] > points[-1][0]]
    counts, before = [0] * len(points), []
    for _, piece, _, _, arc in [*wrapped, *(p for p in pieces if p not in set(wrapped))]:
        for level, part, n in sizes[piece]:
            before.append((piece, level, part, arc, counts[arc]))
            counts[arc] += n
    segments = plan(counts, [s for _, s in points], capacities(sum(counts), shards))
    starts = spark.createDataFrame(before, "piece int, level int, part int, arc int, before long")
    parts = spark.createDataFrame(segments, "_arc int, first long, end long, shard int, base long")
    run = ["piece", "level", "part"]
    order = Window.partitionBy(*run).orderBy("place", "doc_id", "text_crc32", "size", "salt")
    ranked = cut.withColumn("_place", F.row_number().over(order)).join(F.broadcast(starts), run)
    ranked = ranked.withColumn("rank", F.col("before") + F.col("_place") - 1)
    taken = (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("end"))
    return ranked.join(F.broadcast(parts), (F.col("arc") == F.col("_arc")) & taken).select(
        "doc_id", "size", "text_crc32", "shard", (F.col("base") + F.col("rank") - F.col("first")).alias("slot")
    )


def op9_hash_ring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign(documents(spark, sf_dir)).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
