"""Operator 2: bottom-k sketches of shingle hashes as document fingerprints.

A text's words (between white space, lower-cased) are hashed; every word ends one shingle of
``WORDS`` words, whose hash is that of the words' hashes. The first shingles of a text have fewer
words, so that texts shorter than a shingle have fingerprints that can be compared as well. The
sketch is the ``SKETCH`` smallest distinct hashes, ascending. Sketches of parts merge to that of
the whole. From sketches alone follow:

* resemblance: of the smallest ``SKETCH`` hashes of both together, the share that both have;
* distinct shingles: exact below ``SKETCH``, else by how small the largest kept hash is;
* containment: the part of one text's shingles that the other has, from the two above.

Everything is one expression per row. The next document in order of ``doc_id`` comes from a
window over ranges of ``doc_id``, whose bounds are values of the column: the document at a bound
is also sent to the range before it, so that the last one there meets it without a second shuffle. A
``doc_id`` that fills ranges (NULL, say) is cut by the hash of its texts. A text that fills ranges there
takes part once: all its other rows have an equal row next, and are made from their count.

Defined results: NULL texts are empty; an empty text has an empty fingerprint; two empty
fingerprints have resemblance 1, an empty and another 0; a NULL ``doc_id`` sorts first, rows that
repeat a ``doc_id`` by text (by its hash where the id fills ranges); the only row of a table is its own next document; an empty table
gives no rows; other columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from scalargrid.llm.common import documents, partitions, stage

WORDS = 5
SKETCH = 64
_SPACE = " \t\n\x0b\x0c\r"
_LEAST = -(2**63)
_EXACT = 53  # bits of a whole number that percentile_approx, which counts in doubles, gives back as they were


def word_hashes(text: Column) -> Column:
    plain = F.trim(F.lower(F.coalesce(text, F.lit(""))), F.lit(_SPACE))
    words = F.split(plain, r"[\x20\x09-\x0D]+")
    return F.when(plain == "", F.array().cast("array<bigint>")).otherwise(F.transform(words, lambda w: F.xxhash64(w)))


def shingles(hashes: Column, words: int = WORDS) -> Column:
    """Hashes of all shingles; ``hashes`` must be a plain column, as every element looks back at it."""
    return F.transform(hashes, lambda h, i: F.xxhash64(*(F.get(hashes, i - k) for k in range(words - 1, 0, -1)), h))


def bottom(values: Column, size: int = SKETCH) -> Column:
    return F.slice(F.sort_array(F.array_distinct(values)), 1, size)


def merge(a: Column, b: Column, size: int = SKETCH) -> Column:
    """Sketch of two parts together."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, size)


def resemblance(a: Column, b: Column, size: int = SKETCH) -> Column:
    both = merge(a, b, size)
    shared = F.size(F.array_intersect(F.array_intersect(both, a), b))
    return F.when(F.size(both) == 0, F.lit(1.0)).otherwise(shared / F.size(both))


def distinct_shingles(a: Column, size: int = SKETCH) -> Column:
    """Estimate of how many different shingles the sketched text has."""
    place = (F.element_at(a, -1).cast("double") + 2.0**63) / 2.0**64
    return F.when(F.size(a) < size, F.size(a).cast("double")).otherwise((size - 1) / place)


def containment(a: Column, b: Column, size: int = SKETCH) -> Column:
    """Estimate of the part of ``a``'s shingles that ``b`` has; 1 for an empty ``a``."""
    union = distinct_shingles(merge(a, b, size), size)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(
        F.least(F.lit(1.0), resemblance(a, b, size) * union / distinct_shingles(a, size))
    )


def sketched(rows: DataFrame, text: str, name: str, words: int = WORDS, size: int = SKETCH) -> DataFrame:
    """``rows`` with the sketch of a text column."""
    hashed = rows.withColumn("_hashes", word_hashes(F.col(text)))
    return hashed.withColumn("_shingles", shingles(F.col("_hashes"), words)).withColumn(
        name, bottom(F.col("_shingles"), size)
    ).drop("_hashes", "_shingles")


def _range_of(key: Column, bounds: list[int]) -> Column:
    """Number of the last bound not above ``key``: first among every ``step``-th bound, then within."""
    step = max(1, math.isqrt(len(bounds)))
    all_bounds, some = (F.lit(x).cast("array<bigint>") for x in (bounds, bounds[::step]))
    upto = F.size(F.filter(some, lambda b: b <= key))
    part = F.slice(all_bounds, (upto - 1) * step + 1, step)
    return (upto - 1) * step + F.size(F.filter(part, lambda b: b <= key)) - 1


def _hash_cuts(rows: DataFrame, full: dict[int, int]) -> dict[int, list[int]]:
    """For each given ``key``: its least ``hash``, and those that cut its rows into so many parts."""
    most = max(full.values())
    wanted = F.broadcast(rows.sparkSession.createDataFrame(list(full.items()), "key long, parts int"))
    found = rows.join(wanted, "key").groupBy("key", "parts").agg(
        F.min("hash").alias("least"), F.percentile_approx("hash", [i / most for i in range(1, most)], 10_000).alias("cuts")
    )
    own = F.transform(F.sequence(F.lit(1), F.col("parts") - 1), lambda i: F.get("cuts", F.floor(i * most / F.col("parts")).cast("int") - 1))
    return {r["key"]: r["cut"] for r in found.select("key", F.concat(F.array("least"), own).alias("cut")).collect()}


def _crowded(rows: DataFrame, full: dict[int, int]) -> tuple[DataFrame, dict[int, list[int]], DataFrame | None]:
    """``rows`` with ``hash``, bounds of it for each key that fills ranges, and the texts that fill ranges there.

    Of such a text one row stays in ``rows``; the others are ``more`` in the last table. There are no
    more keys, bounds and texts than ranges.
    """
    spark = rows.sparkSession
    hashed = F.shiftright(F.xxhash64("text"), 64 - _EXACT)
    rows = rows.withColumn("hash", F.when(F.col("key").isin(list(full)), hashed).otherwise(F.lit(_LEAST)))
    cuts = _hash_cuts(rows, full)
    same = [(k, h) for k, cut in cuts.items() for h, times in Counter(cut).items() if times > 1]
    starts = {k: sorted(set(cut)) for k, cut in cuts.items()}
    if not same:
        return rows, starts, None
    shared = F.broadcast(spark.createDataFrame(same, "key long, hash long"))
    once = stage(
        rows.join(shared, ["key", "hash"]).groupBy("doc_id", "text", "key", "hash").agg((F.count("*") - 1).alias("more")), "shared"
    )
    rest = rows.join(shared, ["key", "hash"], "left_anti").select("doc_id", "text", "key", "hash")
    return rest.unionByName(once.drop("more")), starts, once.where("more > 0").select("doc_id", "text", "more")


def with_next(docs: DataFrame, ranges: int | None = None) -> tuple[DataFrame, object, DataFrame | None]:
    """Rows by ranges, the window by which they follow each other there, and rows left out.

    The first has ``doc_id, text, guest, bucket`` and more; guests only follow. Rows left out are given as
    ``doc_id, text, more``: that many rows whose next document has the same text.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(_LEAST)).alias("key"),
    )
    n = ranges or 2 * partitions(spark)
    # As many values as there are ranges at most.
    found = rows.agg(F.min("key"), F.percentile_approx("key", [i / n for i in range(1, n)], 10_000)).first() if n > 1 else rows.agg(F.min("key"), F.array()).first()
    values = [] if found[0] is None else [found[0], *(found[1] or [])]
    times = Counter(values)
    bounds = sorted(times) or [_LEAST]
    if any(abs(v) >> _EXACT for v in values[1:]):
        # Not the values of any row, perhaps: a range starts with the least one in it.
        least = dict(map(tuple, rows.groupBy(_range_of(F.col("key"), bounds).alias("at")).agg(F.min("key")).collect()))
        times = Counter({key: times[bounds[at]] for at, key in least.items() if at >= 0})
        bounds = sorted(times)
    full = {k: n for k, n in times.items() if n > 1}
    rows, starts, left_out = _crowded(rows, full) if full else (rows.withColumn("hash", F.lit(_LEAST)), {}, None)
    # Range ``at`` starts with its bound; if that id fills ranges, part 0 of it to the last one do, and what follows is in the last.
    ends = [len(starts.get(b, [0])) - 1 for b in bounds]
    width = max(ends) + 1
    bound, end = (lambda at, v=v, t=t: F.get(F.lit(v).cast(t), at) for v, t in ((bounds, "array<bigint>"), (ends, "array<int>")))
    placed = rows.withColumn("at", _range_of(F.col("key"), bounds))
    if starts:
        known = F.broadcast(spark.createDataFrame(list(starts.items()), "key long, starts array<long>"))
        inner = F.size(F.filter("starts", lambda h: h <= F.col("hash"))) - 1
        placed = placed.join(known, "key", "left").withColumn("part", F.coalesce(F.when(F.col("starts").isNotNull(), inner), end(F.col("at"))))
        first = F.when(F.col("starts").isNull(), F.col("key") == bound(F.col("at"))).otherwise(F.col("hash") == F.get("starts", F.col("part")))
        inside = F.col("starts").isNotNull() & (F.col("part") > 0)
    else:
        placed, first, inside = placed.withColumn("part", F.lit(0)), F.col("key") == bound(F.col("at")), F.lit(False)
    bucket = F.col("at").cast("long") * width + F.col("part")
    earlier = F.when(F.col("at") == 0, len(bounds) - 1).otherwise(F.col("at") - 1)
    before = F.when(inside, bucket - 1).otherwise(earlier.cast("long") * width + end(earlier))
    own = F.struct(bucket.alias("bucket"), F.lit(False).alias("guest"))
    guest = F.struct(before.alias("bucket"), F.lit(True).alias("guest"))
    dealt = placed.withColumn("to", F.explode(F.when(first, F.array(own, guest)).otherwise(F.array(own))))
    return (
        dealt.select("doc_id", "text", "hash", "to.bucket", "to.guest"),
        Window.partitionBy("bucket").orderBy("guest", "doc_id", "hash", "text"),
        left_out,
    )


def repeated(rows: DataFrame, chunk: int = 1000) -> DataFrame:
    """Every row ``more`` times, dealt to tasks by ``chunk`` rows."""
    chunks = rows.withColumn("_chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("more") - 1) / chunk))))
    dealt = chunks.repartition(partitions(rows.sparkSession), "doc_id", "text", "_chunk")
    each = F.sequence(F.lit(1).cast("long"), F.least(F.lit(chunk), F.col("more") - F.col("_chunk") * chunk))
    return dealt.withColumn("_each", F.explode(each)).drop("_chunk", "_each", "more")


def _shown(sketch: Column) -> Column:
    return F.array_join(F.transform(sketch, lambda h: F.lower(F.lpad(F.hex(h), 16, "0"))), "")


def op2_bottom_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, order, left_out = with_next(documents(spark, sf_dir))
    # Sketches of the texts and of their next ones come from one window: both follow the same order.
    paired = sketched(rows, "text", "sketch").withColumn("next", F.lead("text").over(order)).withColumn(
        "next_sketch", F.lead("sketch").over(order)
    ).where(~F.col("guest")).select("doc_id", "text", "sketch", "next", "next_sketch")
    if left_out is not None:
        copies = repeated(sketched(left_out, "text", "sketch"))
        paired = paired.unionByName(copies.withColumns({"next": F.col("text"), "next_sketch": F.col("sketch")}))
    paired = paired.withColumn("n_chars", F.length("text").cast("long")).withColumn(
        "quarter", F.floor(F.col("n_chars") / 4).cast("int")
    )
    edited = F.expr("concat(substring(text, 1, int(n_chars) - quarter), substring(next, 1, quarter))")
    texts = paired.select("doc_id", "n_chars", "sketch", "next_sketch", edited.alias("edited"))
    done = sketched(texts, "edited", "edited_sketch")
    return done.select(
        "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        _shown(F.col("sketch")).alias("fingerprint"), _shown(F.col("edited_sketch")).alias("edited_fingerprint"),
        resemblance(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        resemblance(F.col("sketch"), F.col("next_sketch")).alias("near_next"),
        distinct_shingles(F.col("sketch")).alias("distinct_shingles"),
        containment(F.col("sketch"), F.col("edited_sketch")).alias("kept_in_edited"),
    )
