"""Operator 10: exact duplicates by progressive refinement.

Texts are equal when they are identical without white space ``[\\x20\\x09-\\x0D]``. Three rounds,
each over the rows that the one before could not tell apart:

1. length of the text without white space: a length that occurs once is settled;
2. hash of its first ``PREFIX_CHARS`` characters, within equal length;
3. SHA-256 of all of it.

Rounds 1 and 2 work on a narrow table of numbers. Round 3 reads the texts again and hashes a
text only if its length and prefix occur more than once; which ones do is told by a bitmap of
fixed size (``FILTER_BITS``, broadcast), whose false hits cost a hash and change nothing. Groups
of equal texts are formed by aggregates that combine before the shuffle, so a group with a third
of all rows is no hot task, and they go back to their rows by ``common.attach``.

Of equal texts the row with the most characters stays, then the smallest ``doc_id``.

Defined results: NULL and empty texts, and those of white space only, are equal; a NULL
``doc_id`` is the smallest; rows that repeat both ``doc_id`` and text share one decision in
``exact_groups`` and count each in ``group_size``, while ``without_copies`` returns one of them;
an empty table gives no rows; other columns, whatever their names, are not touched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scalargrid.llm.common import attach, bitmaps_of, documents, keep_marked, stage, tested, whole_row

PREFIX_CHARS = 128
FILTER_BITS = 1 << 23


def without_space(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", "")


def _key() -> Column:
    return F.xxhash64("n_plain", "prefix")


def _signed(docs: DataFrame, *others: Column) -> DataFrame:
    """Numbers that describe a text, and the text without white space."""
    plain = docs.select(
        F.col("doc_id").alias("doc_id"), F.length(F.coalesce("text", F.lit(""))).cast("long").alias("n_original"),
        without_space(F.col("text")).alias("plain"), *others,
    )
    return plain.select(
        "*", F.length("plain").alias("n_plain"),
        F.xxhash64(F.substring("plain", 1, PREFIX_CHARS)).alias("prefix"),
    )


def _undecided(docs: DataFrame) -> DataFrame:
    """Length and prefix hash of texts that rounds 1 and 2 leave together.

    Rows are counted per length and prefix before lengths are compared: copies are one row by then.
    """
    counted = stage(_signed(docs).groupBy("n_plain", "prefix").agg(F.count("*").alias("n")), "prefixes")
    lengths = counted.groupBy("n_plain").agg(F.sum("n").alias("of_length")).where("of_length > 1")
    return counted.join(lengths, "n_plain").where("n > 1").select("n_plain", "prefix")


def undecided_map(docs: DataFrame) -> DataFrame:
    """Bitmaps of the texts that need round 3, of ``FILTER_BITS`` bits together."""
    return bitmaps_of(_undecided(docs), _key(), FILTER_BITS)


def _with_full(signed: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """``signed`` with ``full``, the SHA-256 of a text that the bitmaps hold, and NULL of any other."""
    full = F.when(F.col("_maybe"), F.sha2(F.col("plain").cast("binary"), 256))
    return tested(signed, _key(), bitmaps, FILTER_BITS).withColumn("full", full)


def hashed(docs: DataFrame, all_digests: bool = False, bitmaps: DataFrame | None = None) -> DataFrame:
    """``doc_id, n_original, full`` and, if asked for, ``digest`` of every text; ``full`` is NULL where settled."""
    rows = _with_full(_signed(docs), undecided_map(docs) if bitmaps is None else bitmaps)
    digest = [F.sha2(F.col("plain").cast("binary"), 256).alias("digest")] if all_digests else []
    return stage(rows.select("doc_id", "n_original", "full", *digest), "hashes")


def exact_groups(docs: DataFrame, all_digests: bool = False, bitmaps: DataFrame | None = None) -> DataFrame:
    """``doc_id, full, keep_id, group_size, kept`` for every row (and ``digest``)."""
    rows = hashed(docs, all_digests, bitmaps)
    groups = stage(
        rows.where(F.col("full").isNotNull()).groupBy("full").agg(
            F.count("*").alias("group_rows"),
            F.min(F.struct((-F.col("n_original")).alias("n"), F.col("doc_id").alias("id"))).alias("best"),
        ).where("group_rows > 1").select("full", "group_rows", F.col("best.id").alias("keep"), F.lit(True).alias("grouped")),
        "equal",
    )
    placed = attach(rows.drop("n_original"), groups.withColumn("size", F.col("group_rows")), "full", ["keep", "size", "grouped"])
    keep = F.when(F.col("grouped"), F.col("keep")).otherwise(F.col("doc_id"))
    return placed.select(
        "doc_id", "full", keep.alias("keep_id"), F.coalesce("size", F.lit(1)).cast("long").alias("group_size"),
        keep.eqNullSafe(F.col("doc_id")).alias("kept"), *(["digest"] if all_digests else []),
    )


def without_copies(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each group of equal texts, all columns as they were; hashes what round 3 hashes."""
    bitmaps = undecided_map(docs)
    decided = stage(
        exact_groups(docs, bitmaps=bitmaps).where(F.col("full").isNotNull()).withColumnRenamed("full", "mark"), "decided"
    )
    marked = _with_full(_signed(docs, whole_row(docs).alias("row")), bitmaps)
    return keep_marked(marked.select("row", F.col("doc_id").alias("key"), F.col("full").alias("own")), decided)


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(documents(spark, sf_dir), all_digests=True).select(
        "doc_id", "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256")
    )


ORACLE_SQL = r"""
WITH plain AS (
    SELECT doc_id, length(coalesce(text, '')) AS n,
           regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS t
    FROM documents
)
SELECT doc_id,
       first_value(doc_id) OVER (PARTITION BY t ORDER BY n DESC, doc_id) AS keep_id,
       count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = first_value(doc_id) OVER (PARTITION BY t ORDER BY n DESC, doc_id) AS kept,
       sha256(t) AS text_sha256
FROM plain
"""
