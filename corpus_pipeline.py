"""A corpus made ready for training: five stages, each written and read back before the next one."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from scalargrid.llm import exact_dedup, mixing, near_copies, packing, toxicity
from scalargrid.llm.common import documents, table
from scalargrid.runtime import shared_dir


# Chunks of text that a Python worker remembers while it tokenises, some 40 MB with their pieces; the heap of an
# executor has grown to its limit in the stages before, and workers hold memory of them too.
KEEP_CHUNKS = 150_000


def toxic_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not call toxic; it learns from ``labels`` of the given documents."""
    columns = docs.columns
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.scored(docs, model, columns)
    return scored.where(scored[len(columns)] < 0.5).select(*(scored[i] for i in range(len(columns))))


def exact_copies_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts."""
    return exact_dedup.without_copies(docs)


def near_copies_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of texts whose five-word shingles are similar by 0.8 or more."""
    return near_copies.without_near_copies(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, those of small sources up to ``mixing.MAX_REPEATS`` times."""
    return mixing.mixed(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents and their places in training sequences."""
    return packing.packed(spark, docs, keep=KEEP_CHUNKS)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxic_out),
    ("exact_dedup", exact_copies_out),
    ("simhash_near_dedup", near_copies_out),
    ("source_mixing", mix_sources),
    ("best_fit_packing", pack_sequences),
]

# A trained network and a tokenizer are no SQL. Tests hold near copies against all pairs and the encoder against its library;
# the stages together run on odd rows only.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{shared_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    docs = documents(spark, sf_dir)
    for name, step in STAGES[:-1]:
        step(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
