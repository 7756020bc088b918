"""Tables with every odd case: NULLs, empty, blank and long texts, ties, repeated rows, clashing names."""

from __future__ import annotations

import pytest

from llm_rows import EDGE, VECTORS

VECTOR_SCHEMA = "vec_id long, embedding array<float>, label int, n long, component string"
SCHEMA = "doc_id long, text string, lang string, source string, fp long, mark string, copy int, block string, row string, key int, kept int"


@pytest.fixture(scope="session")
def edge_dir(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("edge"))
    rows = [(*r, 1, "m", 2, None, "r", None, 0) for r in EDGE]
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{folder}/documents.parquet")
    labels = [(1, 1, 0), (1, 1, 1), (7, 1, 0), (10, 1, None), (None, 0, 1), (12, 1, 0), (77, 1, 1)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(VECTORS, VECTOR_SCHEMA).write.parquet(f"{folder}/embeddings.parquet")
    return folder


@pytest.fixture(scope="session")
def empty_dir(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("empty"))
    spark.createDataFrame([], SCHEMA).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([], VECTOR_SCHEMA).write.parquet(f"{folder}/embeddings.parquet")
    return folder
