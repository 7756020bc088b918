"""What Python workers remember of one stage does not take the memory of another."""

from __future__ import annotations

import sys

import corpus_pipeline
import numpy as np
import pyarrow as pa
import public_tokenizers

from scalargrid.llm import encoding, packing, toxicity


def remembering(spark) -> int:
    """How many of many short tasks met a worker that holds an encoder."""

    def count(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": pa.array([encoding.encoder.cache_info().currsize], pa.int64())})

    return sum(r.n > 0 for r in spark.range(0, 32, numPartitions=32).mapInArrow(count, "n long").collect())


def test_scoring_gives_back_remembered_ids(spark):
    docs = spark.createDataFrame([(i, f"some text {i}") for i in range(64)], "doc_id long, text string").repartition(32)
    packing.pieces(docs, public_tokenizers.path("byte_bpe_50k.json")).collect()
    assert remembering(spark) > 0
    assert len(toxicity.scored(docs, toxicity.Model(share=0.5), ["doc_id"]).collect()) == 64
    assert remembering(spark) == 0


def remembered(encoder) -> int:
    return sys.getsizeof(encoder) + sum(sys.getsizeof(k) + sys.getsizeof(v) for k, v in encoder.items())


def test_packing_in_the_pipeline_remembers_little():
    encoder = encoding.ChunkEncoder(public_tokenizers.path("byte_bpe_50k.json"), True, corpus_pipeline.KEEP_CHUNKS)
    for i in range(0, 500_000, 1000):
        encoder.encode("".join(f" w{k}" for k in range(i, i + 1000)))
    assert remembered(encoder) < 48e6


def test_chunks_of_texts_without_white_space_are_not_remembered():
    encoder = encoding.ChunkEncoder(public_tokenizers.path("byte_bpe_50k.json"), True)
    for i in range(50):
        text = chr(0x4E00 + i) + "".join(chr(0x4E00 + (7 * k + i) % 5000) for k in range(5000))
        got = np.frombuffer(encoder.encode(text), dtype="<u4").tolist()
        assert got == encoder._tokenizer.encode(text, add_special_tokens=False).ids
    assert remembered(encoder) < 1e6


def test_memory_of_gone_batches_is_given_back():
    pool = pa.default_memory_pool()
    encoding.give_back()
    before = resident()
    held = [pa.array(np.arange(100_000) % 7 + k).cast(pa.string()) for k in range(200)]
    assert pool.bytes_allocated() > 50e6
    del held
    encoding.forget()
    assert resident() < before + 40e6


def resident() -> int:
    with open("/proc/self/statm") as f:
        return int(f.read().split()[1]) * 4096
