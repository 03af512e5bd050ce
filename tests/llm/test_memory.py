"""Memory that a task's Python worker takes follows a batch, not the number or length of its texts."""

from __future__ import annotations

import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from tradewake.llm import byte_bpe, decontaminate, jaccard_join, quality
from tradewake.llm.frames import ARROW_BYTES, map_batches, vocabulary_path

KEY = "spark.sql.execution.arrow.maxBytesPerBatch"


@pytest.mark.parametrize("use", [
    lambda docs, labels, items: quality.classify(docs, labels),
    lambda docs, labels, items: jaccard_join.jaccard_components(docs),
    lambda docs, labels, items: decontaminate.contamination(docs, items),
    lambda docs, labels, items: byte_bpe.encode_decode(docs, vocabulary_path(), full=False)])
def test_operators_of_the_pipeline_bound_arrow_batches(spark, use):
    def sizes(batch):
        yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], names=["bytes"])

    texts = spark.range(0, 3000, 1, 1).selectExpr("id doc_id", "concat(id, repeat(' word', 800)) text")
    spark.conf.unset(KEY)
    try:
        use(texts.limit(20), spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, quality int"),
            spark.createDataFrame([("a", "word")], "item_id string, text string"))
        found = [r[0] for r in map_batches(texts, sizes, "bytes long").collect()]
        assert len(found) > 1 and max(found) < 1.1 * ARROW_BYTES
    finally:
        spark.conf.unset(KEY)


def test_scores_take_little_memory_and_are_the_same_in_any_batch():
    rng = np.random.default_rng(7)
    texts = [" ".join(rng.choice(["ab", "cde", "F1", "42", "ghi!"], 250)) for _ in range(3000)]
    model = quality.Model(rng.normal(size=quality.DIMENSIONS).astype(np.float32), 0.1)
    scores = quality.score(model).func
    tracemalloc.start()
    whole = scores(pa.array(texts)).to_numpy()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 64 << 20
    alone = np.concatenate([scores(pa.array([t])).to_numpy() for t in texts[:50]])
    assert (alone == whole[:50]).all()
