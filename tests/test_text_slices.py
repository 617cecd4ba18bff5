"""Text UDFs: of a batch only a few texts at a time are Python strings."""

import tracemalloc

import pyarrow as pa

from loomcast.functions import text_udfs as U


def test_a_batch_is_changed_in_slices():
    texts = pa.array([f"“{i}”  " + "word " * 1000 if i % 7 else None for i in range(2000)], pa.string())
    tracemalloc.start()
    out = U.clean_artifacts.func(texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert out.to_pylist() == [U.clean_artifacts_text(t.as_py()) for t in texts]
    assert peak < 3_000_000  # the batch has ten million characters
    assert U.cap_ngram_runs.func(texts[:0]).to_pylist() == []
