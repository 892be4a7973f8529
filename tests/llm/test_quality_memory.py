"""What a task of the word counts holds, and counts that go out in parts."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa

from cargolume.llm import quality


def counted(monkeypatch, batches):
    """The sums of one task's rows, and the MB that it held at most."""
    made = {}

    class Docs:
        def select(self, *names):
            return self

        def mapInArrow(self, run, schema):
            made["run"] = run
            return self

    monkeypatch.setattr(quality, "summed_blocks", lambda rows, kind: np.zeros(0, kind))
    quality.context_sums(Docs())
    sums, rows = {}, 0
    tracemalloc.start()
    for out in made["run"](iter(batches)):
        for block, data in zip(out.column(0).to_pylist(), out.column(1)):
            sums[block] = sums.get(block, 0) + np.frombuffer(data.as_buffer(), np.int64)
            rows += 1
    most = tracemalloc.get_traced_memory()[1] / 1e6
    tracemalloc.stop()
    return np.concatenate([sums[k] for k in sorted(sums)]), rows, most


def batches():
    rnd = random.Random(3)
    texts = [" ".join(f"w{rnd.randrange(5000)}" for _ in range(3000)) for _ in range(130)]
    return [pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts)], ["doc_id", "text"])]


def test_a_task_of_counts_holds_little(monkeypatch):
    """A worker's arrays stay well below what a core of an executor has besides the heap."""
    _, _, most = counted(monkeypatch, batches())
    assert most < 130


def test_counts_go_out_before_they_leave_32_bits(monkeypatch):
    whole, rows, _ = counted(monkeypatch, batches())
    monkeypatch.setattr(quality, "MOST_COUNTED", quality.CHUNK)
    parts, more, _ = counted(monkeypatch, batches())
    assert rows == 64 < more and np.array_equal(whole, parts)
