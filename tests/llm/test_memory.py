"""What a Python worker holds within a task and keeps after it."""

import re
from pathlib import Path

import public_tokenizers
import pyarrow as pa
import pytest

from cartwise.llm import bpe, common


def held_mb() -> float:
    return int(re.search(r"\nAnonymous:\s+(\d+)", Path("/proc/self/smaps_rollup").read_text())[1]) / 1024


def test_worker_gives_memory_back():
    def run(batches):
        for _ in batches:
            blocks = [b"x" * 50_000 for _ in range(4000)]  # 200 MB, below the size that is mapped by itself
            pins.append(b"y" * 50_000)  # on top of them, so that the heap cannot shrink from its end
            yield len(blocks)

    pins: list[bytes] = []
    before = held_mb()
    assert list(common.lean(run)([1])) == [4000]
    assert held_mb() - before < 100


def test_worker_gives_memory_back_when_a_task_fails(monkeypatch):
    called = []
    monkeypatch.setattr(common, "give_back", lambda: called.append(1))

    def run(batches):
        yield 1
        raise ValueError("task")

    with pytest.raises(ValueError, match="task"):
        list(common.lean(run)([]))
    assert len(called) == 2


def test_bpe_holds_few_texts_at_once():
    ranks = bpe.read_ranks(public_tokenizers.path(bpe.RANK_FILE))
    texts = [None, "", *(f"word{i} über {'ab' * i}" for i in range(1000))]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts)], names=["doc_id", "text"])
    codec = bpe.Codec(ranks, bpe.model_bytes(ranks), public_tokenizers.PATTERN)
    got = list(bpe.encoded([batch, batch.slice(0, 0)], codec, True))
    assert max(b.num_rows for b in got) <= bpe.ROWS_AT_ONCE
    rows = pa.Table.from_batches(got)
    assert rows["doc_id"].to_pylist() == list(range(len(texts)))
    assert rows["n_tokens"].to_pylist() == [len(x) for x in rows["ids"].to_pylist()]
    decoded = [b"".join(codec.pieces[i] for i in ids).decode() for ids in rows["ids"].to_pylist()]
    assert decoded == [t or "" for t in texts]
