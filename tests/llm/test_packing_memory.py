"""A worker that encodes holds little at a time."""

import random
import tracemalloc

import numpy as np
import public_tokenizers as P
import pyarrow as pa

from quartier.llm import packing

PATH = P.path("word_bpe_49k.json")


def _batch(texts):
    return pa.RecordBatch.from_pydict({"doc_id": list(range(len(texts))),
                                       "text": pa.array(texts, pa.string())})


def test_parts_are_bounded_by_rows_and_bytes(monkeypatch):
    monkeypatch.setattr(packing, "BATCH", 5)
    monkeypatch.setattr(packing, "BATCH_BYTES", 100)
    texts = ["", "x" * 30, "y" * 300, "z" * 60, *["a"] * 12, "b" * 99, "b" * 2]
    for b in (_batch(texts), _batch(["out"] + texts).slice(1), _batch([])):
        parts = list(packing._parts(b))
        assert [t for p in parts for t in p.column("text").to_pylist()] == b.column("text").to_pylist()
        for p in parts:
            held = sum(map(len, p.column("text").to_pylist()))
            assert 0 < p.num_rows <= 5 and (held <= 100 or p.num_rows == 1)


def test_encoding_holds_little(monkeypatch):
    rng = random.Random(6)
    own = ["".join(rng.choice("abcdefghij") for _ in range(4)) for _ in range(3000)]
    b = _batch([" ".join(rng.choice(own) for _ in range(700)) for _ in range(2000)])
    enc = packing.Encoder(PATH, 1)
    enc.arrays(b.slice(0, 10).column("text"))
    tracemalloc.start()
    total = 0
    for part in packing._parts(b):
        total += sum(map(len, enc.arrays(part.column("text"))))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert total > 2000 * 701 and peak < 60e6
    # and with 64-bit places the same ids
    some = b.slice(0, 50).column("text")
    want = enc.arrays(some)
    monkeypatch.setattr(packing, "_SMALL", 0)
    assert all(np.array_equal(x, y) for x, y in zip(want, enc.arrays(some), strict=True))
