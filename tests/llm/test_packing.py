import zlib

import numpy as np
import public_tokenizers as P
import tokenizers

from quartier.llm import packing

PATH = P.path("word_bpe_49k.json")


def _check(docs, rows, window):
    lib = tokenizers.Tokenizer.from_file(PATH)
    want = sorted((-1 if i is None else i, tuple(lib.encode(t or "", add_special_tokens=False).ids + [1]))
                  for i, t in rows)
    out = packing.pack(docs, PATH, 1, window).collect()
    by_doc, by_seq = {}, {}
    for r in out:
        by_doc.setdefault((-1 if r["doc_id"] is None else r["doc_id"], r["doc_tokens"]), []).append(r)
        by_seq.setdefault(r["sequence_id"], []).append(r)
    seen = 0
    for (doc, n), pieces in by_doc.items():
        texts = [w for i, w in want if i == doc and len(w) == n]
        covered = np.zeros(n, int)
        for p in pieces:
            a = p["start"]
            covered[a:a + p["length"]] += 1
            crcs = {zlib.crc32(np.array(w[a:a + p["length"]], "<u4").tobytes()) for w in texts}
            assert p["ids_crc32"] in crcs
        assert (covered == len(texts)).all()
        seen += len(texts)
    assert seen == len(rows)
    for pieces in by_seq.values():
        pieces.sort(key=lambda r: r["offset"])
        at = 0
        for p in pieces:
            assert p["offset"] == at and p["length"] > 0
            at += p["length"]
        assert at <= window
    return out, by_seq


def test_every_id_once(edge_docs, edge_rows):
    _check(edge_docs, edge_rows, 2048)
    _, by_seq = _check(edge_docs, edge_rows, 64)
    full = [sum(p["length"] for p in s) == 64 for s in by_seq.values()]
    assert full.count(False) <= 1


def test_neighbours_share_words(spark):
    rows = [(i, " ".join(f"{'abcd'[i % 4] * 3}{j % 10}" for j in range(20))) for i in range(64)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    n = len(tokenizers.Tokenizer.from_file(PATH).encode(rows[0][1], add_special_tokens=False).ids) + 1
    out, by_seq = _check(docs, rows, 4 * n)
    alike = [len({p["doc_id"] % 4 for p in s}) for s in by_seq.values()]
    assert np.mean(alike) < 2


def test_empty(no_docs):
    assert packing.pack(no_docs, PATH).count() == 0


def test_bulk_merges_are_the_library_s():
    """Plain words merged in bulk get the library's ids: the vocabulary's own
    words, pairs of them, and random strings."""
    rng = np.random.default_rng(4)
    enc = packing.Encoder(PATH, 1)
    own = [w.removesuffix("</w>") for w in enc.tok.get_vocab() if w.removesuffix("</w>").isalpha()]
    own = [w for w in own if w.isascii() and w.islower()]  # as the encoder asks
    pairs = [own[a] + own[b] for a, b in rng.integers(0, len(own), (20000, 2))]
    noise = ["".join("aeioustnrlhéüß"[i] for i in rng.integers(0, 14, n))
             for n in rng.integers(1, 12, 20000)]
    words = list(dict.fromkeys(own + pairs + noise))
    assert enc.merges.ids(words) == enc._ids(words)
