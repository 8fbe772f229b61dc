import math
from collections import Counter
from zlib import crc32

import numpy as np
from pyspark.sql import functions as F

from quartier.llm import maxent
from quartier.llm.common import fold

SF = "/root/testdata/sf0.01"


def _check(docs, rows, out):
    def tok(t):
        return (t or "").encode().lower().split() + [b""]

    def held(i):
        return crc32(("" if i is None else str(i)).encode()) % 7 == 2

    c = Counter()
    for i, t in rows:
        if not held(i):
            c.update(tok(t))
    n, v = sum(c.values()), len(c)
    want = sorted(((i, held(i), len(tok(t)), sum(c[x] > 0 for x in tok(t)), n,
                    round(sum(math.log10((c[x] + 1) / (n + v + 1)) for x in tok(t)), 3)) for i, t in rows), key=str)
    got = sorted(((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"],
                   round(r["base_score"], 3)) for r in out), key=str)
    assert got == want
    assert all(r["score"] < 0 for r in out)


def test_counts_base_and_gain(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = maxent.score(docs, fold(7) != 2).collect()
    _check(docs, [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()], out)
    unseen = [r for r in out if r["held_out"]]
    base = sum(r["base_score"] for r in unseen) / sum(r["n_tokens"] for r in unseen)
    model = sum(r["score"] for r in unseen) / sum(r["n_tokens"] for r in unseen)
    assert model > base + 0.03


def test_edge_rows_and_rare_tokens(edge_docs, edge_rows, no_docs, monkeypatch):
    monkeypatch.setattr(maxent, "DICTIONARY", 30)  # most tokens are joined
    _check(edge_docs, edge_rows, maxent.score(edge_docs, fold(7) != 2).collect())
    assert maxent.score(no_docs, fold(7) != 2).count() == 0
    nothing = maxent.score(edge_docs, F.lit(False)).collect()
    assert all(r["train_tokens"] == 0 and r["n_known"] == 0 and r["base_score"] == 0 for r in nothing)


def test_probabilities_sum_to_one(spark):
    docs = spark.createDataFrame([(i, f"the cat {'sat' if i % 2 else 'ran'} on mat{i % 7} of house{i}")
                                  for i in range(2000)], "doc_id long, text string")
    vocab = maxent.vocabulary(maxent.count_tokens(docs))
    weights = maxent.train(docs, vocab, 1)
    words = [t.decode() for t in vocab.index if t]
    texts = [f"the cat {w}" for w in words] + ["the cat unseen-word"]
    batch = maxent.Batch(vocab, texts)
    lp = maxent.log_probability(vocab, weights, batch)
    first = np.cumsum(batch.sizes) - batch.sizes
    at = first + 2
    lc = np.append(vocab.logc, 0.0)[batch.ids[at]]
    p = 10 ** (lp[at] + np.where(batch.cls[at] == maxent.CLASSES, lc, 0))
    end = 10 ** maxent.log_probability(vocab, weights, maxent.Batch(vocab, ["the cat"]))[2]
    assert abs(p.sum() + end - 1) < 1e-4
    # training sharpens what follows "cat"
    flat = maxent.log_probability(vocab, maxent.Weights(), batch)
    assert lp[at[words.index("sat")]] > flat[at[words.index("sat")]]


def test_score_against_a_plain_loop(spark):
    """One token after the other: the two softmaxes and the unigram share."""
    docs = spark.createDataFrame([(i, f"the cat {'sat' if i % 3 else 'ran'} on mat{i % 7} near w{i} x{i * i}")
                                  for i in range(1500)], "doc_id long, text string")
    vocab = maxent.vocabulary(maxent.count_tokens(docs))
    weights = maxent.train(docs, vocab, 1)
    mask = 0xFFFFFFFF

    def mix(x):
        x = ((x ^ x >> 16) * 0x7FEB352D) & mask
        x = ((x ^ x >> 15) * 0x846CA68B) & mask
        return x ^ x >> 16

    def softmax(scores, chosen):
        e = [math.exp(s - max(scores)) for s in scores]
        return e[chosen] / sum(e)

    texts = ["the cat sat on mat3 near w7 x49", "cat cat unseen the", ""]
    want = []
    for t in texts:
        past = [0, 0]
        for w in t.encode().split() + [b""]:
            i = vocab.index.get(w)
            cls = maxent.CLASSES if i is None else int(vocab.cls[i])
            a, b = past
            rows = [mix((a * 4 + 1) & mask), mix((a * 0x9E3779B1 + b * 8 + 2) & mask), mix((b * 4 + 3) & mask)]
            own = [weights.w1[r % maxent.CLASS_ROWS].astype(float) for r in rows]
            p = softmax(list(vocab.start + sum(own)), cls)
            if cls < maxent.CLASSES:
                at = [mix(r ^ (cls * 0x85EBCA6B & mask)) % maxent.WORD_ROWS for r in rows]
                inner = vocab.inner[cls] + sum(weights.w2[r].astype(float) for r in at)
                p *= softmax(list(inner), int(vocab.slot[i]))
            else:
                p /= vocab.rest
            want.append(math.log10(p))
            key = int(vocab.key[i]) if i is not None else maxent.HEAD + crc32(w[-3:]) % maxent.ENDINGS
            past = [key + 1, past[0]]
    got = maxent.log_probability(vocab, weights, maxent.Batch(vocab, texts))
    assert np.allclose(got, want, atol=1e-4)


def test_many_equal_counts_leave_a_dictionary(spark, monkeypatch):
    monkeypatch.setattr(maxent, "DICTIONARY", 50)
    docs = spark.createDataFrame([(i, f"w{i}") for i in range(100)], "doc_id long, text string")
    vocab = maxent.vocabulary(maxent.count_tokens(docs))
    assert 30 < len(vocab.index) <= 50 and vocab.size.sum() == len(vocab.index)
