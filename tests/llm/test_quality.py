import zlib
from collections import Counter

import numpy as np

from quartier.llm import quality
from quartier.llm.common import most_frequent

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = quality.classify(docs, labels).join(labels, "doc_id").filter("held_out").collect()
    assert len(rows) > 100
    assert np.mean([r["predicted"] == r["quality"] for r in rows]) > 0.95
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in rows)


def test_edge_rows(spark, edge_docs, edge_rows, no_docs):
    labels = spark.createDataFrame([(1, 1, 0), (2, 1, 0), (16, 0, 1), (16, 0, 1), (3, None, 0), (None, 1, 0),
                                    (4, 1, 0), (15, 0, 0)], "doc_id long, quality int, text int")
    out = quality.classify(edge_docs, labels).collect()
    assert sorted(str(r["doc_id"]) for r in out) == sorted(str(i) for i, _ in edge_rows)
    assert all(0 <= r["score"] <= 1 for r in out)
    assert len({r["score"] for r in out if r["doc_id"] in (5, 6)}) == 1
    assert quality.classify(no_docs, labels).count() == 0
    none = quality.classify(edge_docs, labels.filter("false")).collect()
    assert {r["score"] for r in none} == {0.5}
    one = quality.classify(edge_docs, labels.filter("quality = 1")).collect()
    assert {r["predicted"] for r in one} == {1}


def test_network_and_temperature():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(800, 4))
    p = 1 / (1 + np.exp(-2 * x[:, 0] * x[:, 1]))
    y = (rng.random(800) < p).astype(float)
    net = quality.fit(x, y)
    got = net.probability(x)
    assert np.mean((got > 0.5) == (x[:, 0] * x[:, 1] > 0)) > 0.85
    assert abs(got.mean() - y.mean()) < 0.1 and net.temperature > 0


def _plain_vectors(texts, index):
    """The word table, one neighbour at a time."""
    size = quality.ENDINGS + len(index)
    place, sign = quality._index_vectors(size)
    row = {}
    sums = {}
    for t in texts:
        words = quality.words_of(t)
        for w in words:
            row[w] = index.get(w, zlib.crc32(quality._form(w)) % quality.ENDINGS)
        for i, w in enumerate(words):
            for gap in range(1, quality.REACH + 1):
                for j in (i - gap, i + gap):
                    if 0 <= j < len(words):
                        own, other = sums.setdefault(row[w], [0.0] * quality.DIM), row[words[j]]
                        for p, s in zip(place[other].tolist(), sign[other].tolist()):
                            own[p] += s
    out = np.zeros((size, quality.DIM))
    for r, s in sums.items():
        out[r] = np.array(s) / max(np.linalg.norm(s), 1e-6)
    for r in range(size):
        for p, s in zip(place[r].tolist(), sign[r].tolist()):
            out[r, p] += 0.5 * s
    return out, row


def test_vectors_and_pooling_against_plain_loops(edge_docs, edge_rows, monkeypatch):
    monkeypatch.setattr(quality, "_CHUNK", 50)
    monkeypatch.setattr(quality, "_FLUSH", 20)
    texts = [t or "" for _, t in edge_rows]
    counts = Counter(w for t in texts for w in quality.words_of(t))
    index = quality.vocabulary(edge_docs)
    ranked = sorted((w for w in counts if counts[w] >= quality.LEAST), key=lambda w: (-counts[w], w))
    assert index == {w: quality.ENDINGS + i for i, w in enumerate(ranked)}
    assert len(index) > 30 and len(index) < len(counts)
    table = quality.train_vectors(edge_docs, index)
    want, row = _plain_vectors(texts, index)
    assert np.allclose(table, want, atol=1e-5)
    words = quality.Words(index)
    for t in texts:
        found = quality.words_of(t)
        got = quality.pool(words, table, t)[:quality.DIM]
        mean = np.mean([want[row[w]] for w in found], axis=0) if found else np.zeros(quality.DIM)
        assert np.allclose(got, mean, atol=1e-4)


def test_words_of_one_ending_have_vectors_of_their_own(spark):
    """Two words that share case and ending, in different company."""
    docs = spark.createDataFrame(
        [(i, "the nation votes for laws" if i % 2 else "a potion heals old wounds") for i in range(40)],
        "doc_id long, text string")
    index = quality.vocabulary(docs)
    table = quality.train_vectors(docs, index)
    assert quality._form(b"nation") == quality._form(b"potion")
    a, b = table[index[b"nation"]], table[index[b"potion"]]
    assert abs(a @ b) < 0.9 * np.linalg.norm(a) * np.linalg.norm(b)


def test_probability_against_a_plain_network():
    rng = np.random.default_rng(1)
    net = quality.fit(rng.normal(size=(300, 3)), (rng.random(300) < 0.4).astype(float), epochs=2)
    for x in rng.normal(size=(5, 3)):
        z = [(v - m) / s for v, m, s in zip(x, net.mean, net.scale)]
        h = [max(sum(z[i] * net.w1[i][j] for i in range(3)) + net.b1[j], 0) for j in range(len(net.b1))]
        logit = sum(a * b for a, b in zip(h, net.w2)) + net.b2
        assert abs(net.probability(x[None])[0] - 1 / (1 + np.exp(-logit / net.temperature))) < 1e-9


def test_most_frequent_is_never_empty(spark):
    counts = spark.createDataFrame([(f"w{i}", 7) for i in range(5000)] + [("top", 9000)], "w string, n long")
    got = most_frequent(counts, "w", "n", 1000).collect()
    assert 900 < len(got) <= 1000 and "top" in {r["w"] for r in got}
    assert most_frequent(counts, "w", "n", 5001).count() == 5001
    assert most_frequent(counts.filter("false"), "w", "n", 10).count() == 0
