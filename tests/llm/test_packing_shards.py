import random

import numpy as np
import public_tokenizers as P

from quartier.llm import packing
from quartier.llm.common import written
from quartier.session import scratch_path

PATH = P.path("word_bpe_49k.json")


def test_neighbours_over_several_shards(spark, monkeypatch):
    """Most of a document's nearest ones by brute force over the corpus are in
    its shard, and frequencies are those of the corpus."""
    monkeypatch.setattr(packing, "SHARD_DOCS", 40)
    rng = random.Random(2)
    own = [[f"{a}{b}{c}" for b in "aeiou" for c in "bdgklmnprst"] for a in "bcdfghklmnpr"]
    rows = [(i, " ".join(rng.choice(own[i % 12]) if rng.random() < 0.6 else rng.choice("the of and in to on".split())
                         for _ in range(60))) for i in range(480)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    dtype = packing.Encoder(PATH, 1).dtype
    encoded = written(packing.encode(docs, PATH, 1), scratch_path(spark, "encoded"))
    whole = packing.corpus(encoded)
    dealt = packing.deal(encoded, whole, dtype).collect()
    assert sorted(r["doc_id"] for r in dealt) == list(range(480)) and whole.n == 480
    shard = np.array([r["shard"] for r in dealt])
    assert len(set(shard)) >= 12 and np.bincount(shard).max() <= 60
    terms = [np.frombuffer(r["terms"], dtype) for r in dealt]
    df = np.bincount(np.concatenate(terms), minlength=len(whole.df))
    assert (df == whole.df).all()
    length = np.array([r["doc_tokens"] for r in dealt])
    index = packing.Index(whole, terms, [np.frombuffer(r["tf"], np.uint8) for r in dealt], length)
    recall = []
    for d in range(480):
        score = index.scores(d)
        score[d] = -1
        recall.append((shard[np.argsort(-score, kind="stable")[:10]] == shard[d]).mean())
    assert np.mean(recall) > 0.6  # by chance: a twelfth
    kind = {r["doc_id"]: r["doc_id"] % 12 for r in dealt}
    by = {}
    for r in packing.pack(docs, PATH, 1, 512).collect():
        by.setdefault(r["sequence_id"], set()).add(kind[r["doc_id"]])
    assert np.mean([len(x) for x in by.values()]) < 2.5


def test_copies_do_not_fill_one_shard(spark, monkeypatch):
    monkeypatch.setattr(packing, "SHARD_DOCS", 20)
    rows = [(None if i % 2 else 7, "the same text in every row") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    dtype = packing.Encoder(PATH, 1).dtype
    encoded = written(packing.encode(docs, PATH, 1), scratch_path(spark, "encoded"))
    dealt = packing.deal(encoded, packing.corpus(encoded), dtype).groupBy("shard").count().collect()
    assert sum(r["count"] for r in dealt) == 200 and max(r["count"] for r in dealt) <= 40
