"""Texts are looked up in the dictionary once; rounds and scoring read numbers."""

import numpy as np
from pyspark.sql import functions as F

from quartier.llm import maxent
from quartier.llm.common import fold, texts


def _docs(spark, n=60):
    words = ["the", "cat", "sat", "on", "mat", "Ünder", "x1"]
    rows = [(i, " ".join(words[(i * k) % 7] for k in range(i % 9)) + f" w{i}") for i in range(n)]
    return spark.createDataFrame([*rows, (n, None), (None, "the cat")], "doc_id long, text string")


def test_a_text_is_read_for_its_counts_and_its_numbers_only(spark):
    read = spark.sparkContext.accumulator(0)

    def see(text):
        read.add(1)
        return text

    docs = _docs(spark).coalesce(1).localCheckpoint()
    train_rows = docs.filter(fold(7) != 2).count()
    seen = docs.withColumn("text", F.udf(see, "string")("text"))
    got = maxent.score(seen, fold(7) != 2).collect()
    assert len(got) == docs.count()
    assert read.value <= train_rows + docs.count()


def test_numbered_texts_teach_and_score_as_texts_do(spark):
    docs = texts(_docs(spark)).coalesce(1)
    vocab = maxent.vocabulary(maxent.count_tokens(docs.filter("doc_id % 2 = 0")))
    numbered = maxent.encoded(docs, vocab)
    a, b = maxent.train(docs, vocab, 2), maxent.train(numbered, vocab, 2)
    assert np.array_equal(a.w1, b.w1) and np.array_equal(a.w2, b.w2) and a.w1.any()
    for t, r in zip(docs.collect(), numbered.collect()):
        codes, missing = maxent.encode(vocab, t["text"])
        assert r["codes"] == codes.tobytes() and [bytes(w) for w in r["words"]] == missing
        assert r["n_chars"] == len(t["text"]) and r["doc_id"] == t["doc_id"]
        found = maxent.tokens(t["text"])
        assert missing == [w for w in found if w not in vocab.index] and len(codes) == len(found)
        plain, numbers = maxent.Batch(vocab, [t["text"]]), maxent.Batch(vocab, [], [codes])
        assert np.array_equal(maxent.log_probability(vocab, a, plain),
                              maxent.log_probability(vocab, a, numbers))
