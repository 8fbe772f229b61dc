import random

import corpus_pipeline

SF = "/root/testdata/sf0.001"


def _grams(text):
    w = text.lower().split()
    return {tuple(w[i:i + 5]) for i in range(max(len(w) - 4, 1))}


def test_near_copies_by_five_words(spark):
    """The stage links texts that share 80 % of their five-word shingles: of
    scattered edits and of one edited run."""
    rng = random.Random(11)
    rows = []
    for base in range(8):
        words = [f"w{base}x{i}" for i in range(200)]
        rows.append((10 * base, " ".join(words)))
        for k in range(1, 6):  # scattered edits, around the threshold
            own = list(words)
            for i in range(k):
                own[20 + 35 * i] = f"e{base}y{k}z{i}"
            rows.append((10 * base + k, " ".join(own)))
        own = list(words)
        at = rng.randrange(20, 150)
        own[at:at + 14] = [f"r{base}s{i}" for i in range(14)]
        rows.append((10 * base + 7, " ".join(own)))
    sets = {i: _grams(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in sets:
        for b in sets:
            if b < a and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    want = {find(i) for i in sets}
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    kept = dict(corpus_pipeline.STAGES)["ngram_jaccard_join"](spark, docs, SF)
    assert {r["doc_id"] for r in kept.collect()} == want
    assert len(want) < len(rows) // 2
