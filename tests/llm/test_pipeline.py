import re
import zlib

import corpus_pipeline
import duckdb
import numpy as np
import public_tokenizers as P
import pytest
import tokenizers

from quartier.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_queries_match_their_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    got = queries.QUERIES[name](spark, SF)
    cols = sorted(got.columns)
    rel = con.execute(queries.ORACLE[name])
    names = [d[0] for d in rel.description]
    want = [tuple(dict(zip(names, r))[c] for c in cols) for r in rel.fetchall()]
    assert sorted(names) == cols
    assert sorted(map(str, (tuple(r[c] for c in cols) for r in got.collect()))) == sorted(map(str, want))


def _words(t):
    return t.encode().lower().split()


def test_stages_against_brute_force(spark):
    """Every stage on its own input, as written by the one before."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    bench = [r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    stage = dict(corpus_pipeline.STAGES)
    assert list(stage) == ["quality_classifier", "ngram_jaccard_join", "suffix_array_dedup",
                           "benchmark_decontamination", "lexical_packing"]
    # what near-duplicate stages on word shingles are to take
    assert (corpus_pipeline.SHINGLE, corpus_pipeline.PERCENT) == (5, 80)

    def rows(df):
        return {r["doc_id"]: r for r in df.collect()}

    before = rows(docs)
    kept = stage["quality_classifier"](spark, docs, SF).cache()
    after = rows(kept)
    assert kept.columns == docs.columns
    good = [i for i, q in labels.items() if q == 1]
    assert np.mean([i in after for i in good]) > 0.97
    assert np.mean([i not in after for i, q in labels.items() if q == 0]) > 0.8
    assert all(after[i] == before[i] for i in after)

    def grams(t):
        w, n = _words(t), corpus_pipeline.SHINGLE
        return {tuple(w[i:i + n]) for i in range(max(len(w) - n + 1, 1))} if w else set()

    sets = {i: grams(r["text"]) for i, r in after.items()}
    ids = sorted(sets)
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in ids:
        for b in ids:
            if b < a and sets[a] and sets[b] and \
                    100 * len(sets[a] & sets[b]) >= corpus_pipeline.PERCENT * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    kept = stage["ngram_jaccard_join"](spark, kept, SF).cache()
    after = rows(kept)
    assert set(after) == {find(i) for i in ids}

    first = {}
    for i in sorted(after):
        b = after[i]["text"].encode()
        for j in range(len(b) - 49):
            first.setdefault(b[j:j + 50], i)
    cut = stage["suffix_array_dedup"](spark, kept, SF).cache()
    got = rows(cut)
    assert cut.columns == docs.columns
    for i, r in after.items():
        b = r["text"].encode()
        gone = np.zeros(len(b), bool)
        for j in range(len(b) - 49):
            if first[b[j:j + 50]] < i:
                gone[j:j + 50] = True
        text = bytes(np.frombuffer(b, np.uint8)[~gone]).decode(errors="replace")
        if text.strip(" \t\n\x0b\f\r"):
            if not gone.any():
                assert got[i]["text"] == text
            assert abs(len(got[i]["text"]) - len(text)) <= 2 and got[i]["n_chars"] == len(got[i]["text"])
        else:
            assert i not in got

    def win(t):
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t))
        return w

    wins = set()
    for t in bench:
        w = win(t)
        n = min(10, len(w))
        wins |= {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if n else set()
    clean = stage["benchmark_decontamination"](spark, cut, SF).cache()
    want = {i for i, r in got.items() if not any(
        tuple(win(r["text"])[j:j + n]) in wins for n in {len(x) for x in wins}
        for j in range(len(win(r["text"])) - n + 1))}
    assert set(rows(clean)) == want

    lib = tokenizers.Tokenizer.from_file(P.path("word_bpe_49k.json"))
    covered = {}
    for p in stage["lexical_packing"](spark, clean, SF).collect():
        ids_ = lib.encode(rows_ids := rows_text(clean)[p["doc_id"]], add_special_tokens=False).ids + [1]
        assert rows_ids is not None
        part = ids_[p["start"]:p["start"] + p["length"]]
        assert zlib.crc32(np.array(part, "<u4").tobytes()) == p["ids_crc32"]
        covered[p["doc_id"]] = covered.get(p["doc_id"], 0) + p["length"]
        assert p["doc_tokens"] == len(ids_)
    assert set(covered) == want


_TEXTS = {}


def rows_text(df):
    if id(df) not in _TEXTS:
        _TEXTS[id(df)] = {r["doc_id"]: r["text"] for r in df.collect()}
    return _TEXTS[id(df)]


def test_stages_on_edge_rows(spark, edge_docs, no_docs):
    """Nulls, repeated rows, extra columns and empty tables go through every stage."""
    for docs in (edge_docs, no_docs):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, SF)
            docs = spark.createDataFrame(docs.collect(), docs.schema)
            assert tuple(docs.columns) == corpus_pipeline.COLUMNS, name
        assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() >= 0
