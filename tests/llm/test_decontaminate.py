import hashlib
import re

from quartier.llm import decontaminate as d

_W = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def _words(t):
    return _W.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def _brute(text, items):
    w = _words(text)
    hit, found = set(), set()
    for i, t in items:
        v = _words(t)
        n = min(10, len(v))
        wins = {tuple(v[j:j + n]) for j in range(len(v) - n + 1)} if n else set()
        for j in range(len(w) - n + 1) if n else ():
            if tuple(w[j:j + n]) in wins:
                hit.update(range(j, j + n))
                found.add(str(i))
    ids = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
    return len(w), len(hit), len(found), ids, bool(hit)


ITEMS = [(1, "word1 tail1 word2 tail2 word3 tail3 word4 tail4 word5 tail5 word6 tail6"), (2, "One!"),
         (10, "two WORDS"), (3, ""), (4, None), (5, "many words and numbers"), (6, "nothing like this here"),
         (7, "été à"), (11, "word1 tail1 word2 tail2 word3 tail3 word4 tail4 word5 tail5 word6 tail7")]


def _check(spark, docs, rows, items):
    bench = spark.createDataFrame([(i, t, "w") for i, t in items], "item_id long, text string, window string")
    got = sorted((tuple(r) for r in d.contamination(docs, bench).collect()), key=str)
    assert got == sorted(((i, *_brute(t, items)) for i, t in rows), key=str)


def test_matches_brute_force(spark, edge_docs, edge_rows):
    _check(spark, edge_docs, edge_rows, ITEMS)


def test_benchmark_in_several_blocks(spark, edge_docs, edge_rows, monkeypatch):
    monkeypatch.setattr(d, "BLOCK_BYTES", 200)
    _check(spark, edge_docs, edge_rows, ITEMS)


def test_empty_tables(spark, edge_docs, edge_rows, no_docs):
    _check(spark, edge_docs, edge_rows, [])
    _check(spark, no_docs, [], ITEMS)


def test_item_without_an_id_is_none_named_null(spark):
    docs = spark.createDataFrame([(1, "a two words b"), (2, "three words"), (3, "two words, three words")],
                                 "doc_id long, text string")
    bench = spark.createDataFrame([(None, "two words"), ("null", "three words"), (None, "a two"), ("", "b")],
                                  "item_id string, text string")
    got = {r["doc_id"]: r for r in d.contamination(docs, bench).collect()}
    assert {i: r["n_items"] for i, r in got.items()} == {1: 2, 2: 1, 3: 2}
    for i, ids in ((1, ""), (2, "null"), (3, "null")):
        assert got[i]["items_sha256"] == hashlib.sha256(ids.encode()).hexdigest()
    assert sorted(map(str, d.find(docs, bench).filter("doc_id = 3").first()["items"])) == ["None", "null"]
