import random
import re
import time
from collections import Counter

from quartier.llm import rules


def _brute(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    grams = Counter(zip(w, w[1:], w[2:]))
    hit = {p for i, g in enumerate(zip(w, w[1:], w[2:])) if grams[g] > 1 for p in (i, i + 1, i + 2)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(w), sum(map(len, w)), sum(c in rules.SYMBOLS for c in text or ""),
            len(lines) - len(set(lines)), len(hit))


def test_measurements_match_brute_force(edge_docs, edge_rows):
    got = sorted((tuple(r) for r in rules.measure(edge_docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words").collect()),
        key=str)
    assert got == sorted(((i, *_brute(t)) for i, t in edge_rows), key=str)


def test_policies_and_ablation(spark):
    long_ = " ".join(f"w{i}" for i in range(60))
    docs = spark.createDataFrame([(1, long_), (2, "short"), (3, long_ + " ### ### ### ### ### ### ###"),
                                  (4, "a b c " * 40)], "doc_id long, text string")
    led = rules.ledger(docs)
    kept = {r["doc_id"] for r in led.filter(rules.passes("v1")).collect()}
    assert kept == {1}
    assert {r["doc_id"] for r in led.filter(rules.passes("base")).collect()} == {1, 3}
    a = {r["rule"]: (r["n_failed"], r["n_only"]) for r in rules.ablation(led, "v1").collect()}
    assert a["symbols"] == (1, 1) and a["few_words"] == (1, 1) and a["repeated_words"][0] == 1
    assert sum(only for _, only in a.values()) <= 3


def test_empty_table(no_docs):
    assert rules.ledger(no_docs).count() == 0
    assert rules.ablation(rules.ledger(no_docs), "v1").count() == 0


def test_no_python_in_the_plan(edge_docs):
    plan = rules.ledger(edge_docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def test_capital_words(spark):
    parts = ["A", "B", "a", "1", "é", "É", " ", "\n", " ", "-"]
    rnd = random.Random(5)
    rows = ["".join(rnd.choice(parts) for _ in range(rnd.randrange(30))) for _ in range(2000)]
    got = rules.measure(spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string"))
    for r in got.select("doc_id", "n_capital_words").collect():
        words = re.findall(r"[^\x20\x09-\x0D]+", rows[r["doc_id"]])
        assert r["n_capital_words"] == sum(bool(re.fullmatch(r"[^a-z]*[A-Z]{2}[^a-z]*", w))
                                           for w in words), rows[r["doc_id"]]


def test_a_megabyte_word_takes_seconds(spark):
    rows = [(1, "A" * 1_000_000 + "a"), (2, "A1" * 500_000 + "a"), (3, "A" * 1_000_000)]
    began = time.monotonic()
    got = rules.measure(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r["doc_id"]: r["n_capital_words"] for r in got.collect()} == {1: 0, 2: 0, 3: 1}
    assert time.monotonic() - began < 30
