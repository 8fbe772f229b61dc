import hashlib
import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from quartier.llm import substrings
from quartier.llm.anchors import WINDOW, anchors
from quartier.llm.suffixes import PAD, common_prefix_reaches, suffix_array


def _brute(rows):
    ids = [2**63 - 1 if i is None else i for i, _ in rows]
    data = [(t or "").encode() for _, t in rows]
    first = {}
    for i, b in zip(ids, data):
        for j in range(len(b) - WINDOW + 1):
            s = b[j:j + WINDOW]
            first[s] = min(first.get(s, i), i)
    out = []
    for (doc, _), i, b in zip(rows, ids, data):
        gone = np.zeros(len(b), bool)
        for j in range(len(b) - WINDOW + 1):
            if first[b[j:j + WINDOW]] < i:
                gone[j:j + WINDOW] = True
        spans = int((gone & ~np.append(False, gone[:-1])).sum())
        kept = bytes(np.frombuffer(b, np.uint8)[~gone])
        out.append((doc, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def _run(docs):
    return sorted(((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"],
                    hashlib.sha256(bytes(r["kept"])).hexdigest())
                   for r in substrings.remove_repeats(docs).collect()), key=str)


def test_edge_rows(edge_docs, edge_rows, no_docs):
    assert _run(edge_docs) == _brute(edge_rows)
    assert _run(no_docs) == []


def test_random_passages_over_many_groups(spark, monkeypatch):
    monkeypatch.setattr(substrings, "GROUP_BYTES", 6000)
    monkeypatch.setattr(substrings, "SHARD_BYTES", 9000)
    rng = random.Random(5)
    pool = ["".join(rng.choice("ab cé\x00\n") for _ in range(rng.randrange(40, 200))) for _ in range(12)]
    rows = []
    for i in range(120):
        parts = []
        for _ in range(rng.randrange(1, 5)):
            p = rng.choice(pool)
            a = rng.randrange(0, 30)
            parts.append(p[a:len(p) - rng.randrange(0, 30)] if rng.random() < 0.5 else p)
            parts.append("".join(rng.choice("xyz wv") for _ in range(rng.randrange(0, 60))))
        rows.append((rng.randrange(100), "".join(parts)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert _run(docs) == _brute(rows)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.binary(min_size=1, max_size=30).map(lambda b: bytes(x % 3 + 1 for x in b)),
                min_size=1, max_size=10))
def test_suffix_array(strings):
    width = max(map(len, strings)) + PAD
    rows = np.zeros((len(strings), width), np.uint8)
    for i, s in enumerate(strings):
        rows[i, :len(s)] = np.frombuffer(s, np.uint8)
    length = np.array([len(s) for s in strings])
    sa = suffix_array(rows, length)
    got = [strings[p // width][p % width:] for p in sa.tolist()]
    assert sorted(got) == got and sorted(sa.tolist()) == sorted(
        i * width + j for i, s in enumerate(strings) for j in range(len(s)))
    reach = common_prefix_reaches(rows, length, sa, 9)
    assert reach.tolist() == [i > 0 and len(got[i]) >= 9 and got[i][:9] == got[i - 1][:9]
                              for i in range(len(got))]


@settings(max_examples=60, deadline=None)
@given(st.text("ab \n", min_size=0, max_size=200), st.text("ab é", min_size=0, max_size=80))
def test_every_window_owns_an_anchor(text, other):
    data = [text.encode(), other.encode(), (other + text).encode()]
    doc, key, lo, hi = anchors(data)
    for i, t in enumerate(data):
        covered = {w for d, a, b in zip(doc, lo, hi) if d == i for w in range(a, b + 1)}
        assert covered == set(range(max(0, len(t) - WINDOW + 1)))
    # equal windows own equal keys
    keys = {}
    for d, k, a, b in zip(doc.tolist(), key.tolist(), lo.tolist(), hi.tolist()):
        for w in range(a, b + 1):
            keys.setdefault((d, w), set()).add(k)
    by_text = {}
    for (d, w), k in keys.items():
        assert by_text.setdefault(data[d][w:w + WINDOW], k) == k
