"""Personal data: rules against plain patterns, decoding and gradient against
full enumeration, entities side by side, edge rows and hostile long texts."""

import itertools
import random
import re
import time

import numpy as np
import pytest

from quartier.llm import pii

PLAIN = {0: r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
         1: r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         2: r"[0-9]([\x20-]?[0-9])+",
         3: r"\+[0-9][\x20().0-9-]+[0-9]"}


def _plain(text):
    out = []
    for k, p in PLAIN.items():
        for m in re.finditer(p, text):
            n = re.sub(r"[^0-9]", "", m.group())
            ok = {0: True, 1: all(int(x) <= 255 for x in m.group().split(".")) if k == 1 else 0,
                  2: 13 <= len(n) <= 19 and sum(
                      sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(n[::-1])) % 10 == 0,
                  3: 9 <= len(n) <= 15}[k]
            if ok:
                out.append((k, m.start(), m.end()))
    return sorted(out)


def _card(r, n=16):
    body = "4" + "".join(r.choice("0123456789") for _ in range(n - 2))
    return next(body + c for c in "0123456789" if pii.luhn(body + c))


def _entity(r, kind):
    return [f"{r.choice('abcxyz')}{r.choice(['n', 'ord', 'es'])}.{r.randrange(100):02}"
            f"@mail{r.randrange(10)}.example.com",
            ".".join(str(r.randrange(256)) for _ in range(4)), _card(r),
            f"+1 ({r.randrange(100, 999)}) 555-{r.randrange(10000):04}"][kind]


@pytest.fixture(scope="module")
def weights():
    r = random.Random(5)
    rows = []
    for kind in range(4):
        for _ in range(60):
            e = _entity(r, kind)
            rows.append((e, [(kind, 0, len(e))]))
    rows += [("".join(r.choice("0123456789abcdef") for _ in range(30)), []) for _ in range(60)]
    rows += [(str(r.randrange(10 ** 6)), []) for _ in range(60)]
    return pii.fit(pii.enlarge(rows))


def test_rules_equal_plain_patterns():
    r = random.Random(1)
    for _ in range(4000):
        text = "".join(r.choice("0123456789012345 .-+@()aB\n_%é١") for _ in range(r.randrange(60)))
        assert pii.base_spans(text) == _plain(text), text
    for _ in range(300):
        text = " ".join(r.choice([_entity(r, r.randrange(4)), "word", "12", "x@y", "."])
                        for _ in range(8))
        assert pii.base_spans(text) == _plain(text), text


def _segmentations(lat):
    """Every way to cover the tokens, as lists of segment numbers."""
    def go(at):
        if at == lat.n:
            yield []
            return
        for i, (_, a, b) in enumerate(lat.segs):
            if a == at:
                for rest in go(b):
                    yield [i, *rest]
    return go(0)


def test_decoding_against_every_segmentation(weights):
    r = random.Random(2)
    for text in ["+1 (605) 555-9305", "1.2.3.4 55", "a.b@c.d.e", "4078918989542222 1.2.3.4",
                 "+1 22 333 4444 5"]:
        lat = pii.Lattice(text)
        for w in [weights, np.array([r.gauss(0, 1) for _ in range(pii.N_FEATURES)])]:
            def score(way):
                return sum(w[f] for i in way for f in lat.features[i])
            best = max(_segmentations(lat), key=score)
            got = pii.decode(text, list(w))
            want = [(lat.segs[i][0], lat.cuts[lat.segs[i][1]], lat.cuts[lat.segs[i][2]])
                    for i in best if lat.segs[i][0] >= 0]
            assert got == want


def test_likelihood_and_gradient():
    rows = [("1.2.3.4 7", [(1, 0, 7)]), ("a@b.c", [(0, 0, 5)]), ("+1 22 333 4444", [(3, 0, 14)])]
    pack = pii.Pack(rows)
    w = np.random.default_rng(3).normal(size=pii.N_FEATURES)
    value, grad = pack.gradient(w)
    want = 0.0
    for text, spans in rows:
        lat = pii.Lattice(text)
        ways = list(_segmentations(lat))
        scores = np.array([sum(w[f] for i in way for f in lat.features[i]) for way in ways])
        gold = [i for i, way in enumerate(ways)
                if [(lat.segs[x][0], lat.cuts[lat.segs[x][1]], lat.cuts[lat.segs[x][2]])
                    for x in way if lat.segs[x][0] >= 0] == spans]
        assert len(gold) == 1
        want += scores[gold[0]] - np.log(np.exp(scores).sum())
    assert value == pytest.approx(want)
    for f in range(pii.N_FEATURES):
        step = np.eye(pii.N_FEATURES)[f] * 1e-5
        slope = (pack.gradient(w + step)[0] - pack.gradient(w - step)[0]) / 2e-5
        assert grad[f] == pytest.approx(slope, abs=1e-4)


def test_entities_side_by_side(weights):
    """All boundaries and types of neighbours, most of which the rules miss."""
    r = random.Random(7)
    w, missed = list(weights), 0
    for _ in range(400):
        kinds = [r.randrange(4) for _ in range(r.randrange(1, 4))]
        parts = [_entity(r, k) for k in kinds]
        text, want = "Foo bar", []
        for k, p in zip(kinds, parts):
            text += " "
            want.append((k, len(text), len(text) + len(p)))
            text += p
        base, full = pii.spans(text + " end.", w)
        assert set(base) <= set(full)
        missed += len(set(want) - set(base))
        assert not set(want) - set(full), text
        assert not [x for x in full if x not in want and x not in base], text
    assert missed > 100


def test_plain_text_stays(weights):
    w = list(weights)
    for text in ["In 2024 there were 12 of 4000 1.5 3.14.15", "token = \"254a3ed195c502ef96b\"",
                 "version 2.0-3 10:30 12-34-56", "4111111111111112", "300.1.2.3 999.999.999.999",
                 "a@b c@ @d", "+12 34", "2024-01-01 12:00:00 10.5 7"]:
        assert pii.spans(text, w) == ([], []), text


def test_edge_rows_and_training_in_spark(spark, edge_docs, no_docs, weights):
    assert pii.find(no_docs, weights).count() == 0
    got = pii.find(edge_docs, pii.train(edge_docs)).collect()
    assert len(got) == edge_docs.count()
    assert {r["doc_id"] for r in got} == {r["doc_id"] for r in edge_docs.collect()}
    r = random.Random(3)
    rows = [(i, f"Das ist {_entity(r, i % 4)} und\n{_entity(r, (i + 1) % 4)} é {i}", 7)
            for i in range(300)]
    rows += [(None, None, 7), (1, "", 7), (None, f"é {_card(r)} 10.20.30.40", 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_card long").repartition(4)
    got = sorted(map(tuple, pii.find(docs, pii.train(docs)).collect()), key=str)
    want = []
    for i, text, _ in rows:
        base = _plain(text or "")
        n = [sum(k == j for k, _, _ in base) for j in range(4)]
        want.append((i, *n, ",".join(f"{pii.KINDS[k]}:{s}:{e}" for k, s, e in base)))
    assert [x[:-1] for x in got] == sorted(want, key=str)
    last = [x for x in got if x[0] is None and x[-1]]
    assert last == [(None, 0, 1, 0, 0, "ip:19:30", "ip:19:30,card:2:18")]


def test_long_texts_take_linear_time(weights):
    w = list(weights)
    n = 300_000
    for text in ["1" * n, "a" * n, "a" * n + "@", "@" * n, "a@" * (n // 2), "1." * (n // 2),
                 "+1" * (n // 2), "1" + " " * n + "1", "-" * n + "1", "a." * (n // 2) + "@b",
                 "x" * n + " 7"]:
        t = time.perf_counter()
        pii.spans(text, w)
        assert time.perf_counter() - t < 25, text[:10]
