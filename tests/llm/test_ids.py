import random

import pytest

from quartier.llm import common


@pytest.fixture
def sides(spark):
    rng = random.Random(5)
    keys = [rng.randrange(-2**62, 2**62) for _ in range(60)]
    rows = [(k, i) for i, k in enumerate(keys + keys[:20])] + [(None, 900), (None, 901)]
    ids = [(k,) for k in keys[10:40] + keys[10:15]] + [(None,), (7,)]
    return (spark.createDataFrame(rows, "doc_id long, x int"), rows,
            spark.createDataFrame(ids, "doc_id long"), {k for k, in ids} - {None})


@pytest.mark.parametrize("bits", [1 << 15, 1 << 26])
def test_filters_beyond_the_broadcast_limit(sides, monkeypatch, bits):
    df, rows, ids, held = sides
    monkeypatch.setattr(common, "BROADCAST_IDS", 3)
    monkeypatch.setattr(common, "ID_BITS", bits)
    with_, without = common.with_ids(df, ids), common.without_ids(df, ids)
    assert sorted(map(tuple, with_.collect())) == sorted(r for r in rows if r[0] in held)
    assert (sorted(map(tuple, without.collect()), key=str)
            == sorted((r for r in rows if r[0] not in held), key=str))


def test_likely_ids_holds_every_id(sides, monkeypatch):
    df, rows, ids, held = sides
    found = {tuple(r) for r in common.likely_ids(df, ids).collect()}
    assert found == {r for r in rows if r[0] in held}       # 36 ids share no bit of 2**26
    monkeypatch.setattr(common, "ID_BITS", 4)
    found = {tuple(r) for r in common.likely_ids(df, ids).collect()}
    assert {r for r in rows if r[0] in held} <= found and (None, 900) not in found
