"""Merkle manifest against a plain loop over edge rows, many sources and a
source of several levels."""

import hashlib
import zlib

from pyspark.sql import functions as F

from quartier.llm import merkle


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _leaf(row, low=False):
    def framed(v):
        if v is None:
            return "-"
        s = str(v)
        return f"{len(s.encode())}:{s}"
    text = row["text"]
    if low and text is not None:
        text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    return H(*[framed(row[c]) for c in merkle.FIELDS[:-1]], framed(text))


def _brute(rows):
    """(doc_id, leaf, subroot, root, proof, folded root) of every row, sorted."""
    def climb(hashes):
        """The root and, for each node, its (before, after) pairs upwards."""
        at = [[i, []] for i in range(len(hashes))]
        level = list(hashes)
        while len(level) > 1:
            for a in at:
                run, slot = divmod(a[0], 16)
                kids = level[16 * run:16 * run + 16]
                a[1].append(("".join(kids[:slot]), "".join(kids[slot + 1:])))
                a[0] = run
            level = [H(*level[i:i + 16]) for i in range(0, len(level), 16)]
        return level[0], [a[1] for a in at]

    by = {}
    for r in rows:
        by.setdefault(r["source"], []).append(r)
    sources = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in sources:
        members = sorted(by[s], key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, _leaf(r)))
        trees[s] = (members, *climb([_leaf(r) for r in members]))
    root, crowns = climb([trees[s][1] for s in sources]) if sources else (None, [])
    out = []
    for s, crown in zip(sources, crowns):
        members, subroot, paths = trees[s]
        for r, path in zip(members, paths):
            path = path + crown
            struck = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0
            h = _leaf(r, low=struck)
            for before, after in path:
                h = H(before, h, after)
            out.append((r["doc_id"], _leaf(r), subroot, root,
                        H(*[x for p in path for x in p]), h))
    return sorted(out, key=str)


def _got(df):
    rows = merkle.manifest(df).select(
        "doc_id", "leaf", "subroot", "root", merkle.proof(F.col("path")).alias("proof"),
        merkle.fold(F.coalesce("forged", "leaf"), F.col("path")).alias("folded"))
    return sorted([tuple(r) for r in rows.collect()], key=str)


def test_many_sources_and_levels(spark):
    rows = [{"doc_id": i * 3, "source": None if i % 7 == 0 else f"s{i % 40}" if i % 2 else "big",
             "lang": None if i % 11 == 0 else "en", "n_chars": None if i % 13 == 0 else i,
             "text": None if i % 17 == 0 else f"Text {i} é"} for i in range(700)]
    df = spark.createDataFrame([tuple(r.values()) for r in rows],
                               "doc_id long, source string, lang string, n_chars long, text string")
    got = _got(df.repartition(5).withColumn("hash", F.lit("x")).withColumn("g", F.lit(1)))
    assert got == _brute(rows)
    assert len({r[2] for r in got}) > 20 and len({r[3] for r in got}) == 1
    assert any(r[5] != r[3] for r in got) and any(r[5] == r[3] for r in got)


def test_edge_rows(edge_docs, edge_rows):
    rows = [{"doc_id": i, "source": "s", "lang": "xx", "n_chars": 5, "text": t}
            for i, t in edge_rows]
    assert _got(edge_docs) == _brute(rows)


def test_one_row_and_no_rows(spark, no_docs):
    assert _got(no_docs) == []
    rows = [{"doc_id": 1, "source": "only", "lang": "en", "n_chars": 1, "text": "A"}]
    df = spark.createDataFrame([tuple(r.values()) for r in rows],
                               "doc_id long, source string, lang string, n_chars long, text string")
    got = _got(df)
    assert got == _brute(rows) and got[0][1] == got[0][2]
