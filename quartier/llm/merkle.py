"""Merkle manifest of a document table: a tree of leaves per source, and a tree
of the sources' roots.

Leaves of a source ascend by doc_id; every ``fanout`` consecutive nodes (a run)
have one parent, level by level, until one node remains. Windows of one run each
give a node its siblings by fixed-offset lag and lead columns, masked by slot and
run length; the run's first child hashes the parent from its leads. A run, never
a source, is the unit of work, so a source of any size spreads over all tasks.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import written
from .numbering import numbered

FANOUT = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def digest(*parts: Column) -> Column:
    """Lowercase hex sha256 of the parts, concatenated."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def leaf(fields: list[Column]) -> Column:
    """Digest of a row: each field as ``-`` if null, else its UTF-8 byte count,
    a colon and the value (integers decimal)."""
    def framed(c: Column) -> Column:
        s = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))
    return digest(*[framed(c) for c in fields])


@dataclass
class Tree:
    """``levels[0]`` holds the leaves, the last level the highest nodes; each
    (g, idx, size, hash) plus the leaves' own columns. A tree of group g ends at
    the level where its size is 1."""
    levels: list[DataFrame]
    fanout: int

    def roots(self) -> DataFrame:
        """(g, hash): the node that remains of each group."""
        tops = [lv.filter("size = 1").select("g", "hash") for lv in self.levels]
        out = tops[0]
        for t in tops[1:]:
            out = out.unionByName(t)
        return out


def _siblings(nodes: DataFrame, fanout: int) -> tuple[DataFrame, list[Column], list[Column]]:
    """Nodes with their run and slot, the lag columns (nearest last) and the lead
    columns (nearest first), empty outside the run."""
    nodes = (nodes.withColumn("slot", (F.col("idx") % fanout).cast("int"))
             .withColumn("run", F.expr(f"idx div {fanout}")))
    length = F.least(F.lit(fanout), F.col("size") - F.col("run") * fanout)
    w = Window.partitionBy("g", "run").orderBy("slot")
    lags = [F.when(F.col("slot") >= k, F.lag("hash", k).over(w)).otherwise("")
            for k in range(fanout - 1, 0, -1)]
    leads = [F.when(F.col("slot") + k < length, F.lead("hash", k).over(w)).otherwise("")
             for k in range(1, fanout)]
    return nodes, lags, leads


def grow(leaves: DataFrame, name: str, fanout: int = FANOUT) -> Tree:
    """All levels above ``leaves`` (g, idx, size, hash, ...), each written."""
    spark = leaves.sparkSession
    levels = [leaves]
    most = leaves.agg(F.max("size")).first()[0] or 1
    while most > 1:
        nodes, _, leads = _siblings(levels[-1].filter("size > 1")
                                    .select("g", "idx", "size", "hash"), fanout)
        nodes = nodes.withColumn("parent", F.concat("hash", *leads)).filter("slot = 0")
        levels.append(written(
            nodes.select("g", F.col("run").alias("idx"),
                         F.expr(f"(size + {fanout - 1}) div {fanout}").alias("size"),
                         digest(F.col("parent")).alias("hash")),
            scratch_path(spark, f"{name}-{len(levels)}")))
        most = -(-most // fanout)
    return Tree(levels, fanout)


def paths(tree: Tree, top: DataFrame) -> DataFrame:
    """The leaves with the columns of ``top`` (g, path, ...) and their own
    ``path``: (before, after) siblings of each level, upwards, then top's."""
    extra = [c for c in top.columns if c not in ("g", "path")]
    above = None
    for nodes in reversed(tree.levels):
        single = nodes.filter("size = 1").join(top, "g")
        if above is None:
            above = single
            continue
        own = [c for c in nodes.columns]
        runs, lags, leads = _siblings(nodes.filter("size > 1"), tree.fanout)
        runs = runs.select(*own, "run", F.concat(*lags).alias("before"),
                           F.concat(*leads).alias("after"))
        up = above.select("g", F.col("idx").alias("run"), "path", *extra)
        inner = runs.join(up, ["g", "run"]).withColumn(
            "path", F.concat(F.array(F.struct("before", "after")), "path"))
        above = inner.select(*own, "path", *extra).unionByName(single.select(*own, "path", *extra))
    return above


def fold(start: Column, path: Column) -> Column:
    """The root recomputed from a leaf and the siblings of its path."""
    return F.aggregate(path, start, lambda h, s: digest(s["before"], h, s["after"]))


def proof(path: Column) -> Column:
    """Digest of all siblings of a path, level by level, left to right."""
    return digest(F.array_join(F.transform(path, lambda s: F.concat(s["before"], s["after"])), ""))


def manifest(docs: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """One row per document: doc_id, source, leaf, subroot, root, path and
    ``forged``, the leaf after tampering (null if not tampered): where 5 divides
    the crc32 of the decimal doc_id, A-Z of the text are lower-cased.

    Nulls count as ``-``; a null doc_id is first in its source and never
    tampered; a null source is a source of its own, the first. Rows of equal
    doc_id ascend by leaf; equal rows are a leaf each. Other columns are
    ignored; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("source").cast("string").alias("source"),
                       *[F.col(c) for c in FIELDS[2:]])
    fields = {c: F.col(c) for c in FIELDS}
    low = fields | {"text": F.translate(F.col("text"), _UPPER, _LOWER)}
    struck = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    leaves = docs.select(
        "doc_id", "source", F.coalesce(F.concat(F.lit("="), "source"), F.lit("")).alias("g"),
        leaf(list(fields.values())).alias("hash"),
        F.when(struck, leaf(list(low.values()))).alias("forged"))
    leaves = numbered(leaves, "g", ["doc_id", "hash"], scratch_path(spark, "merkle-leaves"))
    trees = grow(leaves, "merkle", fanout)
    # the roots of the sources are the leaves of one more tree
    subroots = trees.roots().select(F.lit("").alias("g"), F.col("g").alias("member"), "hash")
    subroots = numbered(subroots, "g", ["member"], scratch_path(spark, "merkle-sources"))
    crown = grow(subroots, "merkle-crown", fanout)
    end = crown.roots().select("g", F.col("hash").alias("root"),
                               F.expr("cast(array() as array<struct<before:string,after:string>>)")
                               .alias("path"))
    tops = paths(crown, end).select(F.col("member").alias("g"), F.col("hash").alias("subroot"),
                                    "root", "path")
    tops = written(tops, scratch_path(spark, "merkle-tops"))
    return paths(trees, tops).select("doc_id", "source", F.col("hash").alias("leaf"), "forged",
                                     "subroot", "root", "path")
