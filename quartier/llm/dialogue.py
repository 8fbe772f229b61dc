"""Repair of conversation structure by cheapest edits.

A conversation's rows, in order, are edited until the initials of its roles read
``(s?(ua)+)?``: keep a row, give it the role that is due, delete it, or insert an
empty message of the role that is due. Nodes of the edit lattice are (rows used,
state of the pattern); a bidirectional Dijkstra search grows a forward heap from
the start and a reverse heap from the goals, finishes all crossings of equal
cost, and takes the least of their concatenated audits (the edits' initials).

Conversations are cut into blocks of ``BLOCK`` rows that are searched apart, for
every state before and after, and joined in order; so no conversation, however
long, is held in one task. Audits that use the same rows and end in the same
state are never prefixes of one another, so the least one is made of least ones.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import bound_batches
from .numbering import numbered

# Costs of the edits, and of an undeleted truncated row.
RENAME, DELETE, INSERT, CUT_OFF = 2, 3, 2, 1
#: Rows searched together.
BLOCK = 256
_BLANKS = " \t\n\x0b\x0c\r"

# States of the pattern: nothing yet, after s, after u, after a.
NONE, SYSTEM, USER, ASSISTANT = range(4)
GOALS = (NONE, ASSISTANT)
#: The state that the role due next leads to.
_DUE = (USER, USER, ASSISTANT, USER)
_ROLE = {USER: "user", ASSISTANT: "assistant"}
_KEEP = {"s": {NONE: SYSTEM}, "u": {NONE: USER, SYSTEM: USER, ASSISTANT: USER},
         "a": {USER: ASSISTANT}}
_LEGAL = {"su", "ua", "au"}

Node = tuple[int, int]
Label = tuple[int, str]


def _uses(row: str, p: int) -> Iterator[tuple[int, int, str]]:
    """(state after, cost, initial) of the edits that use up a row. Rows: the
    role's initial (x: any other), upper case if truncated; d: to be deleted."""
    yield p, DELETE, "D"
    if row != "d":
        extra = CUT_OFF if row.isupper() else 0
        after = _KEEP.get(row.lower(), {}).get(p)
        if after is not None:
            yield after, extra, "K"
        yield _DUE[p], RENAME + extra, "R"


@lru_cache(maxsize=64)
def _before(row: str) -> tuple[tuple[tuple[int, int, str], ...], ...]:
    """By state after: (state before, cost, initial)."""
    out: list[list] = [[] for _ in range(4)]
    for p in range(4):
        for q, cost, op in _uses(row, p):
            out[q].append((p, cost, op))
    return tuple(map(tuple, out))


def search(rows: str, start: int, goals: tuple[int, ...], inserts_at_end: bool) -> Label | None:
    """(cost, audit) of the cheapest edits of ``rows`` from ``start`` to one of
    ``goals``, of equal ones the least audit; None if there are none."""
    n = len(rows)

    def onward(node: Node) -> Iterator[tuple[Node, int, str]]:
        i, p = node
        if i < n:
            for q, cost, op in _uses(rows[i], p):
                yield (i + 1, q), cost, op
        if i < n or inserts_at_end:
            yield (i, _DUE[p]), INSERT, "I"

    def backward(node: Node) -> Iterator[tuple[Node, int, str]]:
        i, q = node
        if i:
            for p, cost, op in _before(rows[i - 1])[q]:
                yield (i - 1, p), cost, op
        if i < n or inserts_at_end:
            for p in range(4):
                if _DUE[p] == q:
                    yield (i, p), INSERT, "I"

    # At equal cost the heaps go by rows used: only edits that use a row are free.
    fwd: dict[Node, Label] = {(0, start): (0, "")}
    bwd: dict[Node, Label] = {(n, g): (0, "") for g in goals}
    done_f: set[Node] = set()
    done_b: set[Node] = set()
    heap_f: list = []
    heap_b: list = []
    best = float("inf")

    def settle_f(u: Node) -> None:
        nonlocal best
        done_f.add(u)
        cost, audit = fwd[u]
        if u in done_b:
            best = min(best, cost + bwd[u][0])
        for v, c, op in onward(u):
            if v in done_b:
                best = min(best, cost + c + bwd[v][0])
            new = (cost + c, audit + op)
            if v not in done_f and (v not in fwd or new < fwd[v]):
                fwd[v] = new
                heapq.heappush(heap_f, (cost + c, v[0], v))

    def settle_b(v: Node) -> None:
        nonlocal best
        done_b.add(v)
        cost, audit = bwd[v]
        if v in done_f:
            best = min(best, cost + fwd[v][0])
        for u, c, op in backward(v):
            if u in done_f:
                best = min(best, cost + c + fwd[u][0])
            new = (cost + c, op + audit)
            if u not in done_b and (u not in bwd or new < bwd[u]):
                bwd[u] = new
                heapq.heappush(heap_b, (cost + c, n - u[0], u))

    settle_f((0, start))
    for g in goals:
        settle_b((n, g))
    while True:
        while heap_f and heap_f[0][2] in done_f:
            heapq.heappop(heap_f)
        while heap_b and heap_b[0][2] in done_b:
            heapq.heappop(heap_b)
        top_f = heap_f[0][0] if heap_f else float("inf")
        top_b = heap_b[0][0] if heap_b else float("inf")
        if top_f + top_b > best or not (heap_f or heap_b):
            break
        if top_f <= top_b:
            settle_f(heapq.heappop(heap_f)[2])
        else:
            settle_b(heapq.heappop(heap_b)[2])
    if best == float("inf"):
        return None
    audits = [fwd[u][1] + bwd[u][1] for u in done_f & done_b if fwd[u][0] + bwd[u][0] == best]
    for u in done_f:
        cost, audit = fwd[u]
        audits += [audit + op + bwd[v][1] for v, c, op in onward(u)
                   if v in done_b and cost + c + bwd[v][0] == best]
    return int(best), min(audits)


@lru_cache(maxsize=20_000)
def moves(rows: str, first: bool, last: bool) -> tuple[tuple[int, int, int, str], ...]:
    """(state before, after, cost, audit) of a block; the last block ends in a
    goal, written as state 4."""
    out = []
    for p in (NONE,) if first else range(4):
        for q in (4,) if last else range(4):
            hit = search(rows, p, GOALS if last else (q,), last)
            if hit:
                out.append((p, q, *hit))
    return tuple(out)


def chain(blocks: Iterator[tuple[tuple[int, int, int, str], ...]]) -> Label:
    """(cost, audit) of a conversation from its blocks' moves, in order.

    Of each state only the best way is kept, as a linked list of audits; its
    rank among the states' audits decides ties, without comparing whole audits."""
    ways: dict[int, tuple[int, int, tuple]] = {NONE: (0, 0, ())}
    for block in blocks:
        new: dict[int, tuple] = {}
        for p, q, cost, audit in block:
            if p in ways:
                c, rank, pieces = ways[p]
                key = (c + cost, rank, audit)
                if q not in new or key < new[q][0]:
                    new[q] = (key, (audit, pieces))
        order = sorted(new, key=lambda q: new[q][0][1:])
        ways = {q: (new[q][0][0], order.index(q), new[q][1]) for q in new}
    cost, _, pieces = ways[4] if 4 in ways else ways[NONE]
    out = []
    while pieces:
        out.append(pieces[0])
        pieces = pieces[1]
    return cost, "".join(reversed(out))


# -- rows and their faults ------------------------------------------------------------------

def damage(conversations: DataFrame) -> DataFrame:
    """The rows as the check of repairs wants them: by crc32(``conv_id:turn``)
    modulo 20 a row is dropped (0), emptied (1), loses its ``.!?`` (2), is
    repeated (3) or gets the role user (4). Nulls count as one space."""
    c = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        *[F.coalesce(F.col(x).cast("string"), F.lit(" ")).alias(x) for x in ("role", "text")])
    part = [F.coalesce(F.col(x).cast("string"), F.lit(" ")) for x in ("conv_id", "turn")]
    k = (F.crc32(F.concat_ws(":", *part).cast("binary")) % 20).cast("int")
    c = c.withColumn("k", k)
    role = F.when(F.col("k") == 4, "user").otherwise(F.col("role"))
    text = (F.when(F.col("k") == 1, "").when(F.col("k") == 2, F.translate("text", ".!?", ""))
             .otherwise(F.col("text")))
    copies = F.when(F.col("k") == 3, 2).when(F.col("k") == 0, 0).otherwise(1)
    return c.select("conv_id", "turn", role.alias("role"), text.alias("text"),
                    F.explode(F.array_repeat(F.lit(1), copies)).alias("copy")).drop("copy")


def _group() -> Column:
    return F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit(""))


def _key() -> Column:
    """Tells rows of one conversation apart by role and text."""
    return F.unhex(F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role",
                                   "text").cast("binary"), 256))


# codes of a row: 1 + 3 * initial + (0 fine, 1 truncated, 2 blank); 0: first of its key
_INITIALS = "suax"


def _code() -> Column:
    initial = F.substring("role", 1, 1)
    which = (F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2)
              .otherwise(3))
    body = F.rtrim("text", F.lit(_BLANKS))
    fault = (F.when(body == "", 2).when(F.right(body, F.lit(1)).isin(".", "!", "?"), 0)
              .otherwise(1))
    return (1 + 3 * which + fault).cast("int")


def _judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Counts, moves and outer initials of each block."""
    for batch in batches:
        out = []
        for g, block, size, items in batch.itertuples(index=False):
            items = np.sort(np.asarray(items, np.int64))
            slots, codes = items >> 4, items & 15
            first = set(slots[codes == 0].tolist())
            rows, initials = [], []
            blank = duplicate = truncated = 0
            for slot, code in zip(slots.tolist(), codes.tolist()):
                if code == 0:
                    continue
                which, fault = divmod(code - 1, 3)
                letter = _INITIALS[which]
                initials.append(letter)
                if fault == 2:
                    blank += 1
                    letter = "d"
                elif slot not in first:
                    duplicate += 1
                    letter = "d"
                elif fault == 1:
                    truncated += 1
                    letter = letter.upper()
                rows.append(letter)
            illegal = sum(a + b not in _LEGAL for a, b in zip(initials, initials[1:]))
            out.append((g, block, json.dumps([
                blank, duplicate, truncated, illegal, initials[0], initials[-1],
                moves("".join(rows), block == 0, (block + 1) * BLOCK >= size)])))
        yield pd.DataFrame(out, columns=["g", "at", "text"])


def _blocks(rows: DataFrame) -> DataFrame:
    """(g, at, text): the judged blocks of all conversations."""
    spark = rows.sparkSession
    narrow = rows.select(_group().alias("g"), "turn", _key().alias("key"), _code().alias("code"))
    narrow = numbered(narrow, "g", ["turn", "key"], scratch_path(spark, "dialogue-rows"))
    # The first row of a key is marked by its position: no join back on the key,
    # which may be that of very many rows.
    firsts = (narrow.groupBy("g", "key").agg(F.min("idx").alias("idx"),
                                             F.max("size").alias("size"))
              .select("g", "idx", "size", F.lit(0).alias("code")))
    items = narrow.select("g", "idx", "size", "code").unionByName(firsts)
    item = (F.col("idx") % BLOCK * 16 + F.col("code")).cast("int")
    return (items.groupBy("g", F.expr(f"idx div {BLOCK}").alias("block"))
            .agg(F.max("size").alias("size"), F.collect_list(item).alias("items"))
            .mapInPandas(_judge, "g string, at long, text string"))


def _edited(audit: str, rows: Iterator[tuple[str, str]]) -> Iterator[tuple[str, str, str]]:
    """(initial, role, text) of the repaired messages."""
    state = NONE
    for op in audit:
        if op == "I":
            state = _DUE[state]
            yield op, _ROLE[state], ""
            continue
        role, text = next(rows)
        if op == "K":
            state = _KEEP[role[0]][state]
            yield op, role, text
        elif op == "R":
            state = _DUE[state]
            yield op, _ROLE[state], text


def _walk(batches: Iterator[pd.DataFrame], emit) -> Iterator[pd.DataFrame]:
    """Conversations in a stream of sorted rows: its head, then its blocks, then
    its messages. ``emit`` gets (g, gaps, judged blocks, messages); the messages
    must be read to the end. Only one batch is held."""
    def stream():
        for batch in batches:
            yield from batch.itertuples(index=False, name=None)

    source = stream()
    row = next(source, None)
    out: list = []
    while row is not None:
        g, _, gaps, _, _ = row
        row = next(source, None)
        judged = []
        while row is not None and row[0] == g and row[1] == 1:
            judged.append(json.loads(row[4]))
            row = next(source, None)

        def messages():
            nonlocal row
            while row is not None and row[0] == g:
                yield row[3], row[4]
                row = next(source, None)

        for item in emit(g, gaps, judged, messages()):
            out.append(item)
            if len(out) >= 1000:
                yield out
                out = []
    if out:
        yield out


def _report(g, gaps, judged, messages):
    """One row per conversation."""
    blank = duplicate = truncated = illegal = 0
    previous = ""
    for b in judged:
        blank, duplicate, truncated = blank + b[0], duplicate + b[1], truncated + b[2]
        illegal += b[3] + (previous != "" and previous + b[4] not in _LEGAL)
        previous = b[5]
    cost, audit = chain(map(lambda b: map(tuple, b[6]), judged))
    digest, sep = hashlib.sha256(), ""
    for _, role, text in _edited(audit, messages):
        digest.update(f"{sep}{role}:{text}".encode())
        sep = "\n"
    for _ in messages:
        pass
    yield (g, int(gaps), blank, duplicate, truncated, illegal, cost, audit, digest.hexdigest())


def _messages(g, gaps, judged, messages):
    """The repaired messages of a conversation, numbered from 0."""
    _, audit = chain(map(lambda b: map(tuple, b[6]), judged))
    for i, (op, role, text) in enumerate(_edited(audit, messages)):
        yield g, i, op, role, text
    for _ in messages:
        pass


_REPORT = ("g string, gaps long, blank long, duplicate long, truncated long, illegal long, "
           "cost long, audit string, repaired_sha256 string")
_MESSAGES = "g string, position long, edit string, role string, text string"


def _run(rows: DataFrame, ids: DataFrame, emit, schema: str) -> DataFrame:
    rows = rows.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        *[F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")])
    bound_batches(rows.sparkSession)
    turn = F.col("turn")
    spread = (F.max(turn) - F.min(turn) + 1 - F.countDistinct(turn)).cast("long")
    no_key, none = F.lit(None).cast("binary"), F.lit(None).cast("string")
    gaps = rows.groupBy(_group().alias("g")).agg(F.coalesce(spread, F.lit(0)).alias("gaps"))
    blank_gap = F.lit(0).cast("long")
    heads = (ids.select(F.col("conv_id").cast("long").alias("conv_id"))
             .select(_group().alias("g"), blank_gap.alias("gaps")).unionByName(gaps)
             .groupBy("g").agg(F.max("gaps").alias("gaps")))
    parts = [
        heads.select("g", F.lit(0).alias("kind"), "gaps", F.lit(None).cast("long").alias("at"),
                     no_key.alias("key"), none.alias("role"), none.alias("text")),
        _blocks(rows).select("g", F.lit(1).alias("kind"), blank_gap.alias("gaps"), "at",
                             no_key.alias("key"), none.alias("role"), "text"),
        rows.select(_group().alias("g"), F.lit(2).alias("kind"), blank_gap.alias("gaps"),
                    turn.alias("at"), _key().alias("key"), "role", "text")]
    whole = parts[0].unionByName(parts[1]).unionByName(parts[2])
    whole = whole.repartition("g").sortWithinPartitions("g", "kind", F.asc_nulls_first("at"), "key")
    names = [x.split()[0] for x in schema.split(", ")]

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for some in _walk(batches, emit):
            yield pd.DataFrame(some, columns=names)

    out = whole.select("g", "kind", "gaps", "role", "text").mapInPandas(work, schema)
    conv = F.nullif(F.substring("g", 2, 40), F.lit("")).cast("long")
    return out.select(conv.alias("conv_id"), *names[1:])


def repair(rows: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """One row per conversation: conv_id, gaps, blank, duplicate, truncated,
    illegal, cost, audit, repaired_sha256.

    ``rows`` (conv_id, turn, role, text; other columns are ignored) are taken by
    turn, null first; rows of one turn go by the digest of role and text. Null
    roles and texts are one space; a null conv_id is a conversation of its own.
    An empty role has no initial and is never kept. Texts of any length are read
    whole; an empty table gives an empty result. ``ids`` (conv_id) names
    conversations that appear even without rows, with zeros and an empty audit.

    Only the digest of the repaired text reads a conversation in one task, as a
    stream: sha256 cannot be computed in parts.
    """
    return _run(rows, rows.select("conv_id") if ids is None else ids, _report, _REPORT)


def repaired(rows: DataFrame) -> DataFrame:
    """The repaired messages: conv_id, position, edit, role, text; rows and
    nulls as in ``repair``."""
    return _run(rows, rows.select("conv_id"), _messages, _MESSAGES)
