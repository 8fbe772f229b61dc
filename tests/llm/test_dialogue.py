"""Conversation repair against full enumeration, a column-by-column table and a
plain loop over edge rows; conversations of several blocks."""

import hashlib
import itertools
import random
import re
import zlib

from quartier.llm import dialogue

PATTERN = re.compile(r"(s?(ua)+)?")


def _table(rows, start=0):
    """Cheapest (cost, audit) by plain dynamic programming over columns."""
    due = {0: 2, 1: 2, 2: 3, 3: 2}
    keep = {("s", 0): 1, ("u", 0): 2, ("u", 1): 2, ("u", 3): 2, ("a", 2): 3}

    def inserts(now):
        for _ in range(4):
            for p, (c, a) in list(now.items()):
                new = (c + 2, a + "I")
                if due[p] not in now or new < now[due[p]]:
                    now[due[p]] = new
        return now

    now = inserts({start: (0, "")})
    for r in rows:
        new = {}

        def put(q, c, a):
            if q not in new or (c, a) < new[q]:
                new[q] = (c, a)
        for p, (c, a) in now.items():
            put(p, c + 3, a + "D")
            if r != "d":
                x = 1 if r.isupper() else 0
                if (r.lower(), p) in keep:
                    put(keep[r.lower(), p], c + x, a + "K")
                put(due[p], c + 2 + x, a + "R")
        now = inserts(new)
    return min(now[p] for p in (0, 3) if p in now)


def test_search_against_every_edit_script():
    """All scripts with up to two inserts at each place, replayed on the roles."""
    for rows in ["", "a", "s", "us", "aU", "dS", "xau", "sSd", "uu"]:
        best = (99, "")
        spots = [["", "I", "II"]] * (len(rows) + 1)
        for ops in itertools.product("KRD", repeat=len(rows)):
            if any(r == "d" and o != "D" for r, o in zip(rows, ops)):
                continue
            for ins in itertools.product(*spots):
                audit = ins[0] + "".join(o + i for o, i in zip(ops, ins[1:]))
                for named in itertools.product("ua", repeat=sum(o in "RI" for o in audit)):
                    fill, it, cost, out = iter(named), iter(rows), 0, ""
                    for o in audit:
                        r = next(it) if o != "I" else ""
                        cost += {"K": 0, "R": 2, "D": 3, "I": 2}[o]
                        cost += o in "KR" and r.isupper()
                        out += "" if o == "D" else r.lower() if o == "K" else next(fill)
                    if PATTERN.fullmatch(out):
                        best = min(best, (cost, audit))
        assert dialogue.search(rows, dialogue.NONE, dialogue.GOALS, True) == best, rows


def test_search_and_blocks_against_the_table():
    r = random.Random(4)
    for _ in range(1500):
        rows = "".join(r.choice("uuaasUASxXd") for _ in range(r.randrange(1, 14)))
        want = _table(rows)
        assert dialogue.search(rows, dialogue.NONE, dialogue.GOALS, True) == want, rows
        for size in (1, 2, 5):
            cuts = range(0, len(rows), size)
            blocks = [dialogue.moves(rows[i:i + size], i == 0, i + size >= len(rows)) for i in cuts]
            assert dialogue.chain(iter(blocks)) == want, (rows, size)


def test_long_block():
    rows = "ua" * 100 + "uuadxS" * 9
    assert dialogue.search(rows, dialogue.NONE, dialogue.GOALS, True) == _table(rows)


def _damaged(rows):
    out = []
    for c, t, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        k = zlib.crc32(":".join(" " if x is None else str(x) for x in (c, t)).encode()) % 20
        if k == 0:
            continue
        if k == 1:
            text = ""
        if k == 2:
            text = re.sub("[.!?]", "", text)
        if k == 4:
            role = "user"
        out += [(c, t, role, text)] * (2 if k == 3 else 1)
    return out


def _key(role, text):
    return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()


def _plain(ids, rows):
    out = []
    for conv in ids:
        mine = sorted([r for r in rows if r[0] == conv],
                      key=lambda r: (r[1] is not None, r[1] or 0, _key(r[2], r[3])))
        turns = {r[1] for r in mine if r[1] is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        seen, codes, faults = set(), "", [0, 0, 0]
        for _, _, role, text in mine:
            body = text.rstrip(" \t\n\x0b\x0c\r")
            c = role[:1] if role[:1] in ("s", "u", "a") else "x"
            if not body:
                faults[0] += 1
                c = "d"
            elif (role, text) in seen:
                faults[1] += 1
                c = "d"
            elif body[-1] not in ".!?":
                faults[2] += 1
                c = c.upper()
            seen.add((role, text))
            codes += c
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(mine, mine[1:]))
        cost, audit = _table(codes) if mine else (0, "")
        messages, it, last = [], iter(mine), "a"
        for o in audit:
            row = next(it) if o != "I" else None
            if o == "D":
                continue
            due = "user" if last != "u" else "assistant"
            role, text = (row[2], row[3]) if o == "K" else (due, row[3] if row else "")
            messages.append(f"{role}:{text}")
            last = role[0]
        out.append((conv, gaps, *faults, illegal, cost, audit,
                    hashlib.sha256("\n".join(messages).encode()).hexdigest()))
    return sorted(out, key=str)


def _got(spark, rows, schema="conv_id long, turn long, role string, text string"):
    df = spark.createDataFrame(rows, schema)
    return sorted(map(tuple, dialogue.repair(dialogue.damage(df), df.select("conv_id")).collect()),
                  key=str)


def test_edge_rows(spark):
    rows = [(1, 1, "user", "Hi."), (1, 2, "assistant", "Yes."), (1, 2, "assistant", "Yes."),
            (1, 2, "assistant", "No"), (1, None, "system", "S."), (1, None, None, None),
            (None, None, None, None), (None, 3, "user", "a\x0b."), (2, 9, "", "x."),
            (2, 10, "tool", "y!"), (2, 10, "sam", "z?"), (3, -5, "user", ""),
            (3, 7, "user", " \t\n\x0b\f\r"), (4, 1, "user", "long " * 60_000 + "."),
            (4, 2, "assistant", "é."), (5, None, "user", "u."), (5, None, "assistant", "u.")]
    rows += [(6, i, "user" if i % 2 else "assistant", f"t{i}.") for i in range(60)]
    want = _plain({r[0] for r in rows}, _damaged(rows))
    assert _got(spark, rows) == want
    assert _got(spark, []) == []
    clash = [(*r, 1, "k", 2) for r in rows]
    assert _got(spark, clash, "conv_id long, turn long, role string, text string, idx int, "
                              "g string, size int") == want
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    dropped = [r for r in rows if r not in _damaged(rows)]
    assert dropped
    out = dialogue.repaired(dialogue.damage(df)).collect()
    for conv in {r["conv_id"] for r in out}:
        mine = sorted((r for r in out if r["conv_id"] == conv), key=lambda r: r["position"])
        assert PATTERN.fullmatch("".join(r["role"][0] for r in mine))
        assert [r["position"] for r in mine] == list(range(len(mine)))


def test_conversation_of_many_blocks(spark):
    """One conversation holds most rows; copies of one message lie in all blocks."""
    r = random.Random(8)
    rows = [(1, i, r.choice(["user", "assistant", "assistant", "system", "x"]),
             r.choice(["Same.", f"m{i}.", f"m{i}", "", f"m{i // 2}!"])) for i in range(1500)]
    rows += [(2 + i % 40, i // 40, "user" if (i // 40) % 2 == 0 else "assistant", f"n{i}.")
             for i in range(200)]
    assert len(_damaged(rows)) > 5 * dialogue.BLOCK
    assert _got(spark, rows) == _plain({x[0] for x in rows}, _damaged(rows))
