"""Conversation repair against exhaustive edits."""

import hashlib
import itertools
import random
import re
import zlib

from tidemark.llm import conversation_repair as CR

SCHEMA = "conv_id long, turn long, role string, text string, rank int, rows int, letter string"


def cheapest(letters):
    """Least (cost, audit, kept) over all edits with up to two inserts at a place."""
    grammar, best = re.compile(r"(s?(ua)+)?"), None

    def go(i, cost, audit, initials, kept):
        nonlocal best
        if best and cost > best[0]:
            return
        for ins in ("", "u", "a", "ua", "au"):
            c, a, s = cost + 5 * len(ins), audit + "I" * len(ins), initials + ins
            k = kept + [(-1, {"u": "user", "a": "assistant"}[x]) for x in ins]
            if i == len(letters):
                if grammar.fullmatch(s) and (best is None or (c, a) < best[:2]):
                    best = (c, a, k)
                continue
            go(i + 1, c + 2, a + "D", s, k)
            if letters[i] != "d":
                x = 5 if letters[i].isupper() else 0
                go(i + 1, c + x, a + "K", s + letters[i].lower(), k + [(i, None)])
                for role in ("user", "assistant"):
                    go(i + 1, c + x + 1, a + "R", s + role[0], k + [(i, role)])

    go(0, 0, "", "", [])
    return best


def brute(rows):
    out = []
    for conv in {r[0] for r in rows}:
        after = []
        for c, t, role, text in rows:
            if c != conv:
                continue
            role, text = (" " if role is None else role), (" " if text is None else text)
            how = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
            if how == 1:
                text = ""
            elif how == 2:
                text = re.sub("[.!?]", "", text)
            elif how == 4:
                role = "user"
            after += [(t is not None, t or 0, role, text)] * {0: 0, 3: 2}.get(how, 1)
        after.sort()
        turns = {t for on, t, _, _ in after if on}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        seen, faults = set(), []
        for _, _, role, text in after:
            body = text.rstrip(" \t\n\x0b\x0c\r")
            faults.append("blank" if not body else "duplicate" if (role, text) in seen else "none" if body[-1] in ".!?" else "truncated")
            seen.add((role, text))
        first = [r[2][:1] for r in after]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(first, first[1:]))
        letters = "".join("d" if f in ("blank", "duplicate") else (x if x and x in "sua" else "x") if f == "none" else (x if x and x in "sua" else "x").upper()
                          for f, x in zip(faults, first))
        cost, audit, kept = cheapest(letters)
        lines = [f"{role or after[i][2]}:{after[i][3] if i >= 0 else ''}" for i, role in kept]
        out.append((conv, gaps, *(faults.count(x) for x in ("blank", "duplicate", "truncated")), illegal, cost, audit,
                    hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=str)


def test_solver_equals_exhaustive_edits():
    for n in range(4):
        for t in itertools.product("dsuaxSUAX", repeat=n):
            assert CR.solve("".join(t)) == cheapest("".join(t))
    r = random.Random(3)
    for _ in range(60):
        t = "".join(r.choice("dsuuaaxSUAX") for _ in range(6))
        assert CR.solve(t) == cheapest(t)


def test_solver_is_linear_on_long_conversations():
    for t in ("ua" * 20_000, "sx" * 20_000, "U" * 40_000, "d" * 40_000):
        cost, audit, kept = CR.solve(t)
        assert len(audit) >= len(t) and cost >= 0


def test_repair_equals_brute_force(spark):
    r = random.Random(5)
    texts = ["a.", "b", "c!", "", " \t", None, "a.", "d?  \n", "é…", "ß. "]
    rows = [(r.choice([*range(70), None]), r.choice([*range(6), None, 10**12, -3]), r.choice(["user", "assistant", "system", "tool", "", None, "User"]), r.choice(texts))
            for _ in range(260)]
    rows += [(500, 5, "user", "only?")] + [(i, 0, "user", "x.") for i in range(1000, 1060)]  # some of them vanish wholly
    rows += rows[:6]
    few = {}
    for x in rows:
        few.setdefault(x[0], []).append(x)
    rows = [x for v in few.values() for x in v[:5]]
    df = spark.createDataFrame([x + (1, 2, "z") for x in rows], SCHEMA).repartition(4)
    out = CR.repair(CR.damage(df))
    got = sorted([tuple(x[:-1]) + (hashlib.sha256(x["repaired"].encode()).hexdigest(),) for x in out.collect()], key=str)
    assert got == brute(rows)


def test_repair_edges(spark):
    assert CR.repair(CR.damage(spark.createDataFrame([], SCHEMA))).count() == 0
    many = spark.range(3000).selectExpr("cast(null as long) conv_id", "cast(null as long) turn", "'user' role", "'t.' text")
    one = CR.repair(CR.damage(many)).collect()
    assert len(one) == 1 and one[0]["duplicate"] == 2999 and one[0]["cost"] <= 2 * 3000 and one[0]["audit"].count("D") >= 2999
    long = spark.createDataFrame([(7, 1, "user", "w " * 200_000 + "."), (7, 2, "assistant", "ok.")], "conv_id long, turn long, role string, text string")
    assert CR.repair(CR.damage(long)).count() == 1
