"""Conversation structure repair by depth-first branch-and-bound.

``damage`` corrupts rows by a hash of their key; ``repair`` finds, for every
conversation, the cheapest edits after which the initials of its roles match
``(s?(ua)+)?``. Edits: Keep (0), Rerole to user or assistant (1), Delete (2),
Insert an empty user or assistant row (5); a truncated row that stays costs 5
more; blank and duplicate rows must go. Of equally cheap repairs the one whose
audit (the edits' initials in order) is least in ASCII order is taken.

The search sees one letter a row (role initial and fault), never a text:
depth first with an explicit stack, edits tried in ASCII order. ``_rest`` gives
a lower bound of what each suffix costs (the same problem with any end); a greedy dive along that bound gives the first
incumbent; a table a node (row, grammar state) keeps the least cost with which
the node was reached. Prefixes are visited in audit order and two prefixes of
one node and cost are never prefixes of each other (the longer one would hold
more inserts), so a later prefix of no lower cost is worse under every suffix
and is dropped. An empty stack proves the incumbent.

Spark spreads the rows: duplicates are numbered by (conversation, role, text),
so a large conversation is spread there; one row a conversation is then built,
as its audit and its hash are one value each by definition. Equal letter
strings are solved once a batch.

Defined cases: null role or text counts as one space, a null id or turn as one
space in the damage key; null ids are one conversation; null turns come first;
rows of equal turn go by role, then text, after damage (repeated rows are then
duplicates); roles count by their first character, case-sensitive, an empty
role fits nothing; a conversation without rows after damage gives zeros, an
empty audit and the hash of an empty string; an empty table an empty result;
other columns are ignored.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from tidemark.session import ship_package

# fixed values: edit costs, grammar over role initials
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
START, SYSTEM, USER, ASSISTANT = range(4)  # grammar states: nothing yet, after s, after u, after a
STEP = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
NEEDED = {START: "u", SYSTEM: "u", USER: "a", ASSISTANT: "u"}  # the role that may be inserted or given in a state
PLACE = {START: 0, SYSTEM: 1, ASSISTANT: 1, USER: 2}  # of a state in the bound
ENDS = (START, ASSISTANT)
MUST_GO = "d"  # letter of a blank or duplicate row; others: s u a x, upper case if truncated
ROLES = {"u": "user", "a": "assistant"}
BLANK = " \t\n\x0b\x0c\r"

EDIT = StructType([StructField("row", IntegerType()), StructField("role", StringType())])
SOLUTION = StructType([StructField("cost", LongType()), StructField("audit", StringType()), StructField("kept", ArrayType(EDIT))])


def _rest(letters: str) -> list[tuple[int, int, int]]:
    """Lower bound of the cost of each suffix: if nothing is kept yet, if a user
    row comes next, if an assistant row comes next. Any end is allowed."""
    rest = [(0, 0, 0)]
    for c in reversed(letters):
        z, u, a = rest[-1]
        at_z, at_u, at_a = DELETE + z, DELETE + u, DELETE + a
        if c != MUST_GO:
            extra, own = (TRUNCATED if c.isupper() else 0), c.lower()
            as_user, as_assistant = extra + (KEEP if own == "u" else REROLE) + a, extra + (KEEP if own == "a" else REROLE) + u
            at_z = min(at_z, as_user, extra + KEEP + u if own == "s" else as_user)
            at_u, at_a = min(at_u, as_user), min(at_a, as_assistant)
        rest.append((min(at_z, INSERT + at_a), min(at_u, INSERT + at_a), min(at_a, INSERT + at_u)))
    rest.reverse()
    return rest


def _edits(letters: str, row: int, state: int):
    """(initial, cost, next row, next state, role of the row it leaves, if any) in ASCII order of the initials."""
    out = []
    need = NEEDED[state]
    if row < len(letters):
        c = letters[row]
        out.append(("D", DELETE, row + 1, state, None))
        out.append(("I", INSERT, row, STEP[state, need], need))
        if c != MUST_GO:
            extra, own = (TRUNCATED if c.isupper() else 0), c.lower()
            if (state, own) in STEP:
                out.append(("K", KEEP + extra, row + 1, STEP[state, own], own))
            out.append(("R", REROLE + extra, row + 1, STEP[state, need], need))
    else:
        out.append(("I", INSERT, row, STEP[state, need], need))
    return out


def solve(letters: str) -> tuple[int, str, list[tuple[int, str | None]]]:
    """Least cost, its ASCII-least audit, and the rows it leaves: (row or -1 if
    inserted, role if it is not the row's own)."""
    rest = _rest(letters)

    def bound(row, state):
        return rest[row][PLACE[state]]

    # nodes of the search: parent, initial, row and state after the edit, cost so far
    parent, initial, rows, states, costs = [-1], [""], [0], [START], [0]

    def add(node, edit):
        parent.append(node)
        initial.append(edit[0])
        rows.append(edit[2])
        states.append(edit[3])
        costs.append(costs[node] + edit[1])
        return len(parent) - 1

    # first incumbent: a greedy dive along the bound
    row, state, cost = 0, START, 0
    while row < len(letters) or state not in ENDS:
        edits = _edits(letters, row, state)
        e = min(edits, key=lambda x: (x[1] + bound(x[2], x[3]), x[2] == row))
        row, state, cost = e[2], e[3], cost + e[1]
    best, leaf = cost, -1  # the dive bounds the cost; its audit is not compared, as the search meets the least one

    reached: dict[tuple[int, int], int] = {}
    stack = [0]
    while stack:
        node = stack.pop()
        row, state, cost = rows[node], states[node], costs[node]
        low = cost + bound(row, state)
        if low > best or (leaf >= 0 and low == best):
            continue
        if reached.get((row, state), cost + 1) <= cost:
            continue
        reached[row, state] = cost
        if row == len(letters) and state in ENDS and (cost < best or leaf < 0):
            best, leaf = cost, node
            continue  # an insert after a full repair costs more
        children = [add(node, e) for e in _edits(letters, row, state)
                    if cost + e[1] + bound(e[2], e[3]) <= best]
        stack.extend(reversed(children))

    path = []
    while leaf > 0:
        path.append(leaf)
        leaf = parent[leaf]
    path.reverse()
    audit = "".join(initial[n] for n in path)
    kept: list[tuple[int, str | None]] = []
    before, state = 0, START
    for n in path:
        if initial[n] == "K":
            kept.append((before, None))
        elif initial[n] in "RI":
            kept.append((before if initial[n] == "R" else -1, ROLES[NEEDED[state]]))
        before, state = rows[n], states[n]
    return best, audit, kept


def damage(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and ``times``, how often the row occurs after
    damage (0: dropped). Nulls of role and text become one space."""
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"),
                   F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    rows = conversations.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"),
                                F.coalesce("text", F.lit(" ")).alias("text"), (F.crc32(key.cast("binary")) % 20).alias("how"))
    return rows.select(
        "conv_id", "turn", F.when(F.col("how") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("how") == 1, "").when(F.col("how") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        F.when(F.col("how") == 0, 0).when(F.col("how") == 3, 2).otherwise(1).alias("times"))


def _letter(role: Column, fault: Column) -> Column:
    own = F.when(F.substring(role, 1, 1).isin("s", "u", "a"), F.substring(role, 1, 1)).otherwise("x")
    return F.when(fault.isin("blank", "duplicate"), MUST_GO).when(fault == "truncated", F.upper(own)).otherwise(own)


def repair(rows: DataFrame) -> DataFrame:
    """Faults, cheapest repair and hash of each conversation of ``rows`` (conv_id, turn, role, text, times)."""
    ship_package(rows.sparkSession)
    each = rows.select("conv_id", "turn", "role", "text", "times",
                       F.explode(F.sequence(F.lit(1), F.greatest("times", F.lit(1)))).alias("copy"))
    same = Window.partitionBy("conv_id", "role", "text", F.col("times") > 0).orderBy(F.col("turn").asc_nulls_first(), "copy")
    body = F.rtrim("text", F.lit(BLANK))
    fault = (F.when(body == "", "blank").when(F.col("nth") > 1, "duplicate")
             .when(~F.substring(body, -1, 1).isin(".", "!", "?"), "truncated").otherwise("none"))
    each = each.withColumn("nth", F.row_number().over(same)).withColumn("fault", fault)
    row = F.struct("turn", "role", "text", "nth", _letter(F.col("role"), F.col("fault")).alias("letter"))
    here = F.col("times") > 0

    def many(name):
        return F.count(F.when(here & (F.col("fault") == name), 1)).alias(name)

    turns = F.array_distinct(F.transform("rows", lambda r: r["turn"]))
    turns = F.filter(turns, lambda t: t.isNotNull())
    role = F.transform("rows", lambda r: F.substring(r["role"], 1, 1))
    grouped = (each.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.when(here, row))).alias("rows"), many("blank"), many("duplicate"), many("truncated"))
               .withColumn("turns", turns).withColumn("initials", role))
    illegal = F.size(F.filter(F.sequence(F.lit(1), F.size("initials")), lambda i: (i > 1) & ~F.concat(
        F.get("initials", i - 2), F.get("initials", i - 1)).isin("su", "ua", "au")))
    gaps = F.when(F.size("turns") > 0, F.array_max("turns") - F.array_min("turns") + 1 - F.size("turns")).otherwise(0)

    @F.pandas_udf(SOLUTION)
    def search(letters: pd.Series) -> pd.DataFrame:
        known = {s: solve(s) for s in letters.unique()}
        return pd.DataFrame([(c, a, [{"row": r, "role": role} for r, role in k]) for c, a, k in (known[s] for s in letters)],
                            columns=["cost", "audit", "kept"])

    solved = grouped.withColumn("found", search(F.array_join(F.transform("rows", lambda r: r["letter"]), "")))
    lines = F.transform("found.kept", lambda e: F.when(e["row"] < 0, F.concat(e["role"], F.lit(":"))).otherwise(F.concat(
        F.coalesce(e["role"], F.get(F.col("rows"), e["row"])["role"]), F.lit(":"), F.get(F.col("rows"), e["row"])["text"])))
    return solved.select("conv_id", gaps.cast("long").alias("gaps"), "blank", "duplicate", "truncated",
                         illegal.cast("long").alias("illegal"), F.col("found.cost").alias("cost"), F.col("found.audit").alias("audit"),
                         F.array_join(lines, "\n").alias("repaired"))
