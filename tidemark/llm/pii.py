"""Personal data: pattern base plus candidates ranked by gradient boosting.

Base: the leftmost non-overlapping matches of one pattern a kind that pass a
check (number range, Luhn, digit count). They always stay.

Candidates: looser generators propose overlapping spans. Each span gets format
and context features in a few bins (never the base's own check). Boosted trees
of depth two learn which candidates look like base spans: one pass counts all
candidates of all documents by feature bins, so the fit sees a table whose size
is bounded by the bins, not by the corpus. Half of the documents (by a hash)
calibrate a threshold a kind: the least score at which ``PRECISION`` of the
candidates above it are base spans. Candidates above it that no base span of
their kind touches are added. Trees run as CASE expressions.

DataFrame functions only; documents are never shuffled. Patterns are written
without backtracking over long runs (possessive, anchored at run starts), so
long texts cost linear time.

Defined cases: null text counts as empty (redaction leaves null); repeated rows
are reported as often as they occur; null ``doc_id`` is carried along; without
candidates nothing is added; an empty table gives an empty result; other
columns are ignored (redaction returns them).
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import body

KINDS = ["email", "ip", "card", "phone"]
PRECISION = 0.9
ROUNDS, SHRINK = 16, 0.4
CONTEXT = 16  # characters before a span that are looked at

_LOCAL = "[A-Za-z0-9._%+-]"
BASE = [
    rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    r"[0-9](?:[\x20-]?[0-9])++",
    r"\+[0-9][\x20().0-9-]+[0-9]",
]
# generators: kind, what a text must contain, pattern
GENERATORS = [
    (0, "@", rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++\x20?@\x20?[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)*+"),
    (0, "dot", rf"(?<!{_LOCAL}){_LOCAL}{{1,64}}+\x20?[\[(]?at[\])]?\x20?[A-Za-z0-9-]{{1,64}}+\x20?[\[(]?dot[\])]?\x20?[A-Za-z0-9-]{{2,24}}+"),
    (1, ".", r"(?<![0-9.])[0-9]{1,4}+(?:[.,][0-9]{1,4}+){3}(?![0-9])"),
    (1, ":", r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}+::?){3,7}+[0-9A-Fa-f]{1,4}+(?![0-9A-Fa-f:])"),
    (2, "", r"(?<![0-9])[0-9]{4}(?:[\x20./-]?[0-9]{4}){2,3}+[0-9]{0,3}+(?![0-9])"),
    (3, "+", r"\+[0-9][\x20().0-9-]{6,24}[0-9](?![0-9])"),
    (3, "", r"(?<![0-9+])\(?[0-9]{2,4}+\)?[\x20./-][0-9]{2,4}+[\x20./-][0-9]{3,5}+(?![0-9])"),
]
WORDS = {  # context words a kind
    0: "mail|contact|write|send", 1: "ip|host|server|address|addr", 2: "card|visa|credit|account|pay", 3: "phone|call|tel|mobile|fax|contact",
}
_SPAN = "array<struct<s:int,e:int,m:string>>"
FEATURES = ["gen", "digits", "seps", "size", "plus", "word", "prev", "next"]


def matches(text: Column, pattern: str, must: Column | None = None) -> Column:
    """Matches of ``pattern`` as ``array<struct<s, e, m>>``: code points, end
    exclusive. What lies between matches comes from ``split``."""
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(hits))
    steps = F.zip_with(gaps, hits, lambda g, m: F.struct(F.length(g).alias("g"), m.alias("m")))
    zero = F.struct(F.lit(0).alias("at"), F.array().cast(_SPAN).alias("spans"))

    def add(acc, x):
        s = acc["at"] + x["g"]
        e = s + F.length(x["m"])
        return F.struct(e.alias("at"), F.concat(acc["spans"], F.array(F.struct(s.alias("s"), e.alias("e"), x["m"].alias("m")))).alias("spans"))

    found = F.aggregate(steps, zero, add, lambda acc: acc["spans"])
    return found if must is None else F.when(must, found).otherwise(F.array().cast(_SPAN))


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """The digits from the right: every second doubled, digit sums added, total a multiple of ten."""
    one = F.split(F.reverse(digits), "")
    value = F.transform(F.filter(one, lambda d: d != ""), lambda d, i: F.when(
        i % 2 == 1, d.cast("int") * 2 - F.when(d.cast("int") > 4, 9).otherwise(0)).otherwise(d.cast("int")))
    return F.aggregate(value, F.lit(0), lambda a, x: a + x) % 10 == 0


def _passes(kind: int, m: Column) -> Column:
    if kind == 1:
        return F.forall(F.split(m, r"\."), lambda p: (F.length(F.ltrim(p, F.lit("0"))) <= 3)
                        & (F.coalesce(F.substring(F.ltrim(p, F.lit("0")), 1, 3).try_cast("int"), F.lit(0)) <= 255))
    if kind == 2:
        return F.length(_digits(m)).between(16, 19) & _luhn(F.substring(_digits(m), 1, 19))
    if kind == 3:
        return F.length(_digits(m)).between(8, 15)
    return F.lit(True)


def base_spans(text: Column, kind: int) -> Column:
    must = F.contains(text, F.lit("@")) if kind == 0 else F.contains(text, F.lit("+")) if kind == 3 else text.rlike("[0-9]")
    found = matches(text, BASE[kind], must)
    return found if kind == 0 else F.filter(found, lambda x: _passes(kind, x["m"]))


def _letter_class(c: Column) -> Column:
    return F.when(c == "", 0).when(c.rlike(r"^[\s]$"), 1).when(c.rlike(r"^[\p{L}\p{N}]$"), 2).otherwise(3)


def candidates(text: Column, base: list[Column]) -> Column:
    """Spans of all generators with ``kind``, ``label`` (a base span of the kind
    touches it) and the feature bins."""
    def describe(g, kind):
        def described(x):
            digits, length = F.length(_digits(x["m"])), F.length(x["m"])
            before = F.lower(F.substr(text, F.greatest(x["s"] + 1 - CONTEXT, F.lit(1)), F.least(x["s"], F.lit(CONTEXT))))
            return F.struct(
                F.lit(kind).alias("kind"), x["s"].alias("s"), x["e"].alias("e"),
                F.exists(base[kind], lambda b: (b["s"] < x["e"]) & (b["e"] > x["s"])).alias("label"),
                F.lit(g).alias("gen"),
                F.when(digits < 8, 0).when(digits < 13, 1).when(digits < 16, 2).when(digits == 16, 3).otherwise(4).alias("digits"),
                F.least(F.length(F.regexp_replace(x["m"], r"[^\x20./():,-]", "")), F.lit(4)).alias("seps"),
                F.when(length < 10, 0).when(length < 17, 1).when(length < 24, 2).otherwise(3).alias("size"),
                F.when(F.startswith(x["m"], F.lit("+")), 1).otherwise(0).alias("plus"),
                F.when(before.rlike(WORDS[kind]), 1).otherwise(0).alias("word"),
                _letter_class(F.when(x["s"] > 0, F.substr(text, x["s"], F.lit(1))).otherwise("")).alias("prev"),
                _letter_class(F.substr(text, x["e"] + 1, F.lit(1))).alias("next"))

        return described

    need = [F.contains(text, F.lit(must)) if must else text.rlike("[0-9]{3}") for _, must, _ in GENERATORS]
    return F.concat(*[F.transform(matches(text, pattern, need[g]), describe(g, kind)) for g, (kind, _, pattern) in enumerate(GENERATORS)])


class Trees:
    """Boosted trees of depth two on binned features, as a score expression."""

    def __init__(self, start: float, trees: list, thresholds: dict[int, float]):
        self.start, self.trees, self.thresholds = start, trees, thresholds

    def value(self, get) -> float:
        z = self.start
        for f, t, left, right in self.trees:
            g, u, a, b = left if get(f) <= t else right
            z += a if get(g) <= u else b
        return z

    def margin(self, x: Column) -> Column:
        def leaf(side):
            g, u, a, b = side
            return F.when(x[g] <= u, F.lit(a)).otherwise(F.lit(b))

        terms = [F.when(x[f] <= t, leaf(left)).otherwise(leaf(right)) for f, t, left, right in self.trees]
        return reduce(lambda p, q: p + q, terms, F.lit(self.start))

    def accepted(self, x: Column) -> Column:
        """The kind's threshold is met."""
        at = reduce(lambda p, kv: F.when(x["kind"] == kv[0], F.lit(kv[1])).otherwise(p), self.thresholds.items(), F.lit(math.inf))
        return self.margin(x) >= at


def _boost(cells: list[tuple[dict, float, float]]) -> tuple[float, list]:
    """Newton boosting on weighted cells: (features, positives, negatives)."""
    pos, neg = sum(c[1] for c in cells), sum(c[2] for c in cells)
    start = math.log((pos + 1) / (neg + 1))
    z = [start] * len(cells)
    trees = []

    def best(rows, grad, hess):
        """The split of these rows with the highest gain: feature, bin, leaf values."""
        found = (0.0, FEATURES[0], 10**6, 0.0, 0.0)
        g, h = sum(grad[i] for i in rows), sum(hess[i] for i in rows)
        found = (0.0, FEATURES[0], 10**6, SHRINK * g / (h + 1), 0.0)
        for f in FEATURES:
            by: dict[int, list[float]] = {}
            for i in rows:
                x = by.setdefault(cells[i][0][f], [0.0, 0.0])
                x[0] += grad[i]
                x[1] += hess[i]
            gl = hl = 0.0
            for t in sorted(by)[:-1]:
                gl, hl = gl + by[t][0], hl + by[t][1]
                gain = gl * gl / (hl + 1) + (g - gl) ** 2 / (h - hl + 1) - g * g / (h + 1)
                if gain > found[0] + 1e-9:
                    found = (gain, f, t, SHRINK * gl / (hl + 1), SHRINK * (g - gl) / (h - hl + 1))
        return found

    for _ in range(ROUNDS):
        p = [1 / (1 + math.exp(-max(-30, min(30, v)))) for v in z]
        grad = [c[1] - q * (c[1] + c[2]) for c, q in zip(cells, p)]
        hess = [q * (1 - q) * (c[1] + c[2]) for c, q in zip(cells, p)]
        _, f, t, _, _ = best(range(len(cells)), grad, hess)
        sides = []
        for rows in ([i for i, c in enumerate(cells) if c[0][f] <= t], [i for i, c in enumerate(cells) if c[0][f] > t]):
            _, g, u, a, b = best(rows, grad, hess)
            sides.append((g, u, a, b))
            for i in rows:
                z[i] += a if cells[i][0][g] <= u else b
        trees.append((f, t, *sides))
    return start, trees


def fit(docs: DataFrame) -> Trees:
    """Trees and thresholds from the candidates of all documents, counted by bins."""
    text = docs.select(body().alias("text"))
    text = text.select("text", F.pmod(F.xxhash64("text"), F.lit(2)).alias("half"), *[base_spans(F.col("text"), k).alias(f"b{k}") for k in range(4)])
    cand = text.select("half", F.explode(candidates(F.col("text"), [F.col(f"b{k}") for k in range(4)])).alias("c")).select("half", "c.*")
    # bounded: at most the product of the bins, whatever the corpus
    cells = cand.groupBy("half", "kind", *FEATURES).agg(F.sum(F.col("label").cast("long")).alias("pos"), F.count(F.lit(1)).alias("n")).collect()
    rows = [(r["half"], r["kind"], {f: r[f] for f in FEATURES}, float(r["pos"]), float(r["n"] - r["pos"])) for r in cells]
    rows.sort(key=lambda r: (r[0], r[1], tuple(r[2].values())))
    start, trees = _boost([r[2:] for r in rows if r[0] == 0])
    model = Trees(start, trees, {})
    for kind in range(len(KINDS)):
        pos = neg = 0.0
        by: dict[float, list[float]] = {}
        for half, k, x, p, n in rows:
            if half == 1 and k == kind:
                v = by.setdefault(round(model.value(x.__getitem__), 9), [0.0, 0.0])
                v[0] += p
                v[1] += n
        for v in sorted(by, reverse=True):
            pos, neg = pos + by[v][0], neg + by[v][1]
            if pos >= PRECISION * (pos + neg):
                model.thresholds[kind] = v - 1e-6
    return model


def with_spans(df: DataFrame, model: Trees, text: Column, prefix: str) -> DataFrame:
    """Adds ``<prefix>b0..3`` (base spans a kind) and ``<prefix>a0..3`` (base and
    added spans a kind): arrays of ``s``, ``e``, ascending. ``prefix`` is free in ``df``."""
    df = df.withColumn(f"{prefix}t", text)
    t = F.col(f"{prefix}t")
    df = df.select("*", *[base_spans(t, k).alias(f"{prefix}b{k}") for k in range(4)])
    base = [F.col(f"{prefix}b{k}") for k in range(4)]
    more = F.filter(candidates(t, base), lambda x: ~x["label"] & model.accepted(x))
    df = df.withColumn(f"{prefix}c", more)

    def both(k):
        added = F.transform(F.filter(F.col(f"{prefix}c"), lambda x: x["kind"] == k), lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e")))
        return F.array_sort(F.array_distinct(F.concat(F.transform(base[k], lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"))), added)))

    return df.select("*", *[both(k).alias(f"{prefix}a{k}") for k in range(4)])


def _listed(columns: list[Column]) -> Column:
    """kind:start:end of all spans, joined by commas."""
    def named(kind):
        return lambda x: F.concat_ws(":", F.lit(kind), x["s"], x["e"])

    return F.array_join(F.concat(*[F.transform(c, named(kind)) for kind, c in zip(KINDS, columns)]), ",")


def find_pii(docs: DataFrame, model: Trees | None = None) -> DataFrame:
    """One row per document: ``doc_id``, counts and hash of the base spans, all ``spans``."""
    model = model or fit(docs)
    got = with_spans(docs.select("doc_id", "text"), model, body(), "_")
    return got.select("doc_id", *[F.size(f"_b{k}").cast("long").alias(f"n_{KINDS[k]}") for k in range(4)],
                      F.sha2(_listed([F.col(f"_b{k}") for k in range(4)]), 256).alias("base_sha256"),
                      _listed([F.col(f"_a{k}") for k in range(4)]).alias("spans"))


def redact(docs: DataFrame, model: Trees | None = None) -> DataFrame:
    """``docs`` with every span in ``text`` replaced by its kind in brackets;
    spans that touch merge and take the first one's kind."""
    model = model or fit(docs)
    p = "_pii"
    while any(c.lower().startswith(p) for c in docs.columns):
        p += "_"
    got = with_spans(docs, model, body(), p)
    t = F.col(f"{p}t")

    def of_kind(k):
        return lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), F.lit(k).alias("k"))

    spans = F.array_sort(F.concat(*[F.transform(F.col(f"{p}a{k}"), of_kind(k)) for k in range(4)]))
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))

    def step(acc, x):
        """Text up to the span and the span's mark; a span inside the last one adds nothing, one that runs on extends it."""
        fresh = x["s"] >= acc["at"]
        mark = F.element_at(F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS]), x["k"] + 1)
        piece = F.when(fresh, F.concat(F.substr(t, acc["at"] + 1, F.greatest(x["s"] - acc["at"], F.lit(0))), mark)).otherwise("")
        return F.struct(F.greatest(x["e"], acc["at"]).alias("at"), F.concat(acc["out"], F.array(piece)).alias("out"))

    whole = F.aggregate(spans, zero, step, lambda acc: F.concat(F.array_join(acc["out"], ""), F.substr(t, acc["at"] + 1, F.length(t))))
    none = F.size(spans) == 0
    new = F.when(F.col("text").isNull() | none, F.col("text")).otherwise(whole)
    return got.select(*[(new.alias("text") if c == "text" else F.col(c)) for c in docs.columns])
