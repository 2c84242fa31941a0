"""K2-treap search against exhaustive scoring."""

import math
import random
import re
from collections import Counter

import numpy as np

from tidemark.llm import treap_search as TS

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def brute(items, docs, k):
    tf = [(d, Counter(words(t))) for d, t in docs]
    n_docs, total = sum(bool(c) for _, c in tf), sum(c.total() for _, c in tf)
    df = Counter(w for _, c in tf for w in c)
    out = []
    for item, text in items:
        scores = []
        for d, c in tf:
            if not c:
                continue
            m = 50 + 50 * c.total() * n_docs // total
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * (10**9 * c[w] // (1000 * c[w] + 20 * m)) for w in set(words(text)) if w in c)
            if s > 0:
                scores.append((-s, d is None, d or 0))
        out += [(item, i + 1, None if null else d, -s) for i, (s, null, d) in enumerate(sorted(scores)[:k])]
    return sorted(out, key=str)


def test_search_equals_exhaustive_scoring(spark, monkeypatch):
    r = random.Random(11)
    vocabulary = [f"w{i}" for i in range(200)] + ["É", "é", "naïve", "中文", "A", "x_y"]
    weights = [1 / (j + 1) for j in range(len(vocabulary))]

    def text(n):
        return r.choice([" ", ".", "\n"]).join(r.choices(vocabulary, weights, k=n))

    docs = [(i, text(r.randint(0, 50))) for i in range(500)]
    docs += [(600 + i, docs[7][1]) for i in range(30)] + [(None, docs[7][1]), (None, None), (700, None), (701, ""), (702, "..."), (7, docs[7][1]), (703, "W1 " * 5000)]
    items = [(i, text(r.randint(1, 25))) for i in range(12)] + [(3, "w1 w2"), (3, "w1 w2"), (None, "w5"), (20, None), (21, "nowhere"), (22, docs[7][1])]
    d = spark.createDataFrame([x + (1, 2) for x in docs], "doc_id long, text string, score int, item int").repartition(4)
    q = spark.createDataFrame([x + (1, 2) for x in items], "item_id long, text string, rank int, times int").repartition(2)
    for k, postings, terms, pointers, batch in ((50, 2_000_000, 200_000, 4_000_000, 256), (5, 900, 40, 300, 4)):
        for name, v in (("POSTINGS", postings), ("BLOCK_TERMS", terms), ("POINTERS", pointers), ("BATCH", batch)):
            monkeypatch.setattr(TS, name, v)
        got = sorted(map(tuple, TS.search(q, d, k).collect()), key=str)
        assert got == brute(items, docs, k)


def test_treap_finds_the_best_columns():
    r = np.random.default_rng(2)
    for rows, columns, points in ((1, 1, 1), (5, 70, 200), (300, 9, 800)):
        at = r.choice(rows * columns, min(points, rows * columns), replace=False)
        row, column, value = at // columns, at % columns, r.integers(1, 1000, len(at))
        grid = TS.Treap(row, column, value, rows, columns)
        asked = np.unique(row)[:7]
        weight = r.integers(1, 50, len(asked))
        total = np.zeros(columns, np.int64)
        for i, w in zip(asked, weight):
            np.add.at(total, column[row == i], value[row == i] * w)
        got = grid.best(asked, weight, np.arange(columns), 4, 1)
        want = sorted(((-t, c) for c, t in enumerate(total) if t), key=lambda x: x)[:4]
        assert [(-s, c) for c, s in zip(*got)] == want


def test_search_edges(spark, odd, empty):
    items = spark.createDataFrame([(1, "same text")], "item_id long, text string")
    assert TS.search(items, empty).count() == 0
    assert TS.search(items.limit(0), odd).count() == 0
    assert {x["doc_id"] for x in TS.search(items, odd).collect()} == {1, 2}
