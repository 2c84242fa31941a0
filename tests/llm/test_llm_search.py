"""Top-k search against exhaustive scoring."""

import math
import random
import re
import time
from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow as pa

from tidemark.llm import search


def brute(rows, queries, k):
    tf = {d: Counter(re.findall(r"[^\W_]+", (t or "").lower())) for d, t in rows}
    df = Counter(w for c in tf.values() for w in c)
    mean = sum(sum(c.values()) for c in tf.values()) / len(tf)
    out = []
    for q in queries:
        scores = []
        for d, c in tf.items():
            dl = sum(c.values())
            s = sum(math.log(1 + (len(tf) - df[w] + 0.5) / (df[w] + 0.5)) * c[w] * 2.2 / (c[w] + 1.2 * (0.25 + 0.75 * dl / mean)) for w in tf[q] if w in c)
            if s > 0:
                scores.append((-round(s, 6), d))
        out += [(q, i + 1, d, -s) for i, (s, d) in enumerate(sorted(scores)[:k])]
    return out


def test_search_equals_exhaustive_scoring(spark, monkeypatch):
    r = random.Random(4)
    words = [f"w{i}" for i in range(300)]
    rows = [(i, " ".join(r.choices(words, [1 / (j + 1) for j in range(300)], k=r.randint(0, 60)))) for i in range(700)]
    rows += [(900, None), (901, ""), (902, rows[20][1]), (903, rows[20][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    queries = [d for d, _ in rows if d % 20 == 0]
    want = brute(rows, queries, 10)
    for shard, block, size in ((1_500_000, 16_000, 64), (2_000, 10, 8)):
        monkeypatch.setattr(search, "SHARD", shard)
        monkeypatch.setattr(search, "QUERIES", block)
        got = sorted(map(tuple, search.search(docs.where("doc_id % 20 = 0"), docs).collect()))
        assert [g[:3] for g in got] == [w[:3] for w in want]
        assert all(abs(g[3] - w[3]) < 2e-6 for g, w in zip(got, want))


def test_search_edges(odd, empty):
    got = search.search(odd, odd, k=3)
    assert got.where("query_id is null or doc_id is null").count() == 0
    assert got.where("query_id = 2 and rank = 1").count() == 1
    assert got.where("query_id = 1 and rank = 1").count() == 3  # twice the same row and one of another text
    assert search.search(empty, empty).count() == 0


def test_repeated_query_rows_keep_their_scores(spark):
    docs = spark.createDataFrame([(i, f"common word{i % 7} tail{i}") for i in range(60)], "doc_id long, text string")
    one = sorted(map(tuple, search.search(docs.where("doc_id = 20"), docs, k=4).collect()))
    twice = docs.where("doc_id = 20").unionByName(docs.where("doc_id = 20"))
    assert sorted(map(tuple, search.search(twice, docs, k=4).collect())) == sorted(one + one)


def test_queries_are_copied_for_few_cells_only(spark, monkeypatch):
    """What is sent grows with cells, not shards: a cell streams through many shards. Blocks without known terms find nothing."""
    monkeypatch.setattr(search, "SHARD", 40)
    monkeypatch.setattr(search, "CELLS", 2)
    kind = type(spark.range(1))
    sent, deal = [], kind.repartitionById
    monkeypatch.setattr(kind, "repartitionById", lambda df, *a: sent.append(df) or deal(df, *a))
    rows = [(i, f"common word{i % 7} tail{i}") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    queries = [d for d, _ in rows if d % 20 == 0]
    found = search.search(docs.where("doc_id % 20 = 0"), docs, k=4)
    assert [g[:3] for g in sorted(map(tuple, found.collect()))] == [w[:3] for w in brute(rows, queries, 4)]
    assert sent[0].where(f"kind = {search.QUERY}").count() == 2 * len(queries) and sent[0].where(f"kind = {search.DOCUMENT}").count() == len(rows)
    other = spark.createDataFrame([(1, "unknown here"), (2, None), (3, "unknown common")], "doc_id long, text string")
    assert {r["query_id"] for r in search.search(other, docs, k=4).collect()} == {3}
    assert search.search(other.where("doc_id < 3"), docs, k=4).count() == 0 and search.search(other.where("doc_id > 3"), docs, k=4).count() == 0


def test_few_documents_are_scored_exactly(spark, monkeypatch):
    """Product of frequent lists, cut postings, terms left out and skipped shards: same results, few exact scores."""
    r = random.Random(9)
    words = [f"w{i}" for i in range(400)]
    rows = [(i, " ".join(r.choices(words, [1 / (j + 1) for j in range(400)], k=r.randint(5, 80)))) for i in range(600)]
    rows += [(700 + i, rows[40][1]) for i in range(6)]
    for name, value in (("HEAD", 7), ("LEFT", 0.3), ("PAIRS", 50), ("TABLE", 900), ("SHARD", 2_000)):
        monkeypatch.setattr(search, name, value)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    queries = [d for d, _ in rows if d % 20 == 0]
    want = brute(rows, queries, 5)
    got = sorted(map(tuple, search.search(docs.where("doc_id % 20 = 0"), docs, k=5).collect()))
    assert [g[:3] for g in got] == [w[:3] for w in want] and all(abs(g[3] - w[3]) < 2e-6 for g, w in zip(got, want))
    # the same in one cell, with the exact scores counted
    rows = [d for d in rows if d[0] < 600]
    index = {w: i for i, w in enumerate(words)}
    counts = [sorted(Counter(index[w] for w in t.split()).items()) for _, t in rows]
    df = Counter(w for c in counts for w, _ in c)
    ragged = pa.array([[w for w, _ in c] for c in counts], pa.list_(pa.int64()))
    batch = pa.RecordBatch.from_arrays([pa.array([d for d, _ in rows]), pa.array([len(t.split()) for _, t in rows], pa.int32()), ragged,
                                        pa.array([[n for _, n in c] for c in counts], pa.list_(pa.int32()))], ["id", "length", "terms", "tf"])
    idf = [math.log(1 + (len(rows) - df[i] + 0.5) / (df[i] + 0.5)) for i in range(400)]
    cell = search.Cell(5, sum(len(t.split()) for _, t in rows) / len(rows), 2_000)
    scored, scores = [], search.Shard.scores
    monkeypatch.setattr(search.Shard, "scores", lambda shard, wanted, at: scored.append(len(at)) or scores(shard, wanted, at))
    cell.take(search.WORD, pa.RecordBatch.from_arrays([pa.array([list(range(400))], pa.list_(pa.int64())), pa.array([idf], pa.list_(pa.float64()))], ["terms", "idf"]))
    asked = batch.filter(pa.array([d % 20 == 0 for d, _ in rows]))
    cell.take(search.QUERY, asked)
    cell.take(search.DOCUMENT, batch)
    best = sorted(zip(*(c.to_pylist() for c in cell.result().columns)), key=lambda x: (x[0], -x[2], x[1]))
    assert [b[:2] for b in best] == [(q, d) for q, _, d, _ in brute(rows, [d for d, _ in rows if d % 20 == 0], 5)]
    assert sum(scored) < len(asked) * len(rows) / 4


def shuffled(spark):
    dirs = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {p for d in dirs for p in Path(d.getPath()).rglob("shuffle_*")}


def test_disk_holds_one_dealing_of_the_documents(spark, monkeypatch):
    """Documents go once to a round, queries to a bounded number of cells, and what was dealt is gone afterwards."""
    for name, value in (("SHARD", 10), ("CELL", 20), ("QUERIES", 4)):
        monkeypatch.setattr(search, name, value)
    kind = type(spark.range(1))
    sent, deal = [], kind.repartitionById
    monkeypatch.setattr(kind, "repartitionById", lambda df, *a: sent.append(df) or deal(df, *a))
    rows = [(i, f"common word{i % 7} tail{i}") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    queries = [d for d, _ in rows if d % 20 == 0]
    before, conf = shuffled(spark), {k: spark.conf.get(k, None) for k in search.SETTINGS}
    found = search.search(docs.where("doc_id % 20 = 0"), docs, k=4)
    assert {k: spark.conf.get(k, None) for k in search.SETTINGS} == conf
    for _ in range(100):
        left = shuffled(spark) - before
        if not left:
            break
        time.sleep(0.1)
    assert not left
    assert [g[:3] for g in sorted(map(tuple, found.collect()))] == [w[:3] for w in brute(rows, queries, 4)]
    assert len(sent) == 3 and all(s.where(f"kind = {search.DOCUMENT}").count() == len(rows) for s in sent)
    assert sum(s.where(f"kind = {search.QUERY}").count() for s in sent) == search.MOST * len(queries)


def test_ways_of_adding_up_give_the_same_results(monkeypatch):
    """Products or lists, few or many postings at once, documents in any order: one result. Words are found by their first bits."""
    r = random.Random(5)
    hashes = [*sorted(r.randrange(-2**63, 2**63 - 1) for _ in range(200)), 2**63 - 1]
    places = search.Numbers(np.array(hashes, np.int64))
    assert places.find(np.array(hashes)).tolist() == list(range(201))
    other = np.array([-2**63, 0, hashes[7] + 1, 2**63 - 1])
    assert places.find(other).tolist() == np.searchsorted(np.array(hashes), other).tolist()
    docs = [(i, Counter(r.choices(range(i % 2 * 40, 120), [1 / (j + 1) for j in range(120 - i % 2 * 40)], k=r.randint(1, 50)))) for i in range(300)]
    idf = [math.log(1 + 300.5 / (sum(t in c for _, c in docs) + 0.5)) for t in range(120)]

    def batch(rows):
        lists = [pa.array([list(x) for x in column], pa.list_(kind)) for column, kind in (((c for _, c in rows), pa.int64()), ((c.values() for _, c in rows), pa.int32()))]
        return pa.RecordBatch.from_arrays([pa.array([i for i, _ in rows]), pa.array([c.total() for _, c in rows], pa.int32()), *lists], ["id", "length", "terms", "tf"])

    found = []
    for values, order in (((0, 512, 0.0, 40_000), docs), ((1e9, 512, 0.0, 40_000), docs[::-1]), ((3, 9, 0.2, 70), sorted(docs, key=lambda d: d[0] % 2)), ((1e9, 0, 0.0, 9), docs)):
        for name, value in zip(("PRODUCT", "HEAD", "FREQUENT", "PAIRS"), values):
            monkeypatch.setattr(search, name, value)
        cell = search.Cell(4, 20.0, 900)
        cell.take(search.WORD, pa.RecordBatch.from_arrays([pa.array([list(range(120))], pa.list_(pa.int64())), pa.array([idf], pa.list_(pa.float64()))], ["terms", "idf"]))
        cell.take(search.QUERY, batch(docs[:40]))
        cell.take(search.DOCUMENT, batch(order))
        found.append(sorted(zip(*(c.to_pylist() for c in cell.result().columns)), key=lambda x: (x[0], -x[2], x[1])))
    assert len(found[0]) == 160 and all(f == found[0] for f in found)
