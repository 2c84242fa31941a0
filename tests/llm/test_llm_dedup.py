"""Dedup operators against brute force, and their defined edge cases."""

from collections import defaultdict

import hashlib

import brute
import numpy as np
from pyspark.sql import functions as F

from tidemark.llm import exact_dedup, line_dedup, simhash_dedup, substring_dedup
from tidemark.llm.common import connected_components
from tidemark.llm.exact_dedup import CountingQuotientFilter
from tidemark.llm.suffix_groups import suffix_arrays


def got(df, key="doc_id"):
    return {r[key]: r for r in df.collect()}


def test_line_dedup_equals_brute_force(docs, rows):
    for m in (1, 2, 3, 5):
        out = got(line_dedup.line_dedup(docs, m))
        want = brute.line_dedup(rows, m)
        assert {d: (r["text"], r["n_removed"], r["n_runs"]) for d, r in out.items()} == want
    assert sum(v[1] for v in want.values()) > 0


def test_line_dedup_edges(odd, empty):
    out = line_dedup.line_dedup(odd, 3)
    assert out.columns[:-3] == odd.columns and out.count() == odd.count()
    texts = sorted(str(r["text"]) for r in out.collect())
    assert "other text\nb\nc\nd" in texts and "mail a@b.com or +1 (555) 555-5555" in texts
    assert line_dedup.line_dedup(empty).count() == 0


def test_line_dedup_of_long_passages(spark):
    """Repeated runs below ``min_lines`` go when they hold over 50 words."""
    import random

    import corpus_pipeline

    r = random.Random(4)
    pool = [" ".join(f"w{r.randrange(999)}" for _ in range(k)) for k in (51, 50, 80, 26, 25, 30, 21, 40, 3, 2)]
    rows = [(i, "\n".join(r.choice(pool) if r.random() < 0.5 else f"own {i} {r.random()}" for _ in range(r.randint(1, 7)))) for i in range(60)]
    rows += [(60, pool[0]), (61, pool[0]), (62, None), (63, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    for m in (3, 5):
        seen, want = {}, {}
        gone = defaultdict(set)
        for d, t in (x for x in rows if x[1] is not None):
            lines = t.split("\n")
            for p in range(len(lines)):
                for k in range(1, m + 1):
                    w = tuple(lines[p:p + k])
                    if len(w) == k and (k == m or len(" ".join(w).split()) > 50) and seen.setdefault(w, (d, p)) != (d, p):
                        gone[d].update(range(p, p + k))
            want[d] = ("\n".join(x for i, x in enumerate(lines) if i not in gone[d]), len(gone[d]), sum(1 for i in gone[d] if i - 1 not in gone[d]))
        want[62] = (None, 0, 0)
        out = got(line_dedup.line_dedup(df, m, over_words=50))
        assert {d: (x["text"], x["n_removed"], x["n_runs"]) for d, x in out.items()} == want
        if m == 3:
            stage = corpus_pipeline.stage_line_dedup(spark, df, "")
            assert {x["doc_id"]: x["text"] for x in stage.collect()} == {d: x[0] for d, x in want.items()} and want[61][0] == ""


def test_quotient_filter_round_trip_and_merge():
    r = np.random.default_rng(1)
    parts = [r.integers(0, 2**64, n, np.uint64, endpoint=False) for n in (0, 1, 5, 1000)]
    parts.append(np.repeat(parts[3][:7], 50))
    want = defaultdict(int)
    for p in parts:
        for x in p.tolist():
            want[x] += 1
    merged = CountingQuotientFilter.merge([CountingQuotientFilter.from_bytes(CountingQuotientFilter.of(p).to_bytes()) for p in parts])
    f, n = merged.items()
    assert dict(zip(f.tolist(), n.tolist())) == dict(want) and (np.diff(f.astype(object)) > 0).all()


def test_exact_dedup_equals_brute_force(docs, rows):
    import re

    out = got(exact_dedup.exact_dedup(docs))
    norm = {d: re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for d, t in rows}
    groups = defaultdict(list)
    for d, t in norm.items():
        groups[t].append(d)
    for d, t in norm.items():
        r = out[d]
        assert (r["keep_id"], r["group_size"], r["kept"], r["text_sha256"]) == (min(groups[t]), len(groups[t]), d == min(groups[t]), brute.sha(t))
    assert len(out) == len(rows)


def test_exact_dedup_edges(odd, empty):
    out = exact_dedup.exact_dedup(odd).collect()
    assert len(out) == odd.count()
    same = [r for r in out if r["group_size"] == 3]
    assert {(r["doc_id"], r["keep_id"], r["kept"]) for r in same} == {(1, 1, True), (2, 1, False)}
    assert all(r["keep_id"] is None and r["kept"] for r in out if r["doc_id"] is None)
    assert exact_dedup.exact_dedup(empty).count() == 0


def test_exact_dedup_many_blocks(docs, monkeypatch):
    want = sorted(map(tuple, exact_dedup.exact_dedup(docs).collect()))
    monkeypatch.setattr(exact_dedup, "BLOCK_FINGERPRINTS", 4)
    monkeypatch.setattr(exact_dedup, "FILTER_FINGERPRINTS", 3)
    assert sorted(map(tuple, exact_dedup.exact_dedup(docs).collect())) == want


def test_simhash_equals_brute_force(docs, rows):
    out = got(simhash_dedup.simhash_groups(docs))
    fp = {d: brute.fingerprint(t) for d, t in rows}
    comp = brute.components(fp.values())
    least = defaultdict(lambda: 10**9)
    for d, f in fp.items():
        least[comp[f]] = min(least[comp[f]], d)
    assert {d: (r["fp"] % 2**64, r["component_id"]) for d, r in out.items()} == {d: (f, least[comp[f]]) for d, f in fp.items()}


def test_fingerprint_links_reach_every_close_pair(spark, monkeypatch):
    r = np.random.default_rng(3)
    base = r.integers(0, 2**64, 40, np.uint64, endpoint=False)
    near = base[:25] ^ (np.uint64(1) << r.integers(0, 64, 25, np.uint64)) ^ (np.uint64(1) << r.integers(0, 64, 25, np.uint64))
    dense = base[0] ^ (np.uint64(1) << r.integers(0, 64, 150, np.uint64)) ^ (np.uint64(1) << r.integers(0, 20, 150, np.uint64))
    x = np.unique(np.concatenate([base, near, dense, np.zeros(1, np.uint64)]))
    want = brute.components(x.tolist())
    for cell in (4096, 16):  # whole cells, and cells cut into pairs of blocks
        monkeypatch.setattr(simhash_dedup, "CELL", cell)
        fps = spark.createDataFrame([(int(v),) for v in x.view(np.int64)], "fp long")
        root = {r["node"]: r["root"] for r in connected_components(simhash_dedup.fingerprint_links(fps)).collect()}
        mine = defaultdict(set)
        for v in x.view(np.int64).tolist():
            mine[root.get(v, v)].add(v % 2**64)
        theirs = defaultdict(set)
        for v, k in want.items():
            theirs[k].add(v)
        assert sorted(map(sorted, mine.values())) == sorted(map(sorted, theirs.values()))


def test_simhash_edges(odd, empty, docs):
    assert simhash_dedup.simhash_groups(odd).count() == odd.count()
    kept = simhash_dedup.keep_one(odd)
    assert kept.columns == odd.columns
    assert sorted(r["doc_id"] for r in kept.where("doc_id is not null").collect()) == [1, 1, 1, 3]
    assert kept.where("doc_id is null").count() == 2
    assert simhash_dedup.simhash_groups(empty).count() == 0
    groups = simhash_dedup.simhash_groups(docs)
    assert simhash_dedup.keep_one(docs).count() == groups.select("component_id").distinct().count()


def test_components_of_a_long_chain(spark):
    n = 200
    links = spark.range(n).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    out = connected_components(links).collect()
    assert len(out) == n + 1 and {r["root"] for r in out} == {0}
    assert connected_components(links.where("a < 0")).count() == 0


def test_suffix_arrays_by_grouping():
    import random

    r = random.Random(1)
    for _ in range(25):
        strings = []
        for _ in range(r.randint(1, 20)):
            s = [r.randint(1, r.choice([1, 2, 4])) for _ in range(r.randint(0, 50))]
            strings.append(((s[:max(1, len(s) // 5)] * 10)[:len(s)] if r.random() < 0.3 else s) + [0])
        text = np.full((len(strings), max(map(len, strings))), -1)
        for i, s in enumerate(strings):
            text[i, :len(s)] = s
        out = suffix_arrays(text, np.array(list(map(len, strings))))
        for i, s in enumerate(strings):
            assert out[i, :len(s)].tolist() == sorted(range(len(s)), key=lambda k: s[k:])


def substring_want(rows):
    want = {}
    texts = dict(rows)
    for d, gone in brute.substring_dedup(rows).items():
        b = np.frombuffer((texts[d] or "").encode(), np.uint8)
        spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum()) if len(gone) else 0
        want[d] = (len(b), int(gone.sum()), spans, hashlib.sha256(b[~gone].tobytes()).hexdigest())
    return want


def test_substring_dedup_equals_brute_force(docs, rows, monkeypatch):
    want = substring_want(rows)
    assert sum(w[1] for w in want.values()) > 5000
    for block, wide in ((16, 16_384), (2, 16_384), (3, 4)):  # blocks that merge in a task, and anchors dealt to several tasks
        monkeypatch.setattr(substring_dedup, "BLOCK", block)
        monkeypatch.setattr(substring_dedup, "WIDE", wide)
        out = substring_dedup.substring_dedup(docs)
        assert {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in out.collect()} == want


def test_substring_dedup_of_long_texts(spark):
    import random

    r = random.Random(3)
    piece = "".join(r.choice("abcdefgh ") for _ in range(400))
    filler = "".join(chr(97 + r.randrange(26)) for _ in range(1_300_000))
    rows = [(1, filler[:1_048_500] + piece + filler[1_048_500:]), (2, "x" + piece), (3, "ab" * 3000), (4, None), (5, "é" * 49 + "abc" + "é" * 49)]
    out = substring_dedup.substring_dedup(spark.createDataFrame(rows, "doc_id long, text string"), with_text=True)
    got = {x["doc_id"]: x for x in out.collect()}
    assert got[1]["n_removed"] == 0 and (got[2]["n_removed"], got[2]["n_spans"], bytes(got[2]["kept"])) == (400, 1, b"x")
    assert got[3]["n_removed"] == 5998 and got[4]["n_bytes"] == 0 and got[5]["n_removed"] == 0


def test_substring_dedup_edges(spark, empty):
    t = "some words that go on for long enough to be a repeated string of a hundred bytes or more in the test, yes it is"
    rows = [(7, t), (7, t), (7, t + " tail"), (None, t), (8, t), (None, None)]
    df = spark.createDataFrame([r + (1, 1, 1, 1) for r in rows], "doc_id long, text string, d int, t int, raw int, spans int")
    got = sorted((r["doc_id"] or -1, r["n_bytes"], r["n_removed"]) for r in substring_dedup.substring_dedup(df).collect())
    assert [g for g in got if g[0] == -1] == [(-1, 0, 0), (-1, len(t), 0)]
    assert (8, len(t), len(t)) in got and len(got) == 6
    assert substring_dedup.substring_dedup(empty).count() == 0


def test_substring_dedup_twins_own_the_first_copy(spark):
    """Repeated rows hold the first copy of a string whose anchor also occurs in another context: they keep all their bytes."""
    import random

    r = random.Random(6)
    piece = "".join(r.choice("abcdefghij ") for _ in range(300))
    rows = [(1, "left one " + piece + " right one")] * 2 + [(2, "other " + piece[:250] + " end"), (3, "more " + piece[40:] + " of it")]
    distinct = sorted(set(rows))
    want = {d: int(g.sum()) for d, g in brute.substring_dedup(distinct).items()}
    out = substring_dedup.substring_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((x["doc_id"], x["n_removed"]) for x in out) == sorted((d, want[d]) for d, _ in rows)
    assert want[1] == 0 and want[2] >= 250 and want[3] >= 260


def test_line_dedup_takes_free_names(spark):
    import corpus_pipeline

    df = spark.createDataFrame([(1, "a\nb\nc", 7, 8, 9), (2, "a\nb\nc\nd", 7, 8, 9)], "doc_id long, text string, n_lines int, n_removed int, N_RUNS int")
    out = line_dedup.line_dedup(df)
    assert {r["doc_id"]: (r["text"], r["n_lines"], r["n_lines_"], r["n_removed_"], r["n_runs_"]) for r in out.collect()} == {
        1: ("a\nb\nc", 7, 3, 0, 0), 2: ("d", 7, 4, 3, 1)}
    stage = corpus_pipeline.stage_line_dedup(spark, df, "")
    assert stage.columns == df.columns and {r["text"] for r in stage.collect()} == {"a\nb\nc", "d"}


def test_near_dedup_stage_decides_by_row(spark):
    import corpus_pipeline

    rows = [(1, "one a a a"), (2, "one a a a"), (2, "two b b b"), (None, "one a a a"), (None, "one a a a"), (1, "one a a a"), (None, "three c c c"),
            (None, "four d"), (9, None), (10, ""), (None, None)]
    df = spark.createDataFrame([r + (1, 2) for r in rows], "doc_id long, text string, _row int, component_id int").repartition(3)
    out = corpus_pipeline.stage_near_dedup(spark, df, "")
    assert out.columns == df.columns
    got = sorted([(r["doc_id"], r["text"]) for r in out.collect()], key=str)
    assert got == sorted([(1, "one a a a"), (2, "two b b b"), (None, "three c c c"), (None, "four d"), (9, None)], key=str)


def test_substring_dedup_of_many_rows_without_an_id(spark):
    import random

    r = random.Random(8)
    fresh = lambda: "".join(r.choice("abcdefgh ") for _ in range(160))
    unique, twice = [fresh() for _ in range(1500)], [fresh() for _ in range(300)]
    df = spark.createDataFrame([(None, t) for t in unique + twice + [t + "!" for t in twice]], "doc_id long, text string").repartition(6)
    out = substring_dedup.substring_dedup(df).toPandas()
    assert (out["n_removed"] > 0).sum() == 300 and out.loc[out["n_removed"] > 0, "n_removed"].isin([160]).all()
    assert len(out) == 2100
