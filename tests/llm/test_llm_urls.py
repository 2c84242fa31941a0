"""URL filter: listed rules against plain Python, mined rules against counted itemsets."""

import itertools
import random
import re

from tidemark.llm import url_filter as UF

URLS = [
    None, "", "no scheme", "http://", "://x", "http://A.B.Example.COM/en/x?y#z", "https://www.example.com/en/", "https://example.com/en", "http://notexample.com/en/",
    "http://com/", "http://x.com", "http://x.com?/", "http://x.net/es/1", "http://net/fr/", "http://x.net/fr", "http://x.org/es/", "http://İ.COM/", "http://u@x.net:80/es/",
    "a://b://c.com/", "http://www.example.com.net/es/", "http://x.net/es/\n2", "http://x.net#/es/", "HTTP://WWW.EXAMPLE.COM/en/%20", "http://com.", "http://" + "a" * 100_000 + ".com/" + "b/" * 50_000]
SCHEMA = "page_id long, url string, html string, token string, hit int, tokens string, verdict int, row_no int"


def listed(url):
    if url is None or "://" not in url:
        return "", "", None, None
    rest = url.split("://", 1)[1]
    host = re.split("[/?#]", rest)[0]
    path = re.split("[?#]", rest[len(host):])[0]
    host = re.sub("[A-Z]", lambda m: m.group().lower(), host)
    best = max(((len(h + p), h + p, v) for v, h, p in UF.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)), default=(0, None, None))
    return host, path, best[1], best[2]


def frame(spark, rows):
    return spark.createDataFrame([(i, u, None, "t", 1, "x", 3, 4) for i, u in rows], SCHEMA).repartition(3)


def test_listed_rules(spark):
    rows = [(i, u) for i, u in enumerate(URLS)] + [(None, URLS[5]), (5, URLS[5])]
    labels = spark.createDataFrame([(1, 1, 0), (2, None, None)], "doc_id long, quality int, toxic int")
    got = UF.judge(frame(spark, rows), labels)
    want = [(i, *listed(u)) for i, u in rows]
    assert sorted([tuple(x[:4]) for x in got.select("page_id", "host", "path", "rule").collect()], key=str) == sorted([w[:4] for w in want], key=str)
    assert all(x["verdict"] == (next(w[4] for w in want if w[0] == x["page_id"]) or "allow") for x in got.collect())


def test_mined_rules_equal_counted_itemsets(spark, monkeypatch):
    monkeypatch.setattr(UF, "MIN_URLS", 4)
    monkeypatch.setattr(UF, "MIN_SUPPORT", 0.01)
    rows, labels = [], []
    for i in range(240):
        host = ("bets.shop", "news.site", "bets.site", "blog.shop")[i % 4]
        rows.append((i, f"http://m{i % 3}.{host}.org/{('play', 'read', 'win')[i % 3]}/{i}?ref={i}"))
        bad = host.startswith("bets") and i % 3 == 0 or i % 29 == 0
        if i % 5:
            labels.append((i, 1, int(bad)))
    labels += [(5, 0, None), (None, 0, 1), (9999, 0, 1), (6, None, None)]
    pages = frame(spark, rows)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    host, path = UF.parse("url")
    sets = {r[0]: frozenset(r[1]) for r in pages.select("page_id", UF.tokens(host, path, pages["url"])).collect()}
    blocked = {}
    for d, q, t in labels:
        if d in sets and (q is not None or t is not None):
            blocked[d] = blocked.get(d, False) or q == 0 or t == 1
    assert all(len(s) <= UF.FIT_TOKENS for s in sets.values())
    n = len(blocked)
    counts = {}
    for d, b in blocked.items():
        for k in range(1, len(sets[d]) + 1):
            for c in itertools.combinations(sorted(sets[d]), k):
                m = counts.setdefault(c, [0, 0])
                m[0] += 1
                m[1] += b
    least = max(UF.MIN_SUPPORT, 4 / n) * n
    strong = {c: h / m for c, (m, h) in counts.items() if h >= least - 1e-9 and h / m >= UF.MIN_CONFIDENCE}
    kept = {c: s for c, s in strong.items() if not any(p in strong and strong[p] >= s for p in itertools.combinations(c, len(c) - 1))}
    want = {}
    for d, s in sets.items():
        fits = [c for c in kept if set(c) <= s]
        want[d] = "block" if fits else "allow"
    got = {r["page_id"]: r["verdict"] for r in UF.judge(pages, marks).collect()}
    assert got == want and {"block", "allow"} == set(got.values())


def test_no_labels_no_pages(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert UF.judge(spark.createDataFrame([], SCHEMA), labels).count() == 0
    got = UF.judge(frame(spark, [(1, "http://bets.org/")]), labels).collect()
    assert [r["verdict"] for r in got] == ["allow"]


def counted(spark, rows, labels, least):
    """Verdicts by counting every itemset of the labelled urls' tokens that is on one of them."""
    host, path = UF.parse("url")
    pages = frame(spark, rows)
    sets = {r[0]: frozenset(r[1]) for r in pages.select("page_id", UF.tokens(host, path, pages["url"])).collect()}
    counts = {}
    for d, bad in labels.items():
        for k in range(1, len(sets[d]) + 1):
            for c in itertools.combinations(sorted(sets[d]), k):
                m = counts.setdefault(c, [0, 0])
                m[0] += 1
                m[1] += bad
    strong = [set(c) for c, (m, h) in counts.items() if h >= least and h / m >= UF.MIN_CONFIDENCE]
    return {d: "block" if any(c <= s for c in strong) else "allow" for d, s in sets.items()}, sets


def test_long_urls_keep_all_tokens(spark, monkeypatch):
    """No token is left out, however many tell more."""
    r = random.Random(3)
    rows, labels = [], {}
    for i in range(160):
        keys = [f"k{chr(97 + j)}" for j in range(7) if r.random() < 0.6] + (["x"] if i % 2 else []) + (["y"] if i % 4 > 1 else [])
        keys += [f"chain{chr(97 + j)}" for j in range(4) if i % 8 > j] + (["same", "too"] if i % 5 == 0 else [])
        rows.append((i, f"shop:///{'/'.join(keys)}"))
        if i % 10:
            labels[i] = int(i % 4 == 3 and r.random() < 0.9 or r.random() < 0.1)
    rows += [(900, "shop:///x/y"), (901, "shop:///x"), (902, "shop:///too/chaina"), (903, "shop:///y/ka/x/kb")]
    monkeypatch.setattr(UF, "MIN_URLS", 6)
    marks = spark.createDataFrame([(d, 1, b) for d, b in labels.items()], "doc_id long, quality int, toxic int")
    want, sets = counted(spark, rows, labels, 6)
    assert max(map(len, sets.values())) > UF.FIT_TOKENS and want[900] == want[903] == "block" and want[901] == "allow"
    assert {x["page_id"]: x["verdict"] for x in UF.judge(frame(spark, rows), marks).collect()} == want


def test_rule_of_tokens_beyond_the_first_ten(spark):
    """Two tokens that tell nothing alone, on urls of 40 tokens more that tell something and are on the same urls."""
    one, other = ("/".join(f"{s}{chr(97 + j // 20)}{chr(97 + j % 20)}" for j in range(40)) for s in "st")
    rows = [(i, "shop:///" + "/".join(t for t, on in (("x", i & 1), ("y", i & 2), (one if i % 16 < 11 else other, True)) if on)) for i in range(320)]
    labels = spark.createDataFrame([(i, 1, int(i % 4 in (0, 3))) for i in range(320)], "doc_id long, quality int, toxic int")
    rows += [(900, "shop:///y/x"), (901, "shop:///x/saa"), (902, "shop:///y/tbt")]
    got = {r["page_id"]: (r["verdict"], r["mined"]) for r in UF.judge(frame(spark, rows), labels).collect()}
    assert all(got[i] == (("block", "path=x path=y") if i % 4 == 3 else ("allow", None)) for i in range(320))
    assert got[900] == got[3] and got[901] == got[902] == got[0]
