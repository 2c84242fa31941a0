"""Text operators against brute force, the named libraries, or held-out accuracy."""

import random
import zlib

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import bpe, language, packing, pii, toxicity

SF = "/root/testdata/sf0.01"
NASTY = ["", " ", "  two  blanks ", "tab\tand\n\nlines \n x", "don't we'll I'M 'tis", "a" * 700, "ab" * 90 + " " + "é" * 60, "1234567 89 ½ ²",
         "日本語 テキスト 🙂🙂", "x y z  w", "\x1c\x1d a\x85b", "<|endoftext|> <|startoftext|>", "Σίσυφος ΑΣ", "é e ́x", "!!! ... ---- $$$ 'S 're"]


@pytest.fixture(scope="session")
def nasty(spark):
    r = random.Random(2)
    more = ["".join(r.choice("ab \n\t'.é1²🙂zs") for _ in range(r.randint(1, 80))) for _ in range(150)]
    return spark.createDataFrame(list(enumerate(NASTY + more + [None])), "doc_id long, text string")


def test_byte_bpe_equals_the_library_and_round_trips(nasty):
    import base64

    import public_tokenizers as P
    import tiktoken

    with open(P.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    own = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = {r["doc_id"]: r["text"] or "" for r in nasty.collect()}
    for r in bpe.encode_documents(nasty, with_ids=True).collect():
        ids = own.encode_ordinary(texts[r["doc_id"]])
        assert r["ids"] == ids and r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == brute.sha(" ".join(map(str, ids)))
        assert r["decoded_sha256"] == brute.sha(texts[r["doc_id"]])
    codec = bpe.codec(P.path("byte_bpe_50k.tiktoken"), P.PATTERN)
    assert codec.decode([" ".join(map(str, own.encode_ordinary(t))) for t in NASTY]) == [t.encode() for t in NASTY]
    assert bpe.encode_documents(nasty.where("doc_id < 0")).count() == 0


def test_byte_bpe_cache_can_overflow(monkeypatch):
    import public_tokenizers as P

    monkeypatch.setattr(bpe, "CACHE_WORDS", 20)
    own = bpe.Codec(P.path("byte_bpe_50k.tiktoken"), P.PATTERN)
    one = [own.encode([t])[0] for t in NASTY]
    assert own.encode(NASTY) == one


def test_pieces_equal_the_tokenizer(nasty):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(packing.vocabulary_path())
    t.encode_special_tokens = True
    texts = {r["doc_id"]: r["text"] or "" for r in nasty.collect()}
    parts = {}
    for r in packing.token_pieces(nasty, size=64, with_ids=True).collect():
        assert r["start"] == 64 * r["piece"] and r["length"] == len(r["ids"])
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
        parts.setdefault(r["doc_id"], {})[r["piece"]] = r["ids"]
    for d, text in texts.items():
        want = t.encode(text, add_special_tokens=False).ids + [0]
        have = [parts[d][k] for k in range(len(parts[d]))]
        assert sum(have, []) == want and all(len(x) == 64 for x in have[:-1])


def check_packed(out, size):
    by = {}
    for r in out:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for spans in by.values():
        at = 0
        for o, n in sorted(spans):
            assert o == at
            at += n
        assert at <= size
    return len(by)


def test_packing_is_gapless_and_tight(spark, monkeypatch):
    r = random.Random(5)
    lengths = [64 if r.random() < 0.1 else r.randint(1, 63) for _ in range(900)]
    pieces = spark.createDataFrame([(i, 0, n) for i, n in enumerate(lengths)], "doc_id long, piece int, length long")
    for group in (50_000, 200):  # one pass, and groups with a second pass over what stays underfull
        monkeypatch.setattr(packing, "GROUP_PIECES", group)
        out = packing.pack(pieces, 64).collect()
        assert sorted(x["doc_id"] for x in out) == list(range(900))
        assert check_packed(out, 64) <= -(-sum(lengths) // 64) + 12


def test_local_search_empties_bins():
    n = np.array([6, 5, 5, 4, 4, 4, 3, 3, 2])
    bad = [[0, 6], [1, 2], [3, 4], [5, 7], [8]]  # 9, 10, 8, 7, 2 of 12
    out = packing.local_search(bad, n, 12)
    assert len(out) == 3 and sorted(sum(out, [])) == list(range(9)) and all(n[b].sum() <= 12 for b in out)


def test_local_search_leaves_no_exchange(spark, monkeypatch):
    """Lengths on which best-fit decreasing is far from tight: every fuller bin is a partner, until nothing is left to gain."""
    n = np.random.default_rng(1).integers(512, 1024, 3000)
    fresh = packing.best_fit(n, 2048)
    out = packing.local_search(fresh, n, 2048)
    assert sorted(sum(out, [])) == list(range(3000)) and all(n[b].sum() <= 2048 for b in out)
    assert len(out) < 0.98 * len(fresh)
    bins = [(2048 - int(n[b].sum()), n[b].tolist()) for b in out if n[b].sum() < 2048]
    for room, mine in bins:
        totals = set(mine) | {x + z for k, x in enumerate(mine) for z in mine[k + 1:]}
        for t in totals:
            assert not any(0 < t - y <= r for r, theirs in bins if r < room for y in (0, *theirs))
    monkeypatch.setattr(packing, "GROUP_PIECES", 1000)  # sequences filled above 98 % take part in the second pass
    pieces = spark.createDataFrame([(i, 0, int(x)) for i, x in enumerate(n)], "doc_id long, piece int, length long")
    assert check_packed(packing.pack(pieces, 2048).collect(), 2048) < 0.98 * len(fresh)


def test_packed_sequences_hold_their_documents(docs):
    placed = packing.pack_documents(docs, size=128)
    n = check_packed(placed.collect(), 128)
    seqs = packing.sequences(docs, placed, size=128).collect()
    assert len(seqs) == n and sum(len(s["ids"]) for s in seqs) == placed.agg(F.sum("length")).first()[0]


def test_pii_base_equals_brute_force(spark):
    r = random.Random(9)
    atoms = ["a@b.com", "x_y@z-w.co.uk", "a@b", "@", ".", "..", "1.2.3.4", "256.1.1.1", "007.0.0.255", "1.2.3.4.5.6.7.8", "4111 1111 1111 1111",
             "4111-1111-1111-1112", "+1 (555) 555-5555", "+12", "+1 2 3", "é", "🙂", " ", "\n", "-", "5500005555555559", "foo", "john at host dot com", "%", "0" * 30]
    texts = ["".join(r.choice(atoms) + r.choice(["", " ", ""]) for _ in range(r.randint(1, 14))) for _ in range(400)]
    texts += ["", None, "1" * 60_000, "a" * 60_000, "1 " * 30_000, "." * 50_000, "a@" * 20_000, "+1 " + "(" * 50_000, "1." * 30_000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(8)
    for row in pii.find_pii(df).collect():
        want = brute.pii_base(texts[row["doc_id"]])
        assert [row[f"n_{k}"] for k in pii.KINDS] == [sum(w[0] == k for w in want) for k in pii.KINDS], texts[row["doc_id"]]
        joined = ",".join(f"{k}:{s}:{e}" for k, s, e in want)
        assert row["base_sha256"] == brute.sha(joined), texts[row["doc_id"]]
        spans = row["spans"].split(",") if row["spans"] else []
        assert set(filter(None, joined.split(","))) <= set(spans)
        order = [(pii.KINDS.index(x.split(":")[0]), int(x.split(":")[1])) for x in spans]
        assert order == sorted(order)


def test_pii_adds_lookalikes_and_redacts(spark):
    texts = [f"card {i:03d}: pay with 4111 1111 1111 1111 now, or mail u{i}@site.org" for i in range(60)]
    texts += ["card 999: pay with 4111 1111 1111 1112 now", "nothing here 12", None, ""]
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, _piit string")
    model = pii.fit(df)
    out = {r["doc_id"]: r for r in pii.find_pii(df, model).collect()}
    assert out[60]["n_card"] == 0 and "card:19:38" in out[60]["spans"]  # same format and context, fails the check
    assert out[61]["spans"] == "" and out[62]["spans"] == ""
    red = {r["doc_id"]: r["text"] for r in pii.redact(df, model).collect()}
    assert red[60] == "card 999: pay with [CARD] now" and red[0].endswith("or mail [EMAIL]")
    assert red[61] == texts[61] and red[62] is None and red[63] == ""


def test_pii_edges(odd, empty):
    assert pii.find_pii(odd).count() == odd.count() and pii.redact(odd).columns == odd.columns
    assert pii.find_pii(empty).count() == 0 and pii.redact(empty).count() == 0


def auc(score, label):
    order = np.argsort(score, kind="stable")
    rank = np.empty(len(score))
    rank[order] = np.arange(len(score))
    p = label.sum()
    return (rank[label == 1].sum() - p * (p - 1) / 2) / (p * (len(label) - p))


def test_toxicity_on_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    out = toxicity.toxicity(docs, labels)
    got = out.join(labels.select("doc_id", "toxic"), "doc_id").where("held_out").toPandas()
    fold = out.select(F.max((F.col("held_out") != (F.crc32(F.col("doc_id").cast("string")) % 5 == 0)).cast("int"))).first()[0]
    assert fold == 0 and got["score"].between(0, 1).all()
    assert auc(got["score"].to_numpy(), got["toxic"].to_numpy()) > 0.95
    hit = got["predicted"] == got["toxic"]
    assert hit.mean() > 0.95


def test_toxicity_edges(spark, odd, empty):
    labels = spark.createDataFrame([(1, 1), (1, 1), (2, 0), (None, 1)], "doc_id long, toxic int")
    none = labels.where("toxic = 5")
    assert toxicity.toxicity(odd, labels).count() == odd.count()
    assert toxicity.toxicity(odd, none).agg(F.max("score")).first()[0] == 0.0
    assert toxicity.drop_toxic(odd, none).columns == odd.columns
    assert toxicity.toxicity(empty, labels).count() == 0


def test_language_on_held_out_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    out = language.language_id(docs)
    got = out.join(docs.select("doc_id", "lang"), "doc_id").where("held_out").toPandas()
    assert (got["lang_pred"] == got["lang"]).mean() > 0.97 and got["score"].between(0, 1).all()


def test_language_edges(docs, odd, empty):
    out = {r["doc_id"]: r for r in language.language_id(docs).collect()}
    assert out[0]["lang_pred"] == "und" and out[0]["score"] == 0.0
    assert language.language_id(odd).count() == odd.count()
    assert language.language_id(empty).count() == 0
    assert {r["lang_pred"] for r in language.language_id(docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
