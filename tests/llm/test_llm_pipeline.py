"""The whole pipeline against a chain of brute-force stages on odd rows."""

import random
import zlib
from collections import Counter, defaultdict

import brute
import numpy as np

from tidemark.llm import packing, pii

EXTRA = ", n_lines int, n_removed int, n_runs int, _row int, component_id int, fp int, piece int, start int"


def table(r):
    """(doc_id, text): shared and null ids, repeated rows, copies, repeated line runs and long passages."""
    words = ["".join(r.choice("abcdefghij") for _ in range(r.randint(2, 7))) for _ in range(150)]
    line = lambda n: " ".join(r.choice(words) for _ in range(n))
    hot, passage = "\n".join(line(9) for _ in range(4)), line(60)
    rows = []
    for i in range(80):
        own = [line(r.randint(4, 14)) for _ in range(r.randint(1, 6))]
        if i % 5 == 1:
            own.insert(r.randrange(len(own) + 1), hot)
        if i % 7 == 2:
            own.insert(r.randrange(len(own) + 1), passage)
        rows.append((i, "\n".join(own)))
    rows += [(100 + i, rows[10][1]) for i in range(4)]
    rows += [(200, None), (201, ""), (202, line(3000)), (203, f"write to {words[3]}@mail.example.org or +1 (555) 555-5555 now")]
    single = line(12)
    rows += [(1, single), (2, single), (2, line(9)), (None, single), (None, line(11)), (300, single), (300, single)]
    return rows


def line_dedup(rows):
    """Runs of three lines, or fewer lines of over 50 words, that start earlier elsewhere go."""
    seen, gone = {}, defaultdict(set)
    for key in sorted({x for x in rows if x[1] is not None}, key=lambda x: (x[0] is not None, x[0] or 0, x[1])):
        lines = key[1].split("\n")
        for p in range(len(lines)):
            for k in (1, 2, 3):
                w = tuple(lines[p:p + k])
                if len(w) == k and (k == 3 or len(" ".join(w).split()) > 50) and seen.setdefault((k, w), (key, p)) != (key, p):
                    gone[key].update(range(p, p + k))
    return [(d, None if t is None else "\n".join(x for i, x in enumerate(t.split("\n")) if i not in gone[d, t])) for d, t in rows]


def near_dedup(rows):
    """One row of each component of fingerprints stays: that of the smallest id, rows without one last."""
    root = brute.components([brute.fingerprint(t) for _, t in rows])
    first = {}
    for i, (d, t) in enumerate(rows):
        c = root[brute.fingerprint(t)]
        best = (d is None, d or 0, i)
        first[c] = min(first.get(c, best), best)
    return [rows[i] for _, _, i in first.values()]


def test_pipeline_equals_brute_force_chain(spark, tmp_path):
    from tokenizers import Tokenizer

    import corpus_pipeline

    rows = table(random.Random(6))
    schema = "doc_id long, text string, lang string, source string, n_chars long" + EXTRA
    spark.createDataFrame([(d, t, "en", "s", 1) + (7,) * 8 for d, t in rows], schema).repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i % 9 == 0)) for i in range(60)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    clean = corpus_pipeline.stage_toxicity(spark, docs, str(tmp_path))  # judged by held-out labels elsewhere
    assert clean.columns == docs.columns
    kept = near_dedup(line_dedup([(r["doc_id"], r["text"]) for r in clean.collect()]))
    last = pii.redact(spark.createDataFrame(kept, "doc_id long, text string")).collect()
    tokenizer = Tokenizer.from_file(packing.vocabulary_path())
    tokenizer.encode_special_tokens = True
    want = Counter()
    for r in last:
        ids = tokenizer.encode(r["text"] or "", add_special_tokens=False).ids + [0]
        for piece, start in enumerate(range(0, len(ids), packing.SEQUENCE)):
            part = ids[start:start + packing.SEQUENCE]
            want[r["doc_id"], piece, start, len(part), zlib.crc32(np.array(part, "<u4").tobytes())] += 1
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in out) == want
    placed = defaultdict(list)
    for r in out:
        placed[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in placed.values():
        parts.sort()
        assert parts[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(parts, parts[1:]))
        assert sum(n for _, n in parts) <= packing.SEQUENCE
