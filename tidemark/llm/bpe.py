"""Byte-level BPE by DuckDB recursive queries inside the partitions.

Words (matches of the split pattern) become token-position rows, one a byte.
A recursive query joins neighbouring tokens with the merge table and contracts
each word's leftmost pair of least rank until no pair is left; an ordered
aggregation lists the ids, another joins the tokens' bytes again (decoding).
Each distinct word is encoded once for a worker process, which keeps a bounded
number of results; documents are put together from their words' ids.

Words above ``LONG`` bytes take a loop of the same step without the recursive
query's growing result. There, all non-overlapping occurrences of the least
pair are contracted at once where no merge of lower rank can arise from its
token, which gives the same ids.

Defined cases: null text counts as empty (no ids); repeated rows are encoded
as often as they occur; an empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

CACHE_WORDS = 700_000
QUERY_WORDS = 60_000
LONG = 48
_SPACE = re.compile(r" (?=\S)")  # a blank before a word: no match of the split pattern runs across its left side

_ENCODE = """
WITH RECURSIVE st(w, pos, id, done) AS (
  SELECT w, pos, id, false FROM init
  UNION ALL
  (WITH a AS (SELECT w, pos, id, lead(id) OVER q AS nx, lag(pos) OVER q AS pp FROM st WHERE NOT done
              WINDOW q AS (PARTITION BY w ORDER BY pos)),
        b AS (SELECT a.w, a.pos, a.id, a.pp, m.t FROM a LEFT JOIN merges m ON m.k = (a.id::BIGINT << 20) | a.nx),
        g AS (SELECT w, min(t::BIGINT << 20 | pos) AS best FROM b GROUP BY w)
   SELECT b.w, b.pos, CASE WHEN (g.best & 1048575) = b.pos THEN b.t ELSE b.id END, g.best IS NULL
   FROM b JOIN g ON b.w = g.w
   WHERE g.best IS NULL OR (g.best & 1048575) IS DISTINCT FROM b.pp)
)
SELECT w, string_agg(id::VARCHAR, ' ' ORDER BY pos) AS ids FROM st WHERE done GROUP BY w ORDER BY w
"""

_STEP = """
CREATE OR REPLACE TEMP TABLE nxt AS
WITH a AS (SELECT w, pos, id, lead(id) OVER q AS nx, row_number() OVER q AS rn FROM st WINDOW q AS (PARTITION BY w ORDER BY pos)),
     b AS (SELECT a.*, m.t, m.one FROM a LEFT JOIN merges m ON m.k = (a.id::BIGINT << 20) | a.nx),
     g AS (SELECT w, min(t::BIGINT << 32 | pos) AS best FROM b GROUP BY w),
     c AS (SELECT b.*, coalesce(b.t = g.best >> 32 AND (NOT b.one OR b.pos = g.best & 4294967295), false) AS hit FROM b JOIN g ON b.w = g.w),
     i AS (SELECT *, rn - row_number() OVER (PARTITION BY w, hit ORDER BY pos) AS isl FROM c),
     j AS (SELECT *, hit AND row_number() OVER (PARTITION BY w, hit, isl ORDER BY pos) % 2 = 1 AS take FROM i),
     l AS (SELECT *, lag(take, 1, false) OVER (PARTITION BY w ORDER BY pos) AS gone FROM j)
SELECT w, pos, CASE WHEN take THEN t ELSE id END::INTEGER AS id FROM l WHERE NOT gone
"""


class Codec:
    """Encodes and decodes words by a vocabulary of ranks."""

    def __init__(self, path: str, pattern: str):
        import duckdb
        import regex

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.split = regex.compile(pattern).findall
        self.byte = np.array([ranks[bytes([i])] for i in range(256)], np.int32)
        pairs = [(ranks[t[:i]], ranks[t[i:]], r) for t, r in ranks.items() for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks]
        early = {x for p, q, r in pairs for x in (p, q) if r < x}  # a merge with this token may rank below the token
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "400MB"})
        table = pa.table({"k": pa.array([p << 20 | q for p, q, _ in pairs], pa.int64()), "t": pa.array([r for *_, r in pairs], pa.int32()),
                          "one": [r in early for *_, r in pairs]})
        vocabulary = pa.table({"id": pa.array(list(ranks.values()), pa.int32()), "raw": pa.array([t.hex() for t in ranks])})
        self.db.register("src", table)
        self.db.execute("CREATE TABLE merges AS SELECT * FROM src")
        self.db.register("src2", vocabulary)
        self.db.execute("CREATE TABLE vocabulary AS SELECT * FROM src2")
        self.cache: dict[str, str] = {}

    def _rows(self, words: list[bytes]) -> pa.Table:
        size = np.fromiter(map(len, words), np.int64, len(words))
        raw = np.frombuffer(b"".join(words), np.uint8)
        w = np.repeat(np.arange(len(words), dtype=np.int32), size)
        pos = np.arange(len(raw)) - np.repeat(np.cumsum(size) - size, size)
        return pa.table({"w": w, "pos": pos.astype(np.int32), "id": self.byte[raw]})

    def encode_words(self, words: list[str]) -> list[str]:
        """Ids of each (non-empty) word, joined by blanks."""
        raw = [w.encode() for w in words]
        out = [""] * len(raw)
        short = [i for i, r in enumerate(raw) if len(r) <= LONG]
        for k in range(0, len(short), QUERY_WORDS):
            part = short[k:k + QUERY_WORDS]
            self.db.register("init", self._rows([raw[i] for i in part]))
            got = self.db.sql(_ENCODE).to_arrow_table()
            for i, ids in zip(part, got.column("ids").to_pylist(), strict=True):
                out[i] = ids
        for i in (i for i, r in enumerate(raw) if len(r) > LONG):
            self.db.register("init", self._rows([raw[i]]))
            self.db.execute("CREATE OR REPLACE TEMP TABLE st AS SELECT * FROM init")
            n = len(raw[i])
            while True:
                self.db.execute(_STEP)
                self.db.execute("DROP TABLE st")
                self.db.execute("ALTER TABLE nxt RENAME TO st")
                left = self.db.sql("SELECT count(*) FROM st").fetchall()[0][0]
                if left == n:
                    break
                n = left
            out[i] = self.db.sql("SELECT string_agg(id::VARCHAR, ' ' ORDER BY pos) FROM st").fetchall()[0][0]
        return out

    def decode(self, ids: list[str]) -> list[bytes]:
        """Bytes of each list of ids (joined by blanks): ordered aggregation over the vocabulary."""
        split = [x.split() for x in ids]
        size = [len(x) for x in split]
        rows = pa.table({"w": np.repeat(np.arange(len(split), dtype=np.int32), size), "pos": np.arange(sum(size), dtype=np.int64),
                         "id": pa.array([int(t) for x in split for t in x], pa.int32())})
        self.db.register("coded", rows)
        got = self.db.sql("SELECT w, string_agg(raw, '' ORDER BY pos) AS raw FROM coded JOIN vocabulary USING (id) GROUP BY w").to_arrow_table()
        out = [b""] * len(split)
        for w, raw in zip(got.column("w").to_pylist(), got.column("raw").to_pylist()):
            out[w] = bytes.fromhex(raw)
        return out

    def words(self, text: str) -> list[str]:
        """The matches of the split pattern."""
        first, *rest = _SPACE.split(text)
        out = self.split(first) if first else []
        for part in rest:
            if part.isalpha():
                out.append(" " + part)
            else:
                out += self.split(" " + part)
        return out

    def encode(self, texts: list[str]) -> list[tuple[str, bytes]]:
        """Ids of each text, joined by blanks, and the bytes these ids decode to."""
        cut = [self.words(t) for t in texts]
        wanted = set().union(*cut)
        cache = self.cache
        new = [w for w in wanted if w not in cache]
        if len(cache) + len(new) > CACHE_WORDS:
            cache.clear()
            new = list(wanted)
        for k in range(0, len(new), QUERY_WORDS):
            part = new[k:k + QUERY_WORDS]
            ids = self.encode_words(part)
            for w, i, raw in zip(part, ids, self.decode(ids)):
                if raw != w.encode():
                    raise ValueError("a word does not decode to its bytes")
                cache[w] = i
        # a word's ids decode to its bytes (checked above for every distinct word), a text's to its words' bytes in order
        return [(" ".join([cache[w] for w in c]), "".join(c).encode()) for c in cut]


@lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> Codec:
    return Codec(path, pattern)


def encode_documents(docs: DataFrame, path: str | None = None, pattern: str | None = None, with_ids: bool = False) -> DataFrame:
    """One row per document: ``doc_id``, ``n_tokens``, ``ids_sha256``, ``decoded_sha256`` and, on request, ``ids``."""
    if path is None or pattern is None:
        import public_tokenizers

        path = path or public_tokenizers.path("byte_bpe_50k.tiktoken")
        pattern = pattern or public_tokenizers.PATTERN
    kind = dict(docs.dtypes)["doc_id"]

    def run(batches):
        own = codec(path, pattern)
        for b in batches:
            for lo in range(0, b.num_rows, 2000):
                rows = b.slice(lo, 2000)
                coded = own.encode([x or "" for x in rows.column(1).to_pylist()])
                arrays = [rows.column(0), pa.array([i.count(" ") + 1 if i else 0 for i, _ in coded], pa.int64()),
                          pa.array([hashlib.sha256(i.encode()).hexdigest() for i, _ in coded]),
                          pa.array([hashlib.sha256(raw).hexdigest() for _, raw in coded])]
                names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
                if with_ids:
                    arrays.append(pa.array([[int(t) for t in i.split()] for i, _ in coded], pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(arrays, names)

    schema = f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids
    return docs.select("doc_id", "text").mapInArrow(run, schema)
