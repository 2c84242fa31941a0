"""Suffix-array dedup: bytes of repeated 100-byte strings, by grouping construction.

A string of ``N`` bytes is placed by its anchor: the leftmost of its ``K``-byte
grams of least hash. Equal strings have equal anchors at equal offsets. The
strings of one document that share an anchor place form its context (at most
``2 N - K`` bytes), so a document has about one context for 30 bytes.

1. Scan. Each partition lists the contexts of its documents and keeps the first
   of equal ones (pre-aggregation: a hot passage leaves one row a partition);
   all strings of the others start earlier elsewhere and are removed.
2. Merge. Contexts meet by anchor hash; again only the first of equal contexts
   stays. Anchors with one context are done: nothing else can equal it.
3. Suffix arrays. The remaining first contexts of an anchor are concatenated in
   blocks of ``BLOCK``; linear grouping construction sorts their suffixes, and
   neighbours with a common prefix of ``N`` bytes are copies: all but the first
   are removed. Orders of several blocks of one anchor merge by their strings,
   compared byte by byte. Anchors above ``WIDE`` contexts are dealt to several
   tasks, whose remaining strings merge by hash with map-side combine.
4. Removed spans are gathered per document and cut from its bytes.

Order of places: (doc_id, a checksum of the text, start). Every step has
bounded memory: a partition's or bucket's contexts at about 30 bytes each, and
the suffix arrays' batches.

Defined cases: null text counts as empty (0 bytes); texts below ``N`` bytes keep
all; rows with equal ``doc_id`` and text are one document (all get the same
result, none removes from the other); rows with equal ``doc_id`` and different
text are told apart by a checksum; null ``doc_id`` sorts first, by a hash of
the text, so that many such rows are told apart by 64 bits; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import body, written
from tidemark.llm.suffix_groups import suffix_arrays

N = 100  # bytes of a repeated string
K = 32  # bytes of an anchor gram
CHUNK = 1 << 20  # longer texts are scanned in overlapping chunks
FLUSH = 600_000  # contexts a partition sorts at once
BUCKET_BYTES = 16_000_000  # text behind one merge bucket
BLOCK = 16  # contexts of one suffix array
TASK_CONTEXTS = 6000  # contexts of the suffix arrays built in one task
WIDE = 16_384  # contexts of one anchor that one task takes
BATCH = 700_000  # suffixes sorted in lockstep
NULL_ID, NULL_SPAN = -(1 << 63), (1 << 48) - 1  # rows without an id are placed first, by 48 bits of a hash of their text

_ODD = 0x9E3779B97F4A7C15


def _powers(x: int) -> np.ndarray:
    t = np.full(CHUNK + 1, x, np.uint64)
    t[0] = 1
    return np.multiply.accumulate(t)


_POWER: list[np.ndarray] = []


def _tables() -> list[np.ndarray]:
    if not _POWER:
        _POWER.extend((_powers(_ODD), _powers(pow(_ODD, -1, 1 << 64)), np.arange(CHUNK, dtype=np.uint64)))
    return _POWER


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def _prefix(b: np.ndarray) -> np.ndarray:
    """Prefix sums of the polynomial hash (modulo 2^64)."""
    c = np.zeros(len(b) + 1, np.uint64)
    np.cumsum((b.astype(np.uint64) + np.uint64(1)) * _tables()[0][:len(b)], out=c[1:])
    return c


def contexts(b: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of a text (``N`` to ``CHUNK`` bytes): anchor place, first and last start of
    its strings, anchor hash, context hash."""
    _, inverse, place = _tables()
    n, wide = len(b), N - K + 1
    c = _prefix(b)
    gram = _mix((c[K:] - c[:-K]) * inverse[:n - K + 1])
    low = np.uint64(CHUNK - 1)
    least = (gram & ~low) | place[:len(gram)]  # leftmost among equal leading bits
    span = 1
    while span * 2 <= wide:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if span < wide:
        least = np.minimum(least[:n - N + 1], least[wide - span:wide - span + n - N + 1])
    x = (least & low).astype(np.int64)
    first = np.flatnonzero(np.concatenate(([True], x[1:] != x[:-1])))
    last = np.append(first[1:], len(x)) - 1
    x = x[first]
    shape = ((x - first) << 8 | (last - first)).astype(np.uint64)
    return x, first, last, gram[x], _mix((c[last + N] - c[first]) * inverse[first] + _mix(shape))


# one context: anchor hash, context hash (48 bits), doc_id, checksum of the text, anchor place, distance to first and last start
_FIELDS = [("h", np.uint64), ("c0", np.uint32), ("c1", np.uint16), ("d", np.int64), ("t", np.uint16), ("x", np.int32), ("p", np.uint8), ("q", np.uint8)]


def _join(parts: list[dict]) -> dict:
    return {k: np.concatenate([p[k] for p in parts]) for k, _ in _FIELDS}


def _pack(c: dict, rows: np.ndarray) -> bytes:
    return b"".join(c[k][rows].tobytes() for k, _ in _FIELDS)


def _unpack(raw: bytes) -> dict:
    n = len(raw) // sum(np.dtype(t).itemsize for _, t in _FIELDS)
    out, at = {}, 0
    for k, t in _FIELDS:
        out[k] = np.frombuffer(raw, t, n, at)
        at += n * np.dtype(t).itemsize
    return out


def _firsts(c: dict) -> tuple[dict, np.ndarray]:
    """Contexts ordered by (anchor, context, place), and which of them are at
    the first place of their kind (repeated rows of a document share a place)."""
    order = np.lexsort((c["x"], c["t"], c["d"], c["c1"], c["c0"], c["h"]))
    c = {k: v[order] for k, v in c.items()}
    if not len(order):
        return c, np.zeros(0, bool)
    same = np.concatenate(([False], np.logical_and.reduce([c[k][1:] == c[k][:-1] for k in ("h", "c0", "c1")])))
    head = np.maximum.accumulate(np.where(same, 0, np.arange(len(same))))
    return c, np.logical_and.reduce([c[k] == c[k][head] for k in ("d", "t", "x")])


def _spans(d: np.ndarray, t: np.ndarray, s: np.ndarray, e: np.ndarray):
    """Joined spans per document: (doc_id, checksum, bytes of int32 pairs)."""
    order = np.lexsort((s, t, d))
    d, t, s, e = d[order], t[order], s[order], e[order]
    if not len(d):
        return
    doc = np.concatenate(([True], (d[1:] != d[:-1]) | (t[1:] != t[:-1])))
    # spans of a document ascend in start; their ends nearly do: the running maximum is taken per document
    base = np.cumsum(doc) << 32
    reach = np.maximum.accumulate(base + e) - base
    opens = doc | np.concatenate(([True], s[1:] > reach[:-1]))
    o = np.flatnonzero(opens)
    pairs = np.stack((s[o], reach[np.append(o[1:], len(s)) - 1]), 1).astype(np.int32)
    cut = np.flatnonzero(doc[o])
    for at, part in zip(o[cut], np.split(pairs, cut[1:])):
        yield int(d[at]), int(t[at]), part.tobytes()


_ROWS = "kind int, bucket long, d long, t int, raw binary"


def _rows(kind: int, items: list[tuple]) -> pa.RecordBatch:
    """Rows of (bucket, doc_id, checksum, bytes)."""
    b, d, t, raw = zip(*items) if items else ((), (), (), ())
    return pa.RecordBatch.from_arrays(
        [pa.array([kind] * len(items), pa.int32()), pa.array(b, pa.int64()), pa.array(d, pa.int64()), pa.array(t, pa.int32()),
         pa.array(raw, pa.binary())], ["kind", "bucket", "d", "t", "raw"])


CONTEXTS, REMOVED, FIRST, STRINGS = range(4)  # kinds of rows


def _scan(docs: DataFrame, buckets: int) -> DataFrame:
    """Step 1: rows of contexts by bucket, and of removed spans."""
    def run(batches):
        held, size = [], 0

        def flush():
            c, first = _firsts(_join(held))
            gone = np.flatnonzero(~first)
            x = c["x"][gone].astype(np.int64)
            spans = _spans(c["d"][gone], c["t"][gone], x - c["p"][gone], x - c["q"][gone] + N)
            yield _rows(REMOVED, [(hash((d, t)) % buckets, d, t, raw) for d, t, raw in spans])
            stay = np.flatnonzero(first)
            bucket = (c["h"][stay] % np.uint64(buckets)).astype(np.int64)
            stay = stay[np.argsort(bucket, kind="stable")]
            bucket = np.sort(bucket)
            cut = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1]))) if len(bucket) else bucket
            yield _rows(CONTEXTS, [(int(bucket[a]), 0, 0, _pack(c, part)) for a, part in zip(cut, np.split(stay, cut[1:]))])

        for batch in batches:
            for d, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                raw = (text.as_py() or "").encode()
                d = NULL_ID + (xxhash.xxh64_intdigest(raw, 42) & NULL_SPAN) if d is None else d
                b, check = np.frombuffer(raw, np.uint8), zlib.crc32(raw) & 0xFFFF
                for at in range(0, len(b) - N + 1, CHUNK - N + 1):
                    x, first, last, h, c = contexts(b[at:at + CHUNK])
                    held.append({"h": h, "c0": c.astype(np.uint32), "c1": (c >> np.uint64(32)).astype(np.uint16),
                                 "d": np.full(len(x), d, np.int64), "t": np.full(len(x), check, np.uint16),
                                 "x": (x + at).astype(np.int32), "p": (x - first).astype(np.uint8), "q": (x - last).astype(np.uint8)})
                    size += len(x)
                if size >= FLUSH:
                    yield from flush()
                    held, size = [], 0
        if size:
            yield from flush()

    return docs.select("doc_id", "text").mapInArrow(run, _ROWS)


def _merge(rows: DataFrame) -> DataFrame:
    """Step 2: spans of contexts that are not the first of their kind, and the
    first contexts of anchors that have several (anchor, block of a wide anchor, starts)."""
    def run(table: pa.Table) -> pa.Table:
        kind = table.column("kind").to_numpy()
        passed = table.filter(pa.array(kind == REMOVED))
        raw = table.filter(pa.array(kind == CONTEXTS)).column("raw").to_pylist()
        batches = [*passed.to_batches()]
        if raw:
            c, first = _firsts(_join([_unpack(r) for r in raw]))
            gone = np.flatnonzero(~first)
            x = c["x"].astype(np.int64)
            s, e = x - c["p"], x - c["q"]
            batches.append(_rows(REMOVED, [(0, d, t, r) for d, t, r in _spans(c["d"][gone], c["t"][gone], s[gone], e[gone] + N)]))
            # first contexts by anchor; twins of one document count once
            keep = np.flatnonzero(first)
            twin = np.concatenate(([False], np.logical_and.reduce([c[k][keep][1:] == c[k][keep][:-1] for k in ("h", "c0", "c1", "d", "t", "x")]))) \
                if len(keep) else np.zeros(0, bool)
            keep = keep[~twin]
            h = c["h"][keep]
            opens = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1]))) if len(h) else np.zeros(0, np.int64)
            many = np.diff(np.append(opens, len(h)))
            nth = np.arange(len(h)) - np.repeat(opens, many)
            many = np.repeat(many, many)
            several = many > 1
            part = np.where(many > WIDE, 1 + nth // WIDE, 0)[several]
            keep = keep[several]
            record = np.stack((c["h"][keep].view(np.int64), part, s[keep], e[keep]), 1)
            order = np.lexsort((c["t"][keep], c["d"][keep]))
            d, t, record = c["d"][keep][order], c["t"][keep][order], record[order]
            cut = np.flatnonzero(np.concatenate(([True], (d[1:] != d[:-1]) | (t[1:] != t[:-1])))) if len(d) else np.zeros(0, np.int64)
            batches.append(_rows(FIRST, [(0, int(d[a]), int(t[a]), p.tobytes()) for a, p in zip(cut, np.split(record, cut[1:]))]))
        return pa.Table.from_batches([b.select(["kind", "d", "t", "raw"]) for b in batches],
                                     pa.schema([("kind", pa.int32()), ("d", pa.int64()), ("t", pa.int32()), ("raw", pa.binary())]))

    return rows.groupBy("bucket").applyInArrow(run, "kind int, d long, t int, raw binary")


def _cut(firsts: DataFrame, docs: DataFrame) -> DataFrame:
    """The bytes of the first contexts: ``unit`` (anchor and block), ``wide``, place, ``s``, ``starts``, ``raw``."""
    lists = firsts.groupBy("d", "t").agg(F.collect_list("raw").alias("lists"))
    pairs = lists.join(docs, ["d", "t"])

    def run(batches):
        for batch in batches:
            d, t, raws, texts = (batch.column(k).to_pylist() for k in range(4))
            out = []
            for i in range(len(d)):
                b = texts[i].encode()
                r = np.frombuffer(b"".join(raws[i]), np.int64).reshape(-1, 4)
                unit = _mix(r[:, 0].view(np.uint64) + _mix(r[:, 1].astype(np.uint64))).view(np.int64)
                out += [(int(u), bool(p), d[i], t[i], int(s), int(e - s + 1), b[s:e + N]) for u, p, s, e in zip(unit, r[:, 1], r[:, 2], r[:, 3])]
            if out:
                u, p, dd, tt, s, n, raw = zip(*out)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(u, pa.int64()), pa.array(p), pa.array(dd, pa.int64()), pa.array(tt, pa.int32()), pa.array(s, pa.int32()),
                     pa.array(n, pa.int32()), pa.array(raw, pa.binary())], ["unit", "wide", "d", "t", "s", "starts", "raw"])

    return pairs.select("d", "t", "lists", "text").mapInArrow(run, "unit long, wide boolean, d long, t int, s int, starts int, raw binary")


def _later_copies(unit: np.ndarray, raw: list[bytes], starts: np.ndarray, block_size: int = BLOCK) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Step 3 in a task. Contexts come ordered by (unit, place); contexts of a
    unit share an anchor. Returns the bytes of all contexts, the starts of all
    strings in them, and which strings have an earlier copy in their unit."""
    size = np.fromiter(map(len, raw), np.int64, len(raw))
    off = np.cumsum(size) - size
    buf = np.frombuffer(b"".join(raw), np.uint8)
    window = np.lib.stride_tricks.sliding_window_view(buf, N)
    is_start = np.zeros(len(buf), bool)
    at = np.repeat(off, starts) + np.arange(starts.sum()) - np.repeat(np.cumsum(starts) - starts, starts)
    is_start[at] = True
    later = np.zeros(len(buf), bool)
    opens = np.flatnonzero(np.concatenate(([True], unit[1:] != unit[:-1])))
    many = np.diff(np.append(opens, len(unit)))
    nth = np.arange(len(unit)) - np.repeat(opens, many)
    # blocks of contexts: each becomes one string with separators
    new_block = nth % block_size == 0
    block = np.cumsum(new_block) - 1
    first = np.flatnonzero(new_block)
    length = np.add.reduceat(size + 1, first) + 1
    alone = np.diff(np.append(first, len(unit))) == 1
    todo = np.flatnonzero(~alone)
    todo = todo[np.argsort(length[todo], kind="stable")]
    k = 0
    while k < len(todo):
        n = 1
        while k + n < len(todo) and (n + 1) * length[todo[k + n]] <= BATCH:
            n += 1
        mine = todo[k:k + n]
        k += n
        wide = int(length[mine].max())
        row_of = np.full(len(first), -1, np.int64)
        row_of[mine] = np.arange(n)
        ctx = np.flatnonzero(row_of[block] >= 0)
        row = row_of[block[ctx]]
        col = (off[ctx] + ctx) - (off[first[block[ctx]]] + first[block[ctx]])  # one separator after each context
        source = np.repeat(off[ctx] - (np.cumsum(size[ctx]) - size[ctx]), size[ctx]) + np.arange(size[ctx].sum())
        target = np.repeat(row * wide + col - (np.cumsum(size[ctx]) - size[ctx]), size[ctx]) + np.arange(size[ctx].sum())
        text = np.full(n * wide, -1, np.int32)
        origin = np.full(n * wide, -1, np.int64)
        text[target] = buf[source].astype(np.int32) + 2
        origin[target] = source
        text[row * wide + col + size[ctx]] = 1
        text[np.arange(n) * wide + length[mine] - 1] = 0
        order = suffix_arrays(text.reshape(n, wide), length[mine])
        flat = (order + np.arange(n)[:, None] * wide)[order >= 0]
        seq, seq_row = origin[flat], flat // wide
        good = np.flatnonzero((seq >= 0) & is_start[seq])
        seq, seq_row = seq[good], seq_row[good]
        same = np.zeros(len(seq), bool)
        for lo in range(1, len(seq), 100_000):  # common prefix of neighbours in the suffix array
            hi = min(len(seq), lo + 100_000)
            same[lo:hi] = (seq_row[lo:hi] == seq_row[lo - 1:hi - 1]) & (window[seq[lo:hi]] == window[seq[lo - 1:hi - 1]]).all(axis=1)
        head = np.flatnonzero(~same)
        least = np.repeat(np.minimum.reduceat(seq, head), np.diff(np.append(head, len(seq)))) if len(seq) else seq
        later[seq[seq != least]] = True
    # merge the blocks of a unit: strings that are first in their block, by hash, equality by bytes
    several = np.repeat(many > block_size, many)
    if several.any():
        c = np.concatenate([_window_hash(buf[lo:lo + CHUNK]) for lo in range(0, len(buf), CHUNK - N + 1) if len(buf) - lo >= N])
        place = at[np.repeat(several, starts) & ~later[at]]
        of = np.repeat(np.arange(len(raw)), starts)[np.repeat(several, starts) & ~later[at]]
        order = np.lexsort((place, c[place], unit[of]))
        place, of = place[order], of[order]
        same = np.concatenate(([False], (unit[of][1:] == unit[of][:-1]) & (c[place][1:] == c[place][:-1])))
        pairs = np.flatnonzero(same)
        for lo in range(0, len(pairs), 100_000):
            p = pairs[lo:lo + 100_000]
            if not (window[place[p]] == window[place[p - 1]]).all():
                raise ValueError("two different strings share a hash")
        later[place[same]] = True
    return buf, at, later[at]


def _window_hash(b: np.ndarray) -> np.ndarray:
    c = _prefix(b)
    return _mix((c[N:] - c[:-N]) * _tables()[1][:len(b) - N + 1])


def _suffix_arrays(cuts: DataFrame, tasks: int) -> DataFrame:
    """Step 3: removed spans, and the strings of wide anchors that are first in their task."""
    def run(table: pa.Table) -> pa.Table:
        unit, d, t, s, starts = (table.column(k).to_numpy() for k in ("unit", "d", "t", "s", "starts"))
        order = np.lexsort((s, t, d, unit))
        raw = table.column("raw").to_pylist()
        raw = [raw[i] for i in order]
        wide = table.column("wide").to_numpy(zero_copy_only=False)[order]
        unit, d, t, s, starts = unit[order], d[order], t[order], s[order].astype(np.int64), starts[order].astype(np.int64)
        buf, at, later = _later_copies(unit, raw, starts, BLOCK)
        of = np.repeat(np.arange(len(raw)), starts)
        begin = s[of] + np.arange(len(of)) - np.repeat(np.cumsum(starts) - starts, starts)
        gone = np.flatnonzero(later)
        batches = [_rows(REMOVED, [(0, a, b, r) for a, b, r in _spans(d[of[gone]], t[of[gone]], begin[gone], begin[gone] + N)])]
        left = np.flatnonzero(~later & wide[of])
        # bucket holds the start of the string, raw its hash
        batches.append(_rows(STRINGS, [(int(begin[i]), int(d[of[i]]), int(t[of[i]]), hashlib.blake2b(buf[at[i]:at[i] + N], digest_size=16).digest()) for i in left]))
        return pa.Table.from_batches(batches).select(["kind", "bucket", "d", "t", "raw"])

    return cuts.groupBy(F.pmod(F.col("unit"), F.lit(tasks)).alias("task")).applyInArrow(run, _ROWS)


def _place(id_column: str) -> Column:
    return F.coalesce(id_column, F.lit(NULL_ID) + F.xxhash64("text").bitwiseAND(F.lit(NULL_SPAN)))


def removed_spans(docs: DataFrame) -> DataFrame:
    """Spans to remove: ``d`` (doc_id, null as the least long), ``t`` (checksum of
    the text), ``spans`` (array of int32 pairs as bytes; they may overlap)."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    marks = written(_merge(_scan(docs, size // BUCKET_BYTES + 1)), "op8-marks")
    keyed = docs.where("text is not null").select(_place("doc_id").alias("d"),
                                                  F.crc32(F.col("text").cast("binary")).bitwiseAND(0xFFFF).cast("int").alias("t"), "text")
    # repeated rows count once, else a first context would meet itself as a later copy
    keyed = keyed.groupBy("d", "t").agg(F.any_value("text").alias("text"))
    firsts = marks.where(F.col("kind") == FIRST).select("d", "t", "raw")
    tasks = (firsts.agg(F.sum(F.octet_length("raw"))).first()[0] or 0) // 32 // TASK_CONTEXTS + 1
    found = written(_suffix_arrays(_cut(firsts, keyed), tasks), "op8-found")
    spans = marks.where(F.col("kind") == REMOVED).select("d", "t", "raw").unionByName(
        found.where(F.col("kind") == REMOVED).select("d", "t", "raw"))
    strings = found.where(F.col("kind") == STRINGS).select("raw", "d", "t", F.col("bucket").cast("int").alias("s"))
    least = strings.groupBy("raw").agg(F.min(F.struct("d", "t", "s")).alias("least"), F.count(F.lit(1)).alias("n")).where("n > 1")
    copies = strings.join(least, "raw").where(F.struct("d", "t", "s") != F.col("least")).select("d", "t", "s")

    def pair(batches):
        for b in batches:
            s = b.column(2).to_numpy().astype(np.int32)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([x.tobytes() for x in np.stack((s, s + N), 1)], pa.binary())],
                                             ["d", "t", "raw"])

    spans = spans.unionByName(copies.mapInArrow(pair, "d long, t int, raw binary"))
    return spans.groupBy("d", "t").agg(F.collect_list("raw").alias("spans"))


def substring_dedup(docs: DataFrame, with_text: bool = False) -> DataFrame:
    """One row per document: ``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans``,
    ``kept_sha256`` and, on request, ``kept`` (the remaining bytes)."""
    spans = written(removed_spans(docs), "op8-spans")
    text = docs.select("doc_id", body().alias("text"))
    keyed = text.withColumn("d", _place("doc_id")).withColumn(
        "t", F.crc32(F.col("text").cast("binary")).bitwiseAND(0xFFFF).cast("int"))
    kind = dict(docs.dtypes)["doc_id"]

    def run(batches):
        for batch in batches:
            rows = []
            for text, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                b = np.frombuffer(text.encode(), np.uint8)
                change = np.zeros(len(b) + 1, np.int64)
                if spans:
                    p = np.frombuffer(b"".join(spans), np.int32).reshape(-1, 2)
                    np.add.at(change, p[:, 0], 1)
                    np.add.at(change, p[:, 1], -1)
                gone = np.cumsum(change)[:-1] > 0
                kept = b[~gone].tobytes() if spans else b.tobytes()
                n_spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum()) if len(b) else 0
                rows.append((len(b), int(gone.sum()), n_spans, hashlib.sha256(kept).hexdigest(), kept))
            n, r, s, sha, kept = zip(*rows) if rows else ((),) * 5
            arrays = [batch.column(0), pa.array(n, pa.int64()), pa.array(r, pa.int64()), pa.array(s, pa.int64()), pa.array(sha, pa.string())]
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
            if with_text:
                arrays.append(pa.array(kept, pa.binary()))
                names.append("kept")
            yield pa.RecordBatch.from_arrays(arrays, names)

    schema = f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * with_text
    return keyed.join(spans, ["d", "t"], "left").select("doc_id", "text", "spans").mapInArrow(run, schema)
