"""Best-fit packing with swap-based local search.

Documents become token pieces (only documents longer than a sequence are cut).
Full pieces are sequences of their own. The others are dealt at random into
groups of a bounded number of pieces; a group is packed best-fit decreasing,
then local search works on its underfull sequences: moves, one-for-one and
two-for-one exchanges between a sequence and any fuller one, each raising the
sum of squared fills, until no exchange is left or no packing has fewer
sequences. All sequences that stay underfull are dealt anew to fewer groups and
searched again in a second pass, so the loss per group fades.

Tokens: text splits at blanks and line ends, which the tokenizer drops anyway;
each distinct chunk is encoded once and kept in a bounded cache of the worker.

Defined cases: null text counts as empty (one piece of one id); repeated rows
are packed as often as they occur; null ``doc_id`` is carried along; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left, insort
from collections import defaultdict
from functools import lru_cache
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import written

SEQUENCE = 2048
SEPARATOR = 0  # id after each document
PART = "<|endoftext|>"  # parts chunks on their way to the tokenizer
GROUP_PIECES = 50_000  # pieces packed in one task
CACHE_CHUNKS = 600_000  # distinct chunks a worker remembers
_STOP = re.compile(r"(?<=[a-z])([,.])(?=[ \n]|$)")


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True  # their strings in a text are ordinary text
    closes = np.zeros(t.get_vocab_size(), bool)
    closes[[i for w, i in t.get_vocab().items() if w.endswith("</w>")]] = True
    return t, Tokenizer.from_file(path), {}, closes


def _encode(chunks: list[str], path: str) -> list[bytes]:
    """Ids of each chunk, with few calls of the tokenizer. Chunks of letters are
    single words: they go in one string, and a token that closes a word ends a
    chunk. Other chunks are parted by a special token that none of them contains."""
    plain, special, _, closes = _tokenizer(path)
    letters = [c for c in chunks if c.isalpha()]
    out = {}
    if letters:
        ids = np.array(plain.encode_batch_fast([" ".join(letters)], add_special_tokens=False)[0].ids, "<u4")
        ends = np.flatnonzero(closes[ids]) + 1
        if len(ends) == len(letters):  # else some letters are written as several words
            raw, cut = ids.tobytes(), (4 * ends).tolist()
            out = {c: raw[a:b] for c, a, b in zip(letters, [0, *cut], cut)}
    rest = [c for c in chunks if c not in out]
    if any("<|" in c for c in rest):
        out.update((c, np.array(e.ids, "<u4").tobytes()) for c, e in zip(rest, plain.encode_batch_fast(rest, add_special_tokens=False)))
    elif rest:
        ids = np.array(special.encode_batch_fast([PART.join(rest)], add_special_tokens=False)[0].ids, "<u4")
        raw, cut = ids.tobytes(), (4 * np.flatnonzero(ids == special.token_to_id(PART))).tolist()
        out.update((c, raw[a:b]) for c, a, b in zip(rest, [0, *[x + 4 for x in cut]], [*cut, len(raw)], strict=True))
    return [out[c] for c in chunks]


def token_bytes(texts: list[str], path: str) -> list[bytes]:
    """Ids of each text, with the separator, as little-endian unsigned 32-bit."""
    cache = _tokenizer(path)[2]
    end = np.array([SEPARATOR], "<u4").tobytes()
    # the tokenizer lower-cases and drops blanks: A-Z may be lower-cased and a full stop or comma parted from its word before
    cut = [_STOP.sub(r" \1", t.encode().lower().decode()).replace("\n", " ").split(" ") for t in texts]
    wanted = set().union(*cut)
    new = [c for c in wanted if c not in cache]
    if len(cache) + len(new) > CACHE_CHUNKS:
        cache.clear()
        new = list(wanted)
    for lo in range(0, len(new), 20_000):
        cache.update(zip(new[lo:lo + 20_000], _encode(new[lo:lo + 20_000], path)))
    return [b"".join(map(cache.__getitem__, chunks)) + end for chunks in cut]


def token_pieces(docs: DataFrame, path: str | None = None, size: int = SEQUENCE, with_ids: bool = False) -> DataFrame:
    """``doc_id``, ``piece``, ``start``, ``length``, ``ids_crc32`` and, on request, ``ids`` (array of int)."""
    path = path or vocabulary_path()
    kind = dict(docs.dtypes)["doc_id"]

    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            for lo in range(0, b.num_rows, 256):  # bounds the ids held at once
                rows = b.slice(lo, 256)
                raw = token_bytes([x or "" for x in rows.column(1).to_pylist()], path)
                row, piece, crc, length, ids = [], [], [], [], []
                for i, r in enumerate(raw):
                    for k in range(0, len(r), 4 * size):
                        part = r[k:k + 4 * size]
                        row.append(i)
                        piece.append(k // (4 * size))
                        length.append(len(part) // 4)
                        crc.append(zlib.crc32(part))
                        if with_ids:
                            ids.append(np.frombuffer(part, "<u4").astype(np.int32))
                n = np.array(piece, np.int32)
                arrays = [rows.column(0).take(pa.array(row, pa.int64())), pa.array(n), pa.array(n.astype(np.int64) * size),
                          pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    arrays.append(pa.array(ids, pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(arrays, names)

    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def best_fit(lengths: np.ndarray, size: int) -> list[list[int]]:
    """Best-fit decreasing: bins as lists of indexes."""
    bins: list[list[int]] = []
    rooms: list[int] = []  # ascending distinct free room
    by_room: dict[int, list[int]] = {}
    for i in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[i])
        at = bisect_left(rooms, n)
        if at < len(rooms):
            room = rooms[at]
            b = by_room[room].pop()
            if not by_room[room]:
                del by_room[room]
                rooms.pop(at)
        else:
            room, b = size, len(bins)
            bins.append([])
        bins[b].append(i)
        room -= n
        if room:
            if room not in by_room:
                insort(rooms, room)
                by_room[room] = []
            by_room[room].append(b)
    return bins


class _Open:
    """Open bins by what they can take: a bin with room ``r`` that gives back a
    length ``y`` (0: nothing) takes any total up to ``r + y``. Entries of a bin
    that changed since are dropped when they come up."""

    def __init__(self, size: int):
        self.reach = np.full(size + 1, -1)  # by length given back: the greatest total that some open bin takes
        self.by_length: dict[int, list] = defaultdict(list)  # heaps, most room first
        self.by_total: dict[int, list] = defaultdict(list)  # totals that fill a bin
        self.version: dict[int, int] = defaultdict(int)

    def _first(self, y: int):
        heap = self.by_length[y]
        while heap and self.version[heap[0][1]] != heap[0][2]:
            heappop(heap)
        self.reach[y] = y - heap[0][0] if heap else -1
        return heap[0][1] if heap else None

    def enter(self, b: int, room: int, held: dict[int, list[int]]) -> None:
        for y in (0, *held):
            heappush(self.by_length[y], (-room, b, self.version[b]))
            self.by_total[room + y].append((b, self.version[b], y))
            self._first(y)

    def leave(self, b: int, held: dict[int, list[int]]) -> None:
        self.version[b] += 1
        for y in (0, *held):
            self._first(y)

    def filling(self, totals) -> tuple[int, int, int] | None:
        """(total, length given back, bin) of the greatest gain that fills a bin."""
        best = None
        for t in totals:
            entries = self.by_total.get(t, ())
            while entries and self.version[entries[-1][0]] != entries[-1][1]:
                entries.pop()
            if entries and (best is None or t - entries[-1][2] > best[0] - best[1]):
                best = t, entries[-1][2], entries[-1][0]
        return best

    def fitting(self, totals) -> tuple[int, int, int] | None:
        """(total, length given back, bin) of the greatest gain that a bin has room for."""
        t = np.array(list(totals))
        if not len(t):
            return None
        takes = (self.reach >= t[:, None]) & (np.arange(len(self.reach)) < t[:, None])
        y = takes.argmax(axis=1)  # the least length given back
        gain = np.where(takes.any(axis=1), t - y, 0)
        k = int(gain.argmax())
        return (int(t[k]), int(y[k]), self._first(int(y[k]))) if gain[k] else None


def _sweep(work: list[list[int]], n: list[int], size: int) -> tuple[list[list[int]], bool]:
    """One pass from the emptiest bin on; partners are all fuller bins with room."""
    fill = [sum(n[i] for i in b) for b in work]
    order = sorted(range(len(work)), key=fill.__getitem__)
    held: list[dict[int, list[int]]] = [defaultdict(list) for _ in work]
    for b, members in enumerate(work):
        for i in members:
            held[b][n[i]].append(i)
    bins = _Open(size)
    for b in order:
        bins.enter(b, size - fill[b], held[b])
    changed = False
    for a in order:
        mine = held[a]
        if fill[a] == size:  # filled in this sweep, no longer among the open ones
            continue
        bins.leave(a, mine)
        while mine:
            ones = {x: (x,) for x in mine}
            lengths = sorted(mine, reverse=True)
            twos = {x + z: (x, z) for k, x in enumerate(lengths) for z in lengths[k:] if x != z or len(mine[x]) > 1}
            takes = {**twos, **ones}
            found = bins.filling(takes) or bins.fitting(ones) or bins.fitting(twos)
            if not found:
                break
            total, y, p = found
            bins.leave(p, held[p])
            moved = [(mine, held[p], x) for x in takes[total]] + [(held[p], mine, y)] * (y > 0)
            moved = [(source, target, x, source[x].pop()) for source, target, x in moved]
            for source, target, x, i in moved:
                target[x].append(i)
            for source, _, x, _ in moved:
                if x in source and not source[x]:
                    del source[x]
            fill[a] -= total - y
            fill[p] += total - y
            if fill[p] < size:
                bins.enter(p, size - fill[p], held[p])
            changed = True
    return [sum(h.values(), []) for h in held if h], changed


def local_search(bins: list[list[int]], lengths: np.ndarray, size: int) -> list[list[int]]:
    """Empty underfull bins: from the emptiest bin on, exchange one or two of its
    documents for one or none of any fuller bin when that raises the sum of
    squared fills (the fuller bin gets fuller), those that fill a bin first.
    Sweeps go on until none changes or no packing has fewer bins."""
    n = lengths.tolist()
    full: list[list[int]] = []
    work = [list(b) for b in bins]
    changed = True
    while changed:
        full += [b for b in work if sum(n[i] for i in b) == size]
        work = [b for b in work if sum(n[i] for i in b) < size]
        if len(work) <= -(-sum(n[i] for b in work for i in b) // size):
            break
        work, changed = _sweep(work, n, size)
    return full + work


def pack_lengths(lengths: np.ndarray, size: int = SEQUENCE, bins: list[list[int]] | None = None) -> list[list[int]]:
    """Packed afresh or, if that has no more bins, from given ones."""
    fresh = best_fit(lengths, size)
    return local_search(fresh if bins is None or len(fresh) < len(bins) else bins, lengths, size)


def _packed(pieces: DataFrame, group: str, size: int, base: int) -> DataFrame:
    """Sets ``sequence_id``, ``offset`` and ``fill`` (of the sequence) per group;
    pieces that have a sequence already come with all of it and start in it."""
    cols = [c for c in pieces.columns if c not in ("sequence_id", "offset", "fill")]
    given = len(cols) < len(pieces.columns)

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        n = table.column("length").to_numpy()
        seq, off, fill = (np.zeros(len(n), np.int64) for _ in range(3))
        bins = None
        if given:
            of = table.column("sequence_id").to_numpy()
            order = np.argsort(of, kind="stable")
            bins = [b.tolist() for b in np.split(order, np.flatnonzero(np.diff(of[order])) + 1)]
        for s, members in enumerate(pack_lengths(n, size, bins)):
            at = np.cumsum(n[members]) - n[members]
            seq[members], off[members], fill[members] = base + (key[0].as_py() << 24) + s, at, n[members].sum()
        return table.select(cols).append_column("sequence_id", pa.array(seq)).append_column("offset", pa.array(off)).append_column("fill", pa.array(fill))

    kinds = ", ".join(f"`{c}` {t}" for c, t in pieces.select(*cols).dtypes)
    return pieces.groupBy(group).applyInArrow(run, f"{kinds}, sequence_id long, offset long, fill long").drop(group)


def pack(pieces: DataFrame, size: int = SEQUENCE) -> DataFrame:
    """``pieces`` (with ``length``) and their ``sequence_id`` and ``offset``."""
    cols = pieces.columns
    whole = pieces.where(F.col("length") == size)
    rest = pieces.where(F.col("length") < size)
    rest = written(rest, "op6-rest")

    def dealt(df: DataFrame, rows: int, by: list[str]) -> DataFrame:
        groups = max(1, -(-rows // GROUP_PIECES))
        return df.withColumn("grp", F.pmod(F.xxhash64(*[F.col(c) for c in by]), F.lit(groups)).cast("long"))

    rows = rest.count()
    first = written(_packed(dealt(rest, rows, cols), "grp", size, 1 << 60), "op6-first")
    if rows > GROUP_PIECES:
        again = first.where(F.col("fill") < size)
        second = _packed(dealt(again, again.count(), ["sequence_id"]), "grp", size, 1 << 61)
        placed = first.where(F.col("fill") == size).unionByName(second)
    else:
        placed = first
    alone = whole.select(*cols, F.monotonically_increasing_id().alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return placed.select(*cols, "sequence_id", "offset").unionByName(alone)


def pack_documents(docs: DataFrame, path: str | None = None, size: int = SEQUENCE) -> DataFrame:
    """One row per piece: ``doc_id``, ``piece``, ``start``, ``length``, ``ids_crc32``, ``sequence_id``, ``offset``."""
    return pack(written(token_pieces(docs, path, size), "op6-pieces"), size)


def sequences(docs: DataFrame, placed: DataFrame, path: str | None = None, size: int = SEQUENCE) -> DataFrame:
    """The packed token sequences themselves: ``sequence_id``, ``ids`` (at most ``size``)."""
    ids = token_pieces(docs, path, size, with_ids=True).select("doc_id", "piece", "ids_crc32", "ids").distinct()
    rows = placed.join(ids, (placed["doc_id"].eqNullSafe(ids["doc_id"])) & (placed["piece"] == ids["piece"])
                       & (placed["ids_crc32"] == ids["ids_crc32"]))
    rows = rows.select(placed["sequence_id"], placed["offset"], ids["ids"])
    return rows.groupBy("sequence_id").agg(F.flatten(F.transform(
        F.array_sort(F.collect_list(F.struct("offset", "ids"))), lambda x: x["ids"])).alias("ids"))
