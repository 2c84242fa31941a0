"""Exact ranked search with a K2-treap over the grid of terms and documents.

Documents are dealt into shards of about ``POSTINGS`` postings. A shard is a
grid with a row a term and a column a document; its points hold the impact of
the term in the document. The grid is a quadtree of square cells in which only
non-empty cells are stored, level by level (a mask of the four children, the
place of the first child, and the highest impact inside the cell).

For an item, the row paths of its terms descend together over ranges of
documents: a range carries one cell a term, and the weighted sum of the cells'
maxima bounds the score of every document in the range; at the last level the
sum is the score. The frontier is taken best first, in vectorised batches (its
better half at a time); ranges below the k-th score found so far are dropped.
So a shard's top k are exact. The first shard's k-th scores are the starting
thresholds of all others. Rows are numbered by document frequency (rare terms
share cells with rare terms) and columns by document length, which keeps the
maxima tight.

Items are handled in blocks of at most ``BLOCK_TERMS`` term occurrences, so
the vocabulary and the items that a task holds are bounded; each block is one
pass over the texts. A frontier holds about ``POINTERS`` cell numbers; beyond
that its deepest ranges are taken first, which changes the order only.

Defined cases: null or empty text has no term and is never returned; rows
with a null id are documents, placed after equal scores with an id; repeated
rows are documents of their own; an item row that occurs several times is
answered as often, items that share an id are answered each; an item without
a term that occurs returns nothing; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import written
from tidemark.session import ship_package

K = 50
POSTINGS = 2_000_000  # of a shard, about
BLOCK_TERMS = 200_000  # of a block of items; one longer item is a block of its own
POINTERS = 4_000_000  # cell numbers that a frontier holds, about
BATCH = 256  # ranges taken at least, if there are as many

# fixed values of the score
TF_SCALE, TF_GAIN, LENGTH_GAIN, BASE, SHARE, WEIGHT_SCALE = 1_000_000_000, 1000, 20, 50, 50, 1000

# bytes that belong to a term (0-9, A-Z, a-z, all of non-ASCII) and A-Z lower-cased; all others separate
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_POP = np.array([bin(i).count("1") for i in range(16)], np.int32)


def terms(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_FOLD).split()


class Treap:
    """Quadtree over (row, column) points with the highest value in each cell."""

    def __init__(self, row: np.ndarray, column: np.ndarray, value: np.ndarray, rows: int, columns: int):
        row_bits, column_bits = max(1, (rows - 1).bit_length()), max(1, (columns - 1).bit_length())
        self.height = max(row_bits, column_bits)
        self.row_shift, self.column_shift = self.height - row_bits, self.height - column_bits
        code = _spread(row.astype(np.int64) << self.row_shift) << 1 | _spread(column.astype(np.int64) << self.column_shift)
        order = np.argsort(code)
        code, top = code[order], value[order].astype(np.int32)
        tops, masks, firsts = [top], [np.zeros(len(code), np.uint8)], [np.zeros(len(code), np.int32)]
        for _ in range(self.height):
            up = code >> 2
            start = np.flatnonzero(np.concatenate(([True], up[1:] != up[:-1])))
            masks.append(np.bitwise_or.reduceat(np.left_shift(1, code & 3).astype(np.uint8), start))
            firsts.append(start.astype(np.int32))
            top = np.maximum.reduceat(top, start)
            tops.append(top)
            code = up[start]
        # root first; each level's children start where the next level does; one empty cell ends the list
        sizes = np.array([len(t) for t in reversed(tops)])
        at = np.concatenate(([0], np.cumsum(sizes)))
        self.top = np.concatenate([*reversed(tops), [0]])
        self.mask = np.concatenate([*reversed(masks), [0]]).astype(np.uint8)
        self.first = np.concatenate([f + at[i + 1] for i, f in enumerate(reversed(firsts))] + [[0]]).astype(np.int32)
        self.empty = len(self.top) - 1

    def child(self, cell: np.ndarray, quadrant: np.ndarray) -> np.ndarray:
        """Cell number of the quadrant (row half * 2 + column half) of each cell, the empty cell if it has no point."""
        mask = self.mask[cell]
        has = mask >> quadrant & 1
        return np.where(has == 1, self.first[cell] + _POP[mask & ((1 << quadrant) - 1)], self.empty)

    def best(self, rows: np.ndarray, weights: np.ndarray, tie: np.ndarray, k: int, least: int) -> tuple[np.ndarray, np.ndarray]:
        """Columns and scores of the ``k`` best columns for the weighted rows,
        scores of at least ``least``; equal scores by ``tie``."""
        path = rows.astype(np.int64) << self.row_shift
        width = len(rows)
        bound = np.array([(self.top[0] * weights).sum()])
        level, low = np.zeros(1, np.int64), np.zeros(1, np.int64)
        cells = np.zeros((1, width), np.int32)
        found, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        while len(bound):
            take = max(BATCH, len(bound) // 2)
            take = max(1, min(take, POINTERS // (2 * width)))
            if len(bound) > take:
                deep = len(bound) * width > POINTERS
                key = (level << 48) + (bound >> 16) if deep else bound
                chosen = np.argpartition(-key, take - 1)
                now, rest = chosen[:take], chosen[take:]
            else:
                now, rest = np.arange(len(bound)), np.zeros(0, np.int64)
            half = self.height - 1 - level[now]
            bit = (path[None, :] >> half[:, None] & 1) << 1
            parts = []
            for side in (0, 1):
                c = self.child(cells[now], bit | side)
                b = (self.top[c] * weights).sum(axis=1)
                keep = b >= least
                parts.append((b[keep], level[now][keep] + 1, (low[now] | side << half)[keep], c[keep].astype(np.int32)))
            bound, level, low, cells = (np.concatenate([x[rest], parts[0][i], parts[1][i]])
                                        for i, x in enumerate((bound, level, low, cells)))
            last = level == self.height
            if last.any():
                found = np.concatenate([found, low[last] >> self.column_shift])
                scores = np.concatenate([scores, bound[last]])
                if len(found) > k:
                    order = np.lexsort((tie[found], -scores))[:k]
                    found, scores = found[order], scores[order]
                    least = max(least, int(scores[-1]))
                on = ~last & (bound >= least)
                bound, level, low, cells = bound[on], level[on], low[on], cells[on]
        order = np.lexsort((tie[found], -scores))
        return found[order], scores[order]


def _spread(x: np.ndarray) -> np.ndarray:
    """The bits of 31-bit numbers at the even places."""
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
        x = (x | x << shift) & mask
    return x


def _postings(docs: DataFrame, vocabulary: dict[bytes, int], id_column: str) -> DataFrame:
    """Per document: id, number of terms, the asked terms' numbers and counts."""
    def run(batches):
        for b in batches:
            number, count, length = [], [], []
            for t in b.column(1):
                all_terms = Counter(terms(t.as_py()))
                asked = [(vocabulary[w], n) for w, n in all_terms.items() if w in vocabulary]
                number.append(np.array([a for a, _ in asked], np.int32))
                count.append(np.array([n for _, n in asked], np.int32))
                length.append(all_terms.total())
            yield pa.RecordBatch.from_arrays([b.column(0).cast(pa.int64()), pa.array(length, pa.int64()), pa.array(number, pa.list_(pa.int32())),
                                              pa.array(count, pa.list_(pa.int32()))], ["doc_id", "length", "term", "tf"])

    return docs.select(id_column, "text").mapInArrow(run, "doc_id long, length long, term array<int>, tf array<int>")


def _flat(column) -> tuple[np.ndarray, np.ndarray]:
    c = column.combine_chunks()
    c = c.chunk(0) if isinstance(c, pa.ChunkedArray) else c
    return np.diff(c.offsets.to_numpy()), c.flatten().to_numpy(zero_copy_only=False)


def _search_block(items: list[tuple[int, list[bytes]]], docs: DataFrame, id_column: str, k: int) -> DataFrame:
    """(item number, terms) of one block against all documents: item, doc_id, score."""
    vocabulary = {w: i for i, w in enumerate(sorted({w for _, ws in items for w in ws}))}
    rows = written(_postings(docs, vocabulary, id_column).withColumn("deal", F.xxhash64(F.monotonically_increasing_id())), "op12-postings")
    n_docs, n_terms, n_postings = rows.agg(F.coalesce(F.sum((F.col("length") > 0).cast("long")), F.lit(0)),
                                           F.coalesce(F.sum("length"), F.lit(0)), F.coalesce(F.sum(F.size("term")), F.lit(0))).first()
    # one number a term of the block: bounded by BLOCK_TERMS
    df = np.zeros(len(vocabulary), np.int64)
    for t, n in rows.select(F.explode("term").alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("n")).collect():
        df[t] = n
    weight = np.array([math.floor(WEIGHT_SCALE * math.log((2 * n_docs + 2) / (2 * int(d) + 1))) for d in df], np.int64)
    rank = np.empty(len(df), np.int64)
    rank[np.argsort(df, kind="stable")] = np.arange(len(df))
    asked = [(i, np.array(sorted({vocabulary[w] for w in ws}), np.int64)) for i, ws in items]
    asked = [(i, t[(df[t] > 0) & (weight[t] > 0)]) for i, t in asked]
    shards = max(1, -(-n_postings // POSTINGS))
    dealt = rows.where(F.size("term") > 0).withColumn("shard", F.pmod("deal", F.lit(shards)))
    schema = pa.schema([("item", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])

    def search(least: dict[int, int]):
        def run(table: pa.Table) -> pa.Table:
            many, term = _flat(table.column("term"))
            tf = _flat(table.column("tf"))[1].astype(np.int64)
            length = table.column("length").to_numpy()
            ids = table.column("doc_id").cast(pa.int64())
            tie = ids.fill_null(np.iinfo(np.int64).max).to_numpy()
            by = np.lexsort((tie, length))
            place = np.empty(len(by), np.int64)
            place[by] = np.arange(len(by))
            m = (100 - BASE) + SHARE * length * n_docs // n_terms
            impact = TF_SCALE * tf // (TF_GAIN * tf + LENGTH_GAIN * np.repeat(m, many))
            present = np.unique(term)
            grid = Treap(np.searchsorted(np.sort(rank[present]), rank[term]), np.repeat(place, many), impact, len(present), len(by))
            row_of = np.full(len(df), -1, np.int64)
            row_of[present] = np.searchsorted(np.sort(rank[present]), rank[present])
            out = []
            for item, t in asked:
                t = t[row_of[t] >= 0]
                if len(t):
                    column, score = grid.best(row_of[t], weight[t], tie[by], k, max(1, least.get(item, 1)))
                    out.append(pa.table([pa.array(np.full(len(column), item)), ids.take(pa.array(by[column])), pa.array(score)], schema=schema))
            return pa.concat_tables(out) if out else schema.empty_table()

        return run

    kind = "item long, doc_id long, score long"
    if shards == 1:
        return dealt.groupBy("shard").applyInArrow(search({}), kind)
    first = written(dealt.where("shard = 0").groupBy("shard").applyInArrow(search({}), kind), "op12-first")
    # one number an item of the block
    least = {r[0]: r[1] for r in first.groupBy("item").agg(F.min("score"), F.count(F.lit(1)).alias("n")).where(F.col("n") >= k).collect()}
    return first.unionByName(dealt.where("shard > 0").groupBy("shard").applyInArrow(search(least), kind))


def search(items: DataFrame, docs: DataFrame, k: int = K, item_id: str = "item_id", doc_id: str = "doc_id") -> DataFrame:
    """The ``k`` best documents of each item: ``item_id``, ``rank`` (from 1), ``doc_id``, ``score``."""
    spark = docs.sparkSession
    ship_package(spark)
    asked = written(items.groupBy(F.col(item_id).alias("item_id"), F.coalesce("text", F.lit("")).alias("text")).agg(F.count(F.lit(1)).alias("times"))
                    .withColumn("item", F.monotonically_increasing_id()), "op12-items")
    parts: list[DataFrame] = []
    block: list[tuple[int, list[bytes]]] = []
    held = 0
    for r in asked.select("item", "text").orderBy("item").toLocalIterator():
        own = list(set(terms(r["text"])))
        if block and held + len(own) > BLOCK_TERMS:
            parts.append(written(_search_block(block, docs, doc_id, k), "op12-block"))
            block, held = [], 0
        if own:
            block.append((r["item"], own))
            held += len(own)
    if block:
        parts.append(_search_block(block, docs, doc_id, k))
    if not parts:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    best = every.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    out = best.join(asked.select("item", "item_id", "times"), "item")
    return out.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("times").cast("int")))).select(
        F.col("item_id").cast("long").alias("item_id"), F.col("rank").cast("int").alias("rank"), "doc_id", "score")
