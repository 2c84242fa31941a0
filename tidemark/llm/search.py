"""Exact BM25 top-k: inverted index per shard with block-max pruning.

Statistics are global: document count, mean length, and the document frequency
of every query term over all documents. Queries are answered in rounds of a
block each, of about ``QUERIES`` queries or ``ASKED`` of their terms. A round
deals the documents, once, into cells, each of which is one task and gets the
block's queries (one dealing by key, no cross join). The queries come first in
it, with the weight of each of their terms once, then the cell's documents
stream past: they are searched shard by shard of about ``SHARD`` postings, so
memory does not grow with the cell. As queries are copied for every cell, there
are few cells: one for ``CELL`` postings, but ``CELLS`` if there are shards for
them, and ``MOST`` at most. What a round has dealt is removed when its results
are written, so at any time the disk holds the index and one dealing, of which
only the documents grow with the table.

A shard is an inverted index over the block's vocabulary, numbered from frequent
to rare, with the highest impact of each term in the shard. Documents come in by
groups with the same frequent words, which makes shards alike inside (languages
fall apart, for one); groups are fitted on a few queries and decide an order,
not a result. The lists of the ``HEAD`` most frequent terms of a shard are rows
over all documents too: for the queries with many postings in them, their share
of the scores is one product. All other postings are added up. The k-th score in
the cell's earlier shards is a query's threshold. A query whose terms' highest
impacts do not reach it skips the shard. Of the others' postings, the most
frequent terms whose highest impacts stay in a part (``LEFT``) of the threshold
are left out and only raise the bound. Documents whose sum and bound reach the
threshold are scored exactly from their own postings, in double precision; the
bound allows for the sums' single precision (``ROUNDING``). It never
undershoots, so the top k of a cell, and of their merge, are exact.

Scores are rounded to six places; ties go to the smaller doc_id.

Defined cases: null text and text without words match nothing and, as a query,
return nothing; rows with a null id are counted but neither searched for nor
returned; repeated rows are returned as often as they occur, and a repeated
query row is answered as often; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import settings, written

K1, B = 1.2, 0.75
SHARD = 800_000  # postings
QUERIES = 64_000  # of a block, about
ASKED = 20_000_000  # terms of a block's queries, about
CELL = 10_000_000  # postings of a cell, up to MOST cells
CELLS = 6  # cells at least, if there are as many shards
MOST = 12  # cells at most
DOCUMENTS = 8_000  # documents of a shard, about
TABLE = 1_000_000  # scores of a table of queries and documents, about
ROWS = 1_000  # queries of a table
PAIRS = 40_000  # postings added to a table at once, about
HEAD = 512  # terms of a shard whose lists are rows over all documents, at most
FREQUENT = 0.03  # of a shard's documents, that have such a term at least
PRODUCT = 300  # items of a product take as long as one posting, about
LEFT = 0.01  # of the threshold, for terms left out
GROUPS = 16  # of documents, by their frequent words
GROUP_WORDS, GROUP_DOCUMENTS = 1024, 3000  # that groups are fitted on
WORDS = 50_000  # words of a row of weights, about
SLACK = 1e-6  # bounds and scores this far below a threshold may still reach it when rounded
ROUNDING = 1e-4  # more than the share that single-precision sums of HEAD terms and a few blocks of postings lose
LEAST = 4e-7  # smaller scores are rounded to zero
WORD, QUERY, DOCUMENT = 0, 1, 2  # rows of a cell, in this order
# what an action has dealt goes when it ends, not when the driver happens to collect its garbage; rows of texts are long, so a task holds few
SETTINGS = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.execution.arrow.maxRecordsPerBatch": "2000"}
_WORD = re.compile(r"[^\W_]+")


def index(docs: DataFrame, id_column: str = "doc_id", groups: Groups | None = None) -> DataFrame:
    """``id``, ``length`` in words, distinct ``terms`` (64-bit hashes), their counts ``tf``, and the ``label`` of the document's group."""
    def run(batches):
        digest = xxhash.xxh64_intdigest
        for b in batches:
            terms, counts, length = [], [], []
            for t in b.column(1):
                words = Counter(_WORD.findall((t.as_py() or "").lower()))
                terms.append(np.fromiter((digest(w) for w in words), np.uint64, len(words)).view(np.int64))
                counts.append(np.fromiter(words.values(), np.int32, len(words)))
                length.append(sum(words.values()))
            label = groups.label(terms) if groups and terms else [0] * len(terms)
            yield pa.RecordBatch.from_arrays(
                [b.column(0).cast(pa.int64()), pa.array(length, pa.int32()), pa.array(terms, pa.list_(pa.int64())),
                 pa.array(counts, pa.list_(pa.int32())), pa.array(label, pa.int32())], ["id", "length", "terms", "tf", "label"])

    return docs.select(id_column, "text").mapInArrow(run, "id long, length int, terms array<long>, tf array<int>, label int")


class Groups:
    """Groups of documents with the same frequent words (k-means on their cosines), fitted on some documents.

    They only decide which documents come together in a shard."""

    def __init__(self, terms: list[np.ndarray], seed: int = 7):
        self.words, df = np.unique(np.concatenate(terms), return_counts=True) if terms else (np.zeros(0, np.int64), np.zeros(0, np.int64))
        top = np.sort(np.argsort(-df, kind="stable")[:GROUP_WORDS])
        self.words, df = self.words[top], df[top]
        self.weight = np.log((len(terms) + 1) / (df + 0.5)).astype(np.float32)[:, None]
        if not len(top):
            return
        x = self.has(terms) * self.weight.T
        x = x[x.any(axis=1)]
        x /= np.maximum(np.sqrt((x * x).sum(axis=1, keepdims=True)), 1e-9)
        r = np.random.default_rng(seed)
        centre = x[r.integers(len(x), size=1)]
        while len(centre) < min(GROUPS, len(x)):
            far = np.maximum(1 - (x @ centre.T).max(axis=1), 0).astype(np.float64)
            if far.sum() < 1e-3:
                break
            centre = np.concatenate((centre, x[r.choice(len(x), size=1, p=far / far.sum())]))
        for _ in range(12):
            label = (x @ centre.T).argmax(axis=1)
            centre = np.stack([x[label == i].sum(axis=0) if (label == i).any() else c for i, c in enumerate(centre)])
            centre /= np.maximum(np.sqrt((centre * centre).sum(axis=1, keepdims=True)), 1e-9)
        self.weight = self.weight * centre.T

    def has(self, terms: list[np.ndarray]) -> np.ndarray:
        """A row a document: 1 for the words that it has."""
        many, term = np.array([len(t) for t in terms]), np.concatenate(terms)
        at = np.minimum(np.searchsorted(self.words, term), len(self.words) - 1)
        hit = self.words[at] == term
        out = np.zeros((len(many), len(self.words)), np.float32)
        out[np.repeat(np.arange(len(many)), many)[hit], at[hit]] = 1
        return out

    def label(self, terms: list[np.ndarray]) -> np.ndarray:
        if not len(self.words):
            return np.zeros(len(terms), np.int32)
        return (self.has(terms) @ self.weight).argmax(axis=1).astype(np.int32)


def _groups(asked: DataFrame) -> Groups:
    """Fitted on about ``GROUP_DOCUMENTS`` of the queries: they decide an order, not a result."""
    part = asked.select("terms").sample(min(1.0, GROUP_DOCUMENTS / max(1, asked.count())), 7)
    return Groups([t.values.to_numpy() for t in part.toArrow().column(0)])


def _labelled(asked: DataFrame, groups: Groups) -> DataFrame:
    """``asked`` with the ``label`` of each row's group."""
    def run(batches):
        for b in batches:
            terms = [t.values.to_numpy() for t in b.column("terms")]
            yield b.append_column("label", pa.array(groups.label(terms) if terms else [], pa.int32()))

    return asked.select("q", "terms").mapInArrow(run, "q long, terms array<long>, label int")


def _spread(start: np.ndarray, many: np.ndarray) -> np.ndarray:
    """start[i], start[i] + 1, ... for ``many[i]`` places each."""
    at = np.repeat(start - (np.cumsum(many) - many), many)
    at += np.arange(len(at))
    return at


class Shard:
    """Inverted index of some documents over a vocabulary numbered from frequent to rare.

    Each term has the highest impact it reaches in the shard. The lists of the
    terms most frequent in the shard, at most ``HEAD``, are kept as rows over
    all documents too; each document's own postings are kept for exact scores."""

    def __init__(self, ids, length, many, term, tf, idf, mean):
        self.ids, self.term = ids, term
        self.offset = np.concatenate(([0], np.cumsum(many)))
        doc = np.repeat(np.arange(len(ids), dtype=np.int32), many)
        self.impact = idf[term] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * length[doc] / mean))
        order = np.argsort(term, kind="stable")
        self.doc, weight = doc[order], self.impact[order]
        self.size = np.bincount(term, minlength=len(idf))
        self.first = np.concatenate(([0], np.cumsum(self.size)))  # postings of a term
        self.most = np.zeros(len(idf))
        held = np.flatnonzero(self.size)
        if len(held):
            self.most[held] = np.maximum.reduceat(weight, self.first[held])
        self.weight = weight.astype(np.float32)
        heads = held[np.argsort(-self.size[held], kind="stable")[:HEAD]]
        heads = heads[self.size[heads] >= FREQUENT * len(ids)]
        self.place = np.full(len(idf), -1, np.int32)
        self.place[heads] = np.arange(len(heads))
        self.head = np.zeros((len(heads), len(ids)), np.float32)
        at = self.place[term]
        on = np.flatnonzero(at >= 0)
        self.head[at[on], doc[on]] = self.impact[on]

    def near(self, row: np.ndarray, term: np.ndarray, k: int, floor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, document) pairs, by row, that hold each row's top k as far as they reach ``floor``.

        ``row`` and ``term`` list the rows' terms, by row and number, none absent."""
        n, rows = len(self.ids), len(floor)
        place = self.place[term]
        # a product for the rows with many postings in the frequent lists, which add up the other lists
        dense = np.bincount(row, (place >= 0) * self.size[term], rows) * PRODUCT > len(self.head) * n
        head = (place >= 0) & dense[row]
        asked = np.zeros((np.count_nonzero(dense), len(self.head)), np.float32)
        asked[(np.cumsum(dense) - 1)[row[head]], place[head]] = 1
        table = asked @ self.head
        if not dense.all():
            table, some = np.zeros((rows, n), np.float32), table
            table[dense] = some
        row, term = row[~head], term[~head]
        most = self.most[term]
        # the most frequent terms whose highest impacts stay in a part of the threshold are left out: they only raise the bound
        run = np.cumsum(most)
        before = np.concatenate(([0], run))[np.searchsorted(row, np.arange(rows))]
        left = run - before[row] <= LEFT * floor[row]
        rest = np.bincount(row[left], most[left], rows) * (1 + ROUNDING)
        row, term = row[~left], term[~left]
        many = self.size[term]
        cuts = np.searchsorted(np.cumsum(many), np.arange(PAIRS, many.sum() + PAIRS, PAIRS), "right")
        for lo, hi in zip([0, *cuts], [*cuts, len(row)]):
            if lo < hi:
                low, high = row[lo], row[hi - 1] + 1
                at = _spread(self.first[term[lo:hi]], many[lo:hi])
                key = np.repeat((row[lo:hi] - low) * n, many[lo:hi])
                key += self.doc.take(at)
                table[low:high] += np.bincount(key, self.weight.take(at), (high - low) * n).reshape(-1, n)

        def reach(threshold, rest):
            return np.maximum((threshold - SLACK) * (1 - ROUNDING) - rest, LEAST).astype(np.float32)[:, None]

        hit = table >= reach(floor, rest)
        many = np.count_nonzero(hit, axis=1)
        wide = np.flatnonzero(many > k)
        if len(wide):  # what has been summed is a lower bound too
            kth = np.partition(table[wide], n - k, axis=1)[:, n - k] * (1 - ROUNDING)
            hit[wide] = table[wide] >= reach(np.maximum(kth, floor[wide]), rest[wide])
        return np.nonzero(hit)

    def scores(self, wanted: np.ndarray, docs: np.ndarray) -> np.ndarray:
        """Scores of some documents, none without postings; ``wanted`` is 1 for the query's terms, else 0."""
        many = self.offset[docs + 1] - self.offset[docs]
        at = _spread(self.offset[docs], many)
        return np.add.reduceat(self.impact.take(at) * wanted.take(self.term.take(at)), np.cumsum(many) - many)


class Numbers:
    """Places of words in a sorted list of hashes, found by their first bits."""

    def __init__(self, words: np.ndarray):
        bits = max(1, len(words).bit_length())
        self.words, self.shift, self.half = np.append(words, np.iinfo(np.int64).max), 64 - bits, 1 << bits - 1
        self.start = np.searchsorted(words, np.arange(-self.half, self.half, dtype=np.int64) << self.shift).astype(np.int32)

    def find(self, terms: np.ndarray) -> np.ndarray:
        """The place of each term, or where it would be; ``words`` has one more item."""
        at = self.start[(terms >> self.shift) + self.half]
        on = np.flatnonzero(self.words[at] < terms)
        while len(on):
            at[on] += 1
            on = on[self.words[at[on]] < terms[on]]
        return at


def _lists(column) -> tuple[np.ndarray, np.ndarray]:
    """Sizes and joined items of a column of lists."""
    return column.value_lengths().to_numpy(), column.flatten().to_numpy()


class Asked:
    """Some queries by row: their ids, their terms by number (``offset`` has each row's), their best documents so far."""

    def __init__(self, ids: np.ndarray, many: np.ndarray, term: np.ndarray, terms: int, k: int):
        self.ids = ids
        key = np.repeat(np.arange(len(many)), many)
        key *= terms
        key += term
        key.sort()
        key %= terms
        self.term = key.astype(np.int32)
        self.offset = np.concatenate(([0], np.cumsum(many)))
        self.best, self.score = np.zeros((len(ids), k), np.int64), np.zeros((len(ids), k))


class Cell:
    """A block's queries with their best documents so far; documents come in by batch and are searched by shard.

    Words come first, then queries, then documents. Terms are numbered as they
    come, and those that are not in the block's vocabulary dropped."""

    def __init__(self, k: int, mean: float, size: int):
        self.k, self.mean, self.size = k, mean, size
        self.words, self.queries, self.documents = [], [], []
        self.vocabulary = None
        self.postings = self.rows = 0

    def take(self, kind: int, b: pa.RecordBatch):
        many, terms = _lists(b.column("terms"))
        if kind == WORD:
            self.words.append((terms.copy(), _lists(b.column("idf"))[1].copy()))
            return
        if not self.words:
            return
        if kind == DOCUMENT and len(many) > 1 and len(terms) > self.size:
            half = len(many) // 2
            self.take(kind, b.slice(0, half))
            self.take(kind, b.slice(half))
            return
        if self.vocabulary is None:
            words, idf = (np.concatenate(x) for x in zip(*self.words))
            self.words = [None]
            order = np.argsort(words)
            self.vocabulary = words[order]
            self.places = Numbers(self.vocabulary)
            frequent = np.argsort(idf[order], kind="stable")
            self.idf = idf[order][frequent]
            self.number = np.empty(len(order), np.int32)
            self.number[frequent] = np.arange(len(order))
            self.wanted = np.zeros(len(order), np.int8)
        at = np.minimum(self.places.find(terms), len(self.vocabulary) - 1)
        keep = self.vocabulary[at] == terms
        many = np.bincount(np.repeat(np.arange(len(many)), many)[keep], minlength=len(many))
        ids, at = b.column("id").to_numpy().copy(), self.number[at[keep]]
        if kind == QUERY:
            self.queries.append(Asked(ids, many, at, len(self.idf), self.k))
            return
        self.documents.append((ids, b.column("length").to_numpy().astype(np.float64), many, at, _lists(b.column("tf"))[1][keep]))
        self.postings += len(terms)
        self.rows += len(ids)
        if self.postings >= self.size or self.rows >= DOCUMENTS:
            self.search()

    def search(self):
        if not self.documents or not self.queries:
            return
        ids, length, many, term, tf = (np.concatenate(x) for x in zip(*self.documents))
        self.documents, self.postings, self.rows = [], 0, 0
        shard = Shard(ids, length, many, term, tf, self.idf, self.mean)
        step = min(ROWS, max(1, TABLE // len(ids)))
        for asked in self.queries:
            even = -(-len(asked.ids) // -(-len(asked.ids) // step))
            for lo in range(0, len(asked.ids), even):
                self.search_rows(shard, asked, lo, min(len(asked.ids), lo + even))

    def search_rows(self, shard: Shard, asked: Asked, lo: int, hi: int):
        term = asked.term[asked.offset[lo]:asked.offset[hi]]
        row = np.repeat(np.arange(hi - lo), np.diff(asked.offset[lo:hi + 1]))
        most = shard.most[term]
        floor = asked.score[lo:hi, -1]
        bound = np.bincount(row, most, hi - lo)
        live = (bound > 0) & (bound * (1 + ROUNDING) >= floor - SLACK)
        if not live.any():
            return
        on = live[row] & (most > 0)
        queries = lo + np.flatnonzero(live)
        row, docs = shard.near((np.cumsum(live) - 1)[row[on]], term[on], self.k, floor[live])
        if not len(row):
            return
        cuts = np.flatnonzero(np.diff(row)) + 1
        score = []
        for start, end in zip([0, *cuts], [*cuts, len(row)]):
            q = queries[row[start]]
            own = asked.term[asked.offset[q]:asked.offset[q + 1]]
            self.wanted[own] = 1
            score.append(shard.scores(self.wanted, docs[start:end]))
            self.wanted[own] = 0
        score = np.round(np.concatenate(score), 6)
        row = queries[row]
        keep = (score > 0) & (score >= asked.score[row, -1])
        row, docs, score = row[keep], shard.ids[docs[keep]], score[keep]
        new = np.unique(row)
        old = np.repeat(new, self.k)
        row, docs, score = (np.concatenate((old, row)), np.concatenate((asked.best[new].ravel(), docs)),
                            np.concatenate((asked.score[new].ravel(), score)))
        order = np.lexsort((docs, -score, row))  # free places have score 0 and come last
        row = row[order]
        first = np.searchsorted(row, new)
        at = order[(first[:, None] + np.arange(self.k)).ravel()]
        asked.best[new], asked.score[new] = docs[at].reshape(-1, self.k), score[at].reshape(-1, self.k)

    def result(self) -> pa.RecordBatch:
        self.search()
        columns = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
        for asked in self.queries:
            q, at = np.nonzero(asked.score)
            columns.append((asked.ids[q], asked.best[q, at], asked.score[q, at]))
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*columns)], ["q", "doc_id", "score"])


def search(queries: DataFrame, docs: DataFrame, k: int = 10, query_id: str = "doc_id", doc_id: str = "doc_id") -> DataFrame:
    """The ``k`` best documents a query: ``query_id``, ``rank`` (from 1), ``doc_id``, ``score``."""
    with settings(docs.sparkSession, SETTINGS):
        return _answered(queries, docs, k, query_id, doc_id)


def _answered(queries: DataFrame, docs: DataFrame, k: int, query_id: str, doc_id: str) -> DataFrame:
    """All rounds' results, written."""
    # a repeated query row is searched for once and answered as often; rows that share an id are queries of their own
    asked = written(index(queries, query_id).where("id is not null").groupBy("id", "terms").agg(F.count(F.lit(1)).cast("int").alias("times"))
                    .withColumn("q", F.monotonically_increasing_id()), "op7-queries")
    groups = _groups(asked)
    rows = written(index(docs, doc_id, groups), "op7-index")
    n, mean = rows.agg(F.count(F.lit(1)), F.avg("length")).first()
    mean = mean or 1.0
    n_postings = rows.agg(F.coalesce(F.sum(F.size("terms")), F.lit(0))).first()[0]
    cells = max(1, min(MOST, -(-n_postings // CELL)), min(CELLS, -(-n_postings // SHARD)))
    n_asked, n_terms = asked.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size("terms")), F.lit(0))).first()
    blocks = max(1, -(-n_asked // QUERIES), -(-n_terms // ASKED))
    blk = F.pmod(F.xxhash64("q"), F.lit(blocks))
    words = asked.select(blk.alias("blk"), F.explode("terms").alias("term")).distinct()
    frequency = (rows.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
                 .join(words.select("term").distinct(), "term"))
    idf = F.log(1 + (F.lit(n) - F.col("df") + 0.5) / (F.col("df") + 0.5))
    weighed = words.join(frequency.select("term", idf.alias("idf")), "term")
    chunks = written(weighed.groupBy("blk", F.pmod(F.xxhash64("term"), F.lit(max(1, n_postings // (20 * WORDS)))).alias("chunk"))
                     .agg(F.collect_list("term").alias("terms"), F.collect_list("idf").alias("idf")), "op7-words")
    every = None
    for block in range(blocks):
        best = written(_round(chunks.where(F.col("blk") == block), asked.where(blk == block), rows.where("id is not null and length > 0"),
                              groups, k, cells, mean), "op7-round")
        every = best if every is None else every.unionByName(best)
    return every


def _round(chunks: DataFrame, asked: DataFrame, rows: DataFrame, groups: Groups, k: int, cells: int, mean: float) -> DataFrame:
    """The results of one block of queries."""
    def part(df, kind, cell, label, id, length, tf, idf):
        return df.withColumn("cell", cell).select(
            F.col("cell").cast("int").alias("cell"), F.lit(kind).alias("kind"), F.expr(label).alias("label"), F.expr(id).cast("long").alias("id"), F.expr(length).cast("int").alias("length"),
            F.col("terms"), F.expr(tf).cast("array<int>").alias("tf"), F.expr(idf).cast("array<double>").alias("idf"))

    each_cell = F.explode(F.sequence(F.lit(0), F.lit(cells - 1)))
    dealt = (part(chunks, WORD, each_cell, "0", "chunk", "0", "array()", "idf")
             .unionByName(part(_labelled(asked, groups), QUERY, each_cell, "label", "q", "0", "array()", "array()"))
             .unionByName(part(rows, DOCUMENT, F.pmod(F.xxhash64("id", "length"), F.lit(cells)), "label", "id", "length", "tf", "array()")))
    size = SHARD

    def run(batches):
        cell, at = None, None
        for b in batches:
            keys, kinds = b.column("cell").to_numpy(), b.column("kind").to_numpy()
            cuts = np.flatnonzero((np.diff(keys) != 0) | (np.diff(kinds) != 0)) + 1
            for lo, hi in zip([0, *cuts], [*cuts, len(keys)]):
                if lo == hi:
                    continue
                if keys[lo] != at:
                    if cell:
                        yield cell.result()
                    cell, at = Cell(k, mean, size), keys[lo]
                cell.take(kinds[lo], b.slice(lo, hi - lo))
        if cell:
            yield cell.result()

    best = (dealt.repartitionById(cells, "cell").sortWithinPartitions("cell", "kind", "label")
            .mapInArrow(run, "q long, doc_id long, score double"))
    order = Window.partitionBy("q").orderBy(F.desc("score"), "doc_id")
    found = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    again = F.explode(F.sequence(F.lit(1), F.col("times"))).alias("copy")
    return found.join(asked.select("q", F.col("id").alias("query_id"), again), "q").select("query_id", "rank", "doc_id", "score")
