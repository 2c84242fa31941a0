"""SimHash near-dedup: segment-popcount embedding and a grid join.

A 64-bit fingerprint is cut into 32 segments of two bits; the segments' bit
counts are its embedding. The Manhattan distance of two embeddings never
exceeds the bit distance of the fingerprints. Stored as thermometer code (one:
01, two: 11), that distance is the bit count of an exclusive or.

Grid: the 32 coordinates form ``max_bits + 2`` groups. Two embeddings within
Manhattan distance ``max_bits`` differ in at most ``max_bits`` groups, so they
agree on at least two; each pair of groups is one grid key, and every link
shares a cell. Only distinct fingerprints enter the grid (copies are one row).
Cells above ``CELL`` fingerprints are cut into blocks, and every pair of blocks
is its own bounded unit of work; units check the Manhattan bound, then the
exact distance, and emit a spanning forest of the links, never all pairs.
Components of the forest links equal components of all links.

Defined cases: null text counts as empty; without words the fingerprint is
zero and links like any other; null ``doc_id`` rows take part in links but are
never a component's id (null if no row of it has one); repeated rows are
reported as often as they occur; other columns are ignored.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import connected_components, free, written

SHINGLE_WORDS = 3
MAX_BITS = 2
CELL = 4096  # distinct fingerprints one block of a cell holds
UNIT_ROWS = 20_000  # rows of the units that are handled together

_BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)  # high bit first
_ODD = 0x5555555555555555


def fingerprint(text: str | None, words: int = SHINGLE_WORDS) -> int:
    """Fingerprint of a text: A-Z lower-cased, words between ASCII white space."""
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    shingles = [b" ".join(t) for t in zip(*(w[i:] for i in range(words)))] or [b" ".join(w)]
    digest = xxhash.xxh64_digest
    raw = np.frombuffer(b"".join([digest(s, 42) for s in shingles]), np.uint8).reshape(-1, 8)
    set_bits = np.concatenate([np.bincount(raw[:, j], minlength=256) @ _BYTE_BITS for j in range(8)])
    return int.from_bytes(np.packbits(2 * set_bits > len(shingles)).tobytes(), "big")


def fingerprints(docs: DataFrame, words: int = SHINGLE_WORDS) -> DataFrame:
    """``doc_id``, ``fp`` (the 64 bits as a signed long)."""
    kind = dict(docs.dtypes)["doc_id"]

    def run(batches):
        for b in batches:
            fp = np.fromiter((fingerprint(t.as_py(), words) for t in b.column(1)), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp.view(np.int64))], ["doc_id", "fp"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, fp long")


def _thermometer(x: np.ndarray) -> np.ndarray:
    odd = np.uint64(_ODD)
    half = x >> np.uint64(1)
    return ((x | half) & odd) | (((x & half) & odd) << np.uint64(1))


def forest(x: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Links of a spanning forest of the fingerprints ``x`` at ``max_bits`` or fewer."""
    t = _thermometer(x)
    left = np.arange(len(x))
    out = []
    while len(left) > 1:
        stack, left = [left[0]], left[1:]
        while stack and len(left):
            p = stack.pop()
            near = np.bitwise_count(t[left] ^ t[p]) <= max_bits  # lower bound
            if near.any():
                near[near] = np.bitwise_count(x[left[near]] ^ x[p]) <= max_bits  # exact
                new = left[near]
                out.extend((p, q) for q in new)
                stack.extend(new)
                left = left[~near]
    return [(int(x[p]), int(x[q])) for p, q in out]


def fingerprint_links(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Forest links ``a``, ``b`` between distinct fingerprints (long column ``fp``)."""
    groups = max_bits + 2
    lanes = [32 * g // groups for g in range(groups + 1)]
    mask = [sum(3 << 2 * lane for lane in range(lanes[g], lanes[g + 1])) for g in range(groups)]
    half = F.shiftrightunsigned("fp", 1)
    odd = F.lit(_ODD)
    code = (F.col("fp").bitwiseOR(half).bitwiseAND(odd)).bitwiseOR(
        F.shiftleft(F.col("fp").bitwiseAND(half).bitwiseAND(odd), 1))

    def signed(v: int) -> int:
        return v - (1 << 64) if v >= 1 << 63 else v

    keys = F.array(*[F.struct(F.lit(k).alias("k"), F.col("code").bitwiseAND(F.lit(signed(mask[i] | mask[j]))).alias("v"))
                     for k, (i, j) in enumerate(combinations(range(groups), 2))])
    cells = fps.withColumn("code", code).select("fp", F.explode(keys).alias("c")).select("fp", "c.k", "c.v")
    sizes = cells.groupBy("k", "v").agg(F.count(F.lit(1)).alias("m")).where("m > 1")
    rows = cells.join(sizes, ["k", "v"])
    blocks = F.ceil(F.col("m") / CELL).cast("int")
    own = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    # one row per pair of blocks that the fingerprint's own block is part of
    rows = (rows.withColumn("blocks", blocks).withColumn("own", own)
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .select("fp", F.xxhash64("k", "v", F.least("own", "other"), F.greatest("own", "other")).alias("unit")))
    rows = written(rows, "op9-cells")
    n = max(1, rows.count() // UNIT_ROWS)

    def run(table: pa.Table) -> pa.Table:
        unit = table.column("unit").to_numpy()
        x = table.column("fp").to_numpy().view(np.uint64)
        order = np.lexsort((x, unit))
        unit, x = unit[order], x[order]
        links = []
        for part in np.split(x, np.flatnonzero(unit[1:] != unit[:-1]) + 1):
            if len(part) > 1:
                links += forest(part, max_bits)
        ends = np.array(links, np.uint64).reshape(-1, 2).view(np.int64)
        return pa.table({"a": pa.array(ends[:, 0]), "b": pa.array(ends[:, 1])})

    return rows.groupBy(F.pmod(F.col("unit"), F.lit(n)).alias("bucket")).applyInArrow(run, "a long, b long")


def simhash_groups(docs: DataFrame, words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """One row per document: ``doc_id``, ``fp`` (long), ``component_id``."""
    marks = written(fingerprints(docs, words), "op9-marks")
    fps = written(marks.groupBy("fp").agg(F.min("doc_id").alias("least")), "op9-fps")
    nodes = connected_components(fingerprint_links(fps.select("fp"), max_bits), "op9-links")
    rooted = fps.join(nodes.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    rooted = written(rooted, "op9-rooted")
    ids = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    members = written(rooted.join(ids, "root").select("fp", "component_id"), "op9-members")
    return marks.join(members, "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` with one row of each component: the one of the smallest
    ``doc_id`` (rows without one come last), of several such rows any one.
    Rows are told apart by a number of their own, so shared and null ids and
    repeated rows cost no text its last copy."""
    no = free(docs, "_row")
    rows = written(docs.withColumn(no, F.monotonically_increasing_id()), "op9-rows")
    groups = simhash_groups(rows.select(F.col(no).alias("doc_id"), "text"), words, max_bits)
    named = written(groups.select(F.col("doc_id").alias(no), "component_id").join(rows.select(no, F.col("doc_id").alias("_id")), no), "op9-named")
    first = named.groupBy("component_id").agg(F.min(F.struct(F.col("_id").isNull(), "_id", no))[no].alias("_first"))
    drop = written(named.join(first, "component_id").where(F.col(no) != F.col("_first")).select(no), "op9-dropped")
    return rows.join(drop, no, "left_anti").select(*docs.columns)
