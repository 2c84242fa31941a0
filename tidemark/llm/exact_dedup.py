"""Exact dedup: counting quotient filters per partition, merged losslessly.

A 64-bit fingerprint of the normalised text splits into a quotient and a
remainder. Every partition builds counting quotient filters over its
fingerprints, one per block (block = leading fingerprint bits, so that a block
holds a bounded share of all rows); filters of a block merge by their sorted
remainders, adding counts. A group of copies of any size is one filter entry a
partition, so hot groups never meet in one task. Fingerprints with a count
above one only *route* rows: the routed rows are grouped by their whole
normalised bytes, which decides equality.

Defined cases: null text counts as empty; null ``doc_id`` never is the row that
stays unless all copies lack one (``keep_id`` is then null); rows that share a
``doc_id`` and a text are one document, reported as often as they occur; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import body, written

WHITE = r"[\x20\x09-\x0D]+"
BLOCK_FINGERPRINTS = 200_000  # rows a block holds on average
FILTER_FINGERPRINTS = 1_000_000  # rows one partition filter takes before the next begins


class CountingQuotientFilter:
    """Fingerprints as quotient (implicit, by bit maps) and remainder, with counts.

    ``occupied`` has a bit per quotient that has a run; ``run_end`` a bit per
    slot that ends a run; slots hold ascending remainders and their counts.
    Quotient bits follow the number of entries, so the maps take about two
    bits an entry and nothing is lost: ``items`` gives every fingerprint back.
    """

    def __init__(self, bits: int, occupied: np.ndarray, run_end: np.ndarray, remainder: np.ndarray, count: np.ndarray):
        self.bits, self.occupied, self.run_end, self.remainder, self.count = bits, occupied, run_end, remainder, count

    @classmethod
    def of(cls, fingerprints: np.ndarray, counts: np.ndarray | None = None) -> CountingQuotientFilter:
        order = np.argsort(fingerprints, kind="stable")
        f = fingerprints[order]
        c = np.ones(len(f), np.int64) if counts is None else counts[order]
        first = np.flatnonzero(np.r_[True, f[1:] != f[:-1]]) if len(f) else np.zeros(0, np.int64)
        f, c = f[first], np.add.reduceat(c, first) if len(first) else c
        bits = max(1, int(len(f) - 1).bit_length()) if len(f) else 1
        quotient = (f >> np.uint64(64 - bits)).astype(np.int64)
        occupied = np.zeros(1 << bits, bool)
        occupied[quotient] = True
        run_end = np.r_[quotient[1:] != quotient[:-1], True] if len(f) else np.zeros(0, bool)
        return cls(bits, occupied, run_end, f & np.uint64((1 << (64 - bits)) - 1), c)

    def items(self) -> tuple[np.ndarray, np.ndarray]:
        """All fingerprints, ascending, and their counts."""
        run = np.cumsum(self.run_end) - self.run_end  # which run a slot belongs to
        quotient = np.flatnonzero(self.occupied)[run].astype(np.uint64)
        return (quotient << np.uint64(64 - self.bits)) | self.remainder, self.count

    @classmethod
    def merge(cls, filters: list[CountingQuotientFilter]) -> CountingQuotientFilter:
        parts = [x.items() for x in filters]
        return cls.of(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]))

    def to_bytes(self) -> bytes:
        head = np.array([self.bits, len(self.remainder)], np.int64)
        return b"".join((head.tobytes(), np.packbits(self.occupied).tobytes(), np.packbits(self.run_end).tobytes(),
                         self.remainder.tobytes(), self.count.tobytes()))

    @classmethod
    def from_bytes(cls, raw: bytes) -> CountingQuotientFilter:
        bits, n = (int(x) for x in np.frombuffer(raw, np.int64, 2))
        at = 16
        size = (1 << bits) + 7 >> 3
        occupied = np.unpackbits(np.frombuffer(raw, np.uint8, size, at), count=1 << bits).astype(bool)
        at += size
        run_end = np.unpackbits(np.frombuffer(raw, np.uint8, n + 7 >> 3, at), count=n).astype(bool)
        at += n + 7 >> 3
        return cls(bits, occupied, run_end, np.frombuffer(raw, np.uint64, n, at), np.frombuffer(raw, np.int64, n, at + 8 * n))


def repeated_fingerprints(rows: DataFrame, column: str, block_bits: int) -> DataFrame:
    """Fingerprints (long ``column``) that occur more than once: ``f``, ``n``."""
    def per_partition(batches):
        def filters(parts):
            f = np.concatenate(parts)
            block = (f >> np.uint64(64 - block_bits)).astype(np.int64) if block_bits else np.zeros(len(f), np.int64)
            order = np.argsort(block, kind="stable")
            f, block = f[order], block[order]
            cut = np.flatnonzero(np.r_[True, block[1:] != block[:-1]])
            raw = [CountingQuotientFilter.of(x).to_bytes() for x in np.split(f, cut[1:])]
            return pa.RecordBatch.from_arrays([pa.array(block[cut], pa.int64()), pa.array(raw, pa.binary())], ["block", "filter"])

        held, size = [], 0
        for b in batches:
            if b.num_rows:
                held.append(b.column(0).to_numpy(zero_copy_only=False).view(np.uint64))
                size += b.num_rows
            if size >= FILTER_FINGERPRINTS:
                yield filters(held)
                held, size = [], 0
        if size:
            yield filters(held)

    def merged(table: pa.Table) -> pa.Table:
        f, n = CountingQuotientFilter.merge([CountingQuotientFilter.from_bytes(x) for x in table.column("filter").to_pylist()]).items()
        more = n > 1
        return pa.table({"f": pa.array(f[more].view(np.int64)), "n": pa.array(n[more])})

    parts = rows.select(column).mapInArrow(per_partition, "block long, filter binary")
    return parts.groupBy("block").applyInArrow(merged, "f long, n long")


def exact_dedup(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id``, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``."""
    norm = docs.select("doc_id", F.regexp_replace(body(), WHITE, " ").alias("norm"))
    marks = written(norm.select("doc_id", F.xxhash64("norm").alias("f"), F.sha2("norm", 256).alias("sha")), "op2-marks")
    rows = marks.count()
    block_bits = max(0, (rows // BLOCK_FINGERPRINTS).bit_length())
    repeated = written(repeated_fingerprints(marks, "f", block_bits), "op2-repeated")
    # byte verification of the routed rows: whole normalised texts are the keys, with map-side combine
    routed = written(norm.withColumn("f", F.xxhash64("norm")).join(repeated.select("f"), "f", "left_semi"), "op2-routed")
    groups = (routed.groupBy("norm").agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
              .select(F.xxhash64("norm").alias("f"), F.sha2("norm", 256).alias("sha"), "keep_id", "group_size"))
    groups = written(groups, "op2-groups")
    out = marks.join(groups, ["f", "sha"], "left")
    alone = F.col("group_size").isNull()
    keep = F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id"))
    return out.select("doc_id", keep.alias("keep_id"), F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
                      F.col("doc_id").eqNullSafe(keep).alias("kept"), F.col("sha").alias("text_sha256"))
