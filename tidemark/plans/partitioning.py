"""Split per-symbol series into row chunks with a halo of look-back rows.

A window ``partitionBy(symbol)`` puts a whole symbol into one task; with a
handful of symbols (one of which may hold a third of all rows) that is a
handful of tasks. Every series operator here only looks a bounded number of
rows back (or forward), so a symbol's rows can be cut into chunks of
``chunk_rows`` consecutive rows. Each chunk gets a copy of the ``halo`` rows
that precede it (and ``lookahead`` rows that follow it); windows then
partition by ``(symbol, chunk)``, and the copies are dropped afterwards. The
result is exactly the unsplit result, with parallelism bounded by data size
rather than by the number of symbols.

Row positions come from a two-level count, not a global sort: rows are
numbered inside ``(symbol, time bucket)`` cells, and each cell's offset is a
prefix sum over the small cell-count table.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType, TimestampType

from tidemark.session import BUCKET_SECONDS_CONF, CHUNK_ROWS_CONF, conf_int

IDX, PART, HALO, BUCKET = "_idx", "_part", "_halo", "_bkt"

DEFAULT_CHUNK_ROWS = 1_000_000
DEFAULT_BUCKET_SECONDS = 7 * 86400


@dataclass(frozen=True)
class Series:
    """Window specification of one ordered series per key.

    ``part`` are the window partition columns, ``order`` the order columns,
    ``idx`` (optional) a column holding the 1-based row position within the
    key; without it the position is a ``row_number``.
    """

    key: str = "symbol"
    order: tuple = ("ts",)
    part: tuple | None = None
    idx: str | None = None

    @property
    def partition(self) -> tuple:
        return self.part or (self.key,)

    def w(self):
        return Window.partitionBy(*self.partition).orderBy(*self.order)

    def rows(self, lo, hi):
        return self.w().rowsBetween(lo, hi)

    def position(self) -> Column:
        return F.col(self.idx) if self.idx else F.row_number().over(self.w()).cast("long")

    def whole(self):
        """Frame from the series start to the current row (cumulative)."""
        return self.rows(Window.unboundedPreceding, Window.currentRow)


def _order_number(df: DataFrame, col: str) -> Column:
    dt = df.schema[col].dataType
    if isinstance(dt, (TimestampType, TimestampNTZType)):
        return F.unix_micros(F.col(col).cast("timestamp"))
    return F.col(col).cast("long")


def index_rows(df: DataFrame, key: str, order: Sequence[str], bucket_size: int) -> DataFrame:
    """Add ``_idx``: 1-based position of each row within its key in ``order``.

    ``bucket_size`` is in units of the first order column (seconds for a
    timestamp) and must keep a cell small: weeks for bars, seconds for ticks.
    Only the per-(key, bucket) count table is windowed by key.
    """
    scale = 1_000_000 if isinstance(df.schema[order[0]].dataType, (TimestampType, TimestampNTZType)) else 1
    b = F.floor(_order_number(df, order[0]) / F.lit(int(bucket_size) * scale))
    numbered = df.withColumn(BUCKET, b).withColumn(
        "_r", F.row_number().over(Window.partitionBy(key, BUCKET).orderBy(*order))
    )
    # cell sizes are counts: this side reads the key and order columns only and
    # aggregates before its shuffle
    cells = df.groupBy(F.col(key), b.alias(BUCKET)).agg(F.count(F.lit(1)).alias("_n"))
    offsets = prefix_offsets(cells, key, BUCKET, "_n", "_off")
    # null-safe: rows without a key or a time are a series (cell) of their own
    offsets = offsets.select(F.col(key).alias("_k"), F.col(BUCKET).alias("_b"), "_off")
    same = F.col(key).eqNullSafe(F.col("_k")) & F.col(BUCKET).eqNullSafe(F.col("_b"))
    return numbered.join(offsets, same).withColumn(IDX, F.col("_off") + F.col("_r")).drop("_off", "_r", "_k", "_b", BUCKET)


SUPER_CELLS = 4096


def prefix_offsets(cells: DataFrame, key: str, cell: str, size: str, out: str, fan: int = SUPER_CELLS) -> DataFrame:
    """Exclusive prefix sum of ``size`` over ``cell`` order within each key.

    Two levels, so no window holds more than ``fan`` cells of one key plus
    one row per group of ``fan`` cells: sums per super-cell (cell div fan)
    are prefixed per key, and cells are prefixed inside their super-cell.
    """
    sup = F.floor(F.col(cell) / F.lit(fan))
    c = cells.withColumn("_sup", sup)
    tops = c.groupBy(key, "_sup").agg(F.sum(size).alias("_s"))
    w_top = Window.partitionBy(key).orderBy("_sup").rowsBetween(Window.unboundedPreceding, -1)
    tops = tops.select(key, "_sup", F.coalesce(F.sum("_s").over(w_top), F.lit(0)).alias("_base"))
    w_in = Window.partitionBy(key, "_sup").orderBy(cell).rowsBetween(Window.unboundedPreceding, -1)
    inner = c.select(key, cell, "_sup", F.coalesce(F.sum(size).over(w_in), F.lit(0)).alias("_inner"))
    tops = tops.select(F.col(key).alias("_k"), F.col("_sup").alias("_s"), "_base")
    same = F.col(key).eqNullSafe(F.col("_k")) & F.col("_sup").eqNullSafe(F.col("_s"))
    return inner.join(tops, same).select(key, cell, (F.col("_base") + F.col("_inner")).alias(out))


def segment_totals(df: DataFrame, segment: Sequence[Column | str], order: Sequence[str], value: Column, out: str, bucket_size: int) -> DataFrame:
    """Running sum of ``value`` in ``order`` that starts anew in each segment.

    A segment (say a symbol and day) may hold most rows, so it is no window:
    rows are summed inside cells of ``bucket_size`` units of the first order
    column, and each cell gets the exclusive prefix of its segment's cell sums.
    """
    order = tuple(order)
    scale = 1_000_000 if isinstance(df.schema[order[0]].dataType, (TimestampType, TimestampNTZType)) else 1
    cell = F.floor(_order_number(df, order[0]) / F.lit(int(bucket_size) * scale))
    rows = df.withColumns({"_seg": F.struct(*[F.col(c).alias(f"s{i}") if isinstance(c, str) else c.alias(f"s{i}") for i, c in enumerate(segment)]),
                           BUCKET: cell, "_v": value})
    inside = Window.partitionBy("_seg", BUCKET).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    offsets = prefix_offsets(rows.groupBy("_seg", BUCKET).agg(F.sum("_v").alias("_n")), "_seg", BUCKET, "_n", "_off")
    offsets = offsets.select(F.col("_seg").alias("_k"), F.col(BUCKET).alias("_b"), "_off")
    same = F.col("_seg").eqNullSafe(F.col("_k")) & F.col(BUCKET).eqNullSafe(F.col("_b"))
    summed = rows.withColumn("_in", F.sum("_v").over(inside)).join(offsets, same)
    return summed.withColumn(out, F.col("_off") + F.col("_in")).drop("_seg", BUCKET, "_v", "_k", "_b", "_off", "_in")


def spread_halo(df: DataFrame, halo: int, lookahead: int, chunk_rows: int) -> DataFrame:
    """Assign rows to chunks and copy halo rows into neighbouring chunks."""
    c = F.lit(int(chunk_rows))
    pos = (F.col(IDX) - 1) % c
    chunk = F.floor((F.col(IDX) - 1) / c)
    hi = F.floor((F.lit(int(halo)) + pos) / c) if halo > 0 else F.lit(0)
    lo = (
        F.when(pos < lookahead, -(F.floor((F.lit(int(lookahead) - 1) - pos) / c) + 1)).otherwise(F.lit(0))
        if lookahead > 0
        else F.lit(0)
    )
    shift = F.explode(F.sequence(lo.cast("long"), hi.cast("long")))
    out = df.select("*", shift.alias("_shift"))
    return (
        out.withColumns({PART: chunk + F.col("_shift"), HALO: F.col("_shift") != 0})
        .filter(F.col(PART) >= 0)
        .drop("_shift")
    )


def over_series(
    df: DataFrame,
    build: Callable[[DataFrame, Series], DataFrame],
    *,
    halo: int,
    lookahead: int = 0,
    key: str = "symbol",
    order: Sequence[str] = ("ts",),
    chunk_rows: int | None = None,
    bucket_size: int | None = None,
    keep_index: str | None = None,
    index: str | None = None,
    plain: bool = False,
    checkpoint: bool = False,
    reread: bool = False,
) -> DataFrame:
    """Run ``build(df, spec)`` (window columns over ``spec``) chunk-parallel.

    ``halo`` must be >= the furthest look-back (in rows) of ``build`` and
    ``lookahead`` >= its furthest look-ahead. ``keep_index`` keeps the row
    position under that name; ``index`` names a column that holds it already
    (of an earlier pass over the same rows), so they are not numbered again.
    ``plain=True`` gives the unsplit plan.
    ``checkpoint=True`` writes the chunked input to the checkpoint dir first
    (for builds that read it more than once, e.g. prefix totals).

    The plan is lazy and the same at every size. Numbering reads the input
    twice, the second time only its key and order columns; ``reread=True``
    writes an input that is dear to compute (model scores) once instead.
    """
    order = tuple(order)
    if plain:
        spec = Series(key=key, order=order)
        out = build(df, spec)
        if keep_index:
            out = out.withColumn(keep_index, F.row_number().over(spec.w()).cast("long"))
        return out
    spark = df.sparkSession
    chunk_rows = chunk_rows or conf_int(spark, CHUNK_ROWS_CONF, DEFAULT_CHUNK_ROWS)
    bucket_size = bucket_size or conf_int(spark, BUCKET_SECONDS_CONF, DEFAULT_BUCKET_SECONDS)
    if reread:
        df = materialize(df)
    indexed = df.withColumn(IDX, F.col(index).cast("long")) if index else index_rows(df, key, order, bucket_size)
    spread = spread_halo(indexed, halo, lookahead, chunk_rows)
    if checkpoint:
        spread = materialize(spread)
    spec = Series(key=key, order=(IDX,), part=(key, PART), idx=IDX)
    out = build(spread, spec).filter(~F.col(HALO))
    if keep_index:
        out = out.withColumnRenamed(IDX, keep_index)
    return out.drop(PART, HALO, IDX)


def running_totals(df: DataFrame, spec: Series, cols: dict[str, Column], how: str = "sum") -> DataFrame:
    """Add cumulative sums from the start of the key's series (unbounded).

    Inside a chunked plan the in-chunk running sum is completed with the sum
    of all earlier chunks (a prefix sum over a chunk-total table), so no task
    ever needs the whole series.
    """
    agg = {"sum": F.sum, "max": F.max}[how]
    if spec.part is None or PART not in spec.part:
        for name, v in cols.items():
            df = df.withColumn(name, agg(v).over(spec.whole()))
        return df
    own = ~F.col(HALO)
    totals = df.filter(own).groupBy(spec.key, PART).agg(
        *[agg(v).alias(f"_t_{n}") for n, v in cols.items()]
    )
    before = Window.partitionBy(spec.key).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    prior = totals.select(spec.key, PART, *[agg(f"_t_{n}").over(before).alias(f"_p_{n}") for n in cols])
    # every chunk has a row in ``totals``; the join is on the chunk key only
    prior = prior.withColumnsRenamed({spec.key: "_k", PART: "_c"})
    df = df.join(prior, F.col(spec.key).eqNullSafe(F.col("_k")) & (F.col(PART) == F.col("_c")), "left").drop("_k", "_c")
    # halo rows in front of the chunk: the total of all earlier chunks less what follows the row there
    df = df.withColumn("_lead", F.max(own).over(spec.whole()) == F.lit(False))
    for name, v in cols.items():
        prior, inside = F.col(f"_p_{name}"), agg(F.when(own, v)).over(spec.whole())
        if how == "sum":
            after = F.sum(F.when(F.col("_lead"), v)).over(spec.rows(1, Window.unboundedFollowing))
            both = F.when(F.col("_lead"), prior - F.coalesce(after, F.lit(0.0))).when(
                prior.isNotNull() | inside.isNotNull(), F.coalesce(prior, F.lit(0.0)) + F.coalesce(inside, F.lit(0.0)))
        else:
            both = F.greatest(prior, inside)
        df = df.withColumn(name, both).drop(f"_p_{name}")
    return df.drop("_lead")


def materialize(df: DataFrame) -> DataFrame:
    """Cut lineage: reliable checkpoint into ``spark.checkpoint.dir`` (a
    shared folder on a cluster), so lost executors do not recompute the
    whole upstream and later reuse does not re-plan it."""
    from tidemark.session import ensure_checkpoint_dir

    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
