"""EMA-like recurrences carried exactly from chunk to chunk.

An EMA is affine in its start value: over a chunk, ``end = a * start + b``. So
each chunk is summarised once by (a, b) and by its end without a start; the
summaries of one series (rows / chunk rows entries) are composed in order,
which gives every chunk its exact start; each chunk then runs its own rows.
No look-back is cut, and no task sees more than a chunk of rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from typing import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StructField, StructType

from tidemark.plans.partitioning import PART, Series
from tidemark.session import ship_package


@dataclass(frozen=True)
class Ema:
    """``out`` = EMA of the column ``value`` (first row: the value itself).

    ``live`` names a boolean column: a row without it shows its plain value
    and unsets the state. With ``zero_unset`` a state of 0 counts as unset.
    ``before`` (optional) receives the state before the row, 0 if unset.
    """

    out: str
    value: str
    alpha: float
    live: str | None = None
    zero_unset: bool = False
    before: str | None = None


def _compose(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Prefix compositions of the maps ``v -> a * v + b``, by doubling."""
    d = 1
    while d < len(a):
        b = np.concatenate((b[:d], a[d:] * b[:-d] + b[d:]))
        a = np.concatenate((a[:d], a[d:] * a[:-d]))
        d *= 2
    return a, b


def _run(x: np.ndarray, fresh: np.ndarray, alpha: float) -> np.ndarray:
    """``held = x`` on fresh rows (the first is one), ``held`` where x is
    missing, else ``alpha * x + (1 - alpha) * held``; all rows in lockstep.

    The rows are cut into lanes. A first sweep over the places of a lane, all
    lanes at once, gives every lane's map from start to end; composing them
    gives the state before each lane up to rounding. The second sweep runs the
    definition itself, each lane together with the lane before it, which is
    long enough (12 / alpha rows) for the rounding of the start to die out.
    """
    keep, n = 1.0 - alpha, len(x)
    width = max(64, math.ceil(12.0 / alpha))
    lanes = -(-n // width)
    size = lanes * width
    gap = np.isnan(x)
    plain = ~(fresh | gap)
    # one row a place, one column a lane; places behind the end keep the state
    grid = lambda v, rest: np.concatenate((v, np.full(size - n, rest, v.dtype))).reshape(lanes, width).T.copy()
    add = grid(np.where(fresh, x, np.where(gap, 0.0, alpha * np.where(gap, 0.0, x))), 0.0)
    factor = grid(np.where(fresh, 0.0, np.where(plain, keep, 1.0)), 1.0)

    def sweep(held, out=None):
        for i in range(width):
            held = add[i] + factor[i] * held
            if out is not None:
                out[i] = held
        return held

    out = np.empty((width, lanes))
    if lanes == 1:
        sweep(np.zeros(1), out)
    else:
        ends = sweep(np.zeros(lanes))
        a, b = _compose(np.prod(factor, axis=0), ends)
        before = np.concatenate(([0.0, 0.0], b[:-2]))  # the state before the lane in front
        # through the lane in front (the first lane has none), then the lane itself
        held = before
        for i in range(width):
            held = np.concatenate((held[:1], add[i, :-1] + factor[i, :-1] * held[1:]))
        sweep(held, out)
    return out.T.reshape(-1)[:n]


def ema_path(x: np.ndarray, alpha: float, live: np.ndarray | None = None, start: float = np.nan,
             zero_unset: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Shown value and state (NaN: unset) after each row, from the state
    ``start``. A missing value leaves the state as it is."""
    x = np.concatenate(([start], x))
    on = np.ones(len(x), bool)
    if live is not None:
        on[1:] = live
    starts = on & ~np.isnan(x)
    if zero_unset:
        starts[1:] &= x[1:] != 0
    total = np.cumsum(starts)
    is_set = total > np.maximum.accumulate(np.where(on, 0, total))
    fresh = ~on
    fresh[0] = True
    fresh[1:] |= ~is_set[:-1]
    # a fresh row without a value has none to show or to hand on
    shown = _run(x, fresh & ~np.isnan(x), alpha)
    lost = fresh & np.isnan(x)
    if lost.any():
        owner = np.maximum.accumulate(np.where(fresh, np.arange(len(x)), 0))  # the fresh row that a row goes back to
        shown = np.where(lost[owner], np.nan, shown)
    return shown[1:], np.where(is_set, shown, np.nan)[1:]


def _inputs(rows: pa.Table, e: Ema) -> tuple[np.ndarray, np.ndarray | None]:
    x = rows.column(e.value).cast(pa.float64()).to_numpy()
    live = None if e.live is None else rows.column(e.live).fill_null(False).to_numpy()
    return x, live


def _summary(rows: pa.Table, emas: Sequence[Ema]) -> tuple[list, list, list]:
    """Per EMA: the end without a start, and (a, b) with one (a is NaN if the
    chunk unsets the state somewhere)."""
    end, a, b = [], [], []
    for e in emas:
        x, live = _inputs(rows, e)
        end.append(ema_path(x, e.alpha, live, zero_unset=e.zero_unset)[1][-1])
        reset = live is not None and not live.all()
        a.append(np.nan if reset else (1.0 - e.alpha) ** np.count_nonzero(~np.isnan(x)))
        b.append(0.0 if reset else ema_path(x, e.alpha, None, 0.0, e.zero_unset)[1][-1])
    return end, a, b


def with_emas(df: DataFrame, spec: Series, emas: Sequence[Ema]) -> DataFrame:
    """Add the columns of ``emas`` to a plan of ``over_series`` without halo."""
    ship_package(df.sparkSession)
    names = [c for e in emas for c in (e.out, e.before) if c]
    columns = [c for c in df.columns if c not in names]
    df = df.select(*columns)
    schema = StructType([*df.schema.fields, *[StructField(c, DoubleType()) for c in names]])
    order = [(c, "ascending") for c in spec.order]
    m = len(emas)

    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by(order)
        start = rows.column("_carry")[0].as_py() if "_carry" in rows.column_names else None
        start = [np.nan] * m if start is None else start
        out = rows.select(columns)
        for e, s in zip(emas, start):
            x, live = _inputs(rows, e)
            shown, after = ema_path(x, e.alpha, live, s, e.zero_unset)
            out = out.append_column(e.out, pa.array(shown, from_pandas=True))
            if e.before:
                out = out.append_column(e.before, pa.array(np.nan_to_num(np.concatenate(([s], after[:-1])))))
        return out

    if spec.part is None or PART not in spec.part:
        return df.groupBy(spec.key).applyInArrow(run, schema)

    doubles = ArrayType(DoubleType())
    key, part = df.schema[spec.key], StructField(PART, LongType())
    held = list(dict.fromkeys([spec.key, PART, *spec.order, *[c for e in emas for c in (e.value, e.live) if c]]))

    def summarise(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by(order)
        lists = [pa.array([v], pa.list_(pa.float64())) for v in _summary(rows, emas)]
        return pa.table([rows.column(spec.key).slice(0, 1), rows.column(PART).slice(0, 1), *lists],
                        names=[spec.key, PART, "end", "a", "b"])

    def compose(chunks: pa.Table) -> pa.Table:
        chunks = chunks.sort_by(PART)
        end, a, b = (np.array(chunks.column(c).to_pylist(), float) for c in ("end", "a", "b"))
        state, carry = np.full(m, np.nan), []
        for i in range(len(end)):
            carry.append(state.tolist())
            state = np.where(np.isnan(state) | np.isnan(a[i]), end[i], a[i] * state + b[i])
        return pa.table([chunks.column(spec.key), chunks.column(PART), pa.array(carry, pa.list_(pa.float64()))],
                        names=["_k", "_c", "_carry"])

    ends = df.select(*held).groupBy(spec.key, PART).applyInArrow(
        summarise, StructType([key, part, *[StructField(c, doubles) for c in ("end", "a", "b")]]))
    carries = ends.groupBy(spec.key).applyInArrow(
        compose, StructType([StructField("_k", key.dataType), StructField("_c", LongType()), StructField("_carry", doubles)]))
    joined = df.join(carries, F.col(spec.key).eqNullSafe(F.col("_k")) & (F.col(PART) == F.col("_c")), "left").drop("_k", "_c")
    return joined.groupBy(spec.key, PART).applyInArrow(run, schema)
