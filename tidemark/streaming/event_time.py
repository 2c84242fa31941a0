"""Keyed state in event time: rows wait until the watermark has passed them.

A per-key recurrence (a difference, an EMA, a trailing window) needs its rows
in time order, and a stream does not deliver them so. ``in_event_time`` holds
the rows back in a map of pending chunks (a key's rows of one micro-batch, as
Arrow, with their first and last time) and sets an event-time timer on the
earliest of them. When the watermark has passed it, all rows behind the
watermark are released: sorted by time, run through ``step`` together with the
key's carried value, and put out. So the result does not depend on how rows
are dealt to micro-batches or ordered inside them, and a key costs a fixed
number of state calls a micro-batch, whatever its rows.

- A row behind the time up to which its key was released is late; for a key
  without state, a row behind the watermark. It is put
  out at once with ``is_late`` true and no derived values, and changes nothing;
  ``run_with_late`` writes late rows to an output of their own.
- A row without a time belongs before all others: it waits for the first
  release of its key and is late afterwards.
- A key starts anew after a gap of more than ``ttl`` between its rows; its
  state goes when the watermark has passed the gap.
- Rows ahead of the last watermark stay pending when a bounded source ends.
  A row with the key ``END`` and a time after all others (``end_marker``)
  moves the watermark past them; it is not put out itself.

The watermark is taken on a copy of the time column. The operator does not
carry that copy, so Spark hands late rows over instead of dropping them.
State needs the RocksDB store, which ``transformWithState`` requires; it is
set for the query's start only.
"""

from __future__ import annotations

import io
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import BooleanType, StructField, StructType

from tidemark.session import ensure_checkpoint_dir, ship_package

UNTIMED = -(2**52)  # time of rows without one
END = "\u0000end"
END_TIME = "2262-01-01 00:00:00"  # about the last time that pandas can hold
PROVIDER_CONF = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

Step = Callable[[pd.DataFrame, tuple | None], tuple[pd.DataFrame, tuple]]


def _pack(rows: pd.DataFrame) -> bytes:
    sink = io.BytesIO()
    table = pa.Table.from_pandas(rows, preserve_index=False)
    with pa.ipc.new_stream(sink, table.schema) as w:
        w.write_table(table)
    return sink.getvalue()


def _unpack(blob: bytes) -> pd.DataFrame:
    with pa.ipc.open_stream(io.BytesIO(bytes(blob))) as r:
        return r.read_all().to_pandas()


def _ms(time: pd.Series) -> np.ndarray:
    """Milliseconds, ``UNTIMED`` where there is no time."""
    t = pd.to_datetime(time).astype("datetime64[us]")
    if getattr(t.dt, "tz", None) is not None:
        t = t.dt.tz_convert("UTC").dt.tz_localize(None)
    us = t.to_numpy().astype("datetime64[us]").astype("int64")
    return np.where(t.isna().to_numpy(), UNTIMED, us // 1000)


class InEventTime(StatefulProcessor):
    """Pending chunks, the timer on the earliest, and the value that ``step`` carries on."""

    def __init__(self, step: Step, carry: str, order: list[str], columns: list[str], ttl_ms: int):
        self.step, self.carry_schema, self.order, self.columns, self.ttl_ms = step, carry, order, columns, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.pending = handle.getMapState("pending", "chunk long", "first long, last long, rows binary")
        self.carried = handle.getValueState("carried", self.carry_schema)
        # number of chunks so far; rows before this time are released; when an idle key ends (0: never)
        self.place = handle.getValueState("place", "chunks long, released long, ends long")

    def _wait(self, ms: np.ndarray) -> None:
        self.handle.registerTimer(max(int(ms.min()) + 1, 1))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        parts = [r for r in rows if len(r)]
        if not parts or key[0] == END:
            return
        new = pd.concat(parts, ignore_index=True)
        ms = _ms(new[self.order[0]])
        # a key without state takes what is not behind the watermark (0: there is none yet)
        chunks, released, ends = self.place.get() or (0, timerValues.getCurrentWatermarkInMs() or None, 0)
        late = np.zeros(len(new), bool) if released is None else ms < released
        if not late.all():
            self.pending.updateValue((chunks,), (int(ms[~late].min()), int(ms[~late].max()), _pack(new[~late])))
            self.place.update((chunks + 1, released, ends))
            self._wait(ms[~late])
        if late.any():
            yield new[late].reset_index(drop=True).reindex(columns=self.columns).assign(is_late=True)

    def _over(self, rows: pd.DataFrame, ends: int) -> bool:
        """Whether the key's state has ended before the first of ``rows``."""
        return 0 < ends < int(_ms(rows[self.order[0]])[0])

    def _lives(self, rows: pd.DataFrame) -> list[slice]:
        """Stretches of ``rows`` without a gap of more than the time to live."""
        if not self.ttl_ms:
            return [slice(0, len(rows))]
        ms = _ms(rows[self.order[0]])
        cut = np.flatnonzero((np.diff(ms) > self.ttl_ms) & (ms[:-1] != UNTIMED)) + 1
        at = [0, *cut.tolist(), len(rows)]
        return [slice(i, j) for i, j in zip(at, at[1:])]

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        upto = timerValues.getCurrentWatermarkInMs()
        if not self.place.exists():
            return
        chunks, released, ends = self.place.get()
        due, left = [], []
        for (chunk,), (first, last, blob) in list(self.pending.iterator()):
            if first >= upto:
                left.append(first)
                continue
            rows = _unpack(blob)
            behind = _ms(rows[self.order[0]]) < upto
            due.append(rows[behind])
            if behind.all():
                self.pending.removeKey((chunk,))
            else:
                rest = rows[~behind]
                ms = _ms(rest[self.order[0]])
                self.pending.updateValue((chunk,), (int(ms.min()), last, _pack(rest)))
                left.append(int(ms.min()))
        if due:
            rows = pd.concat(due, ignore_index=True).sort_values(self.order, kind="stable", ignore_index=True, na_position="first")
            carry = None if self._over(rows, ends) else self.carried.get()
            for some in self._lives(rows):
                out, carry = self.step(rows.iloc[some].reset_index(drop=True), carry if some.start == 0 else None)
                yield out.reindex(columns=self.columns).assign(is_late=False)
            self.carried.update(carry)
            if self.ttl_ms:
                ends = int(_ms(rows[self.order[0]])[-1]) + self.ttl_ms
                self._wait(np.array([ends]))
            self.place.update((chunks, upto, ends))
            if left:
                self._wait(np.array(left))
        elif 0 < ends < upto and not left:
            self.carried.clear()
            self.place.clear()


def in_event_time(rows: DataFrame, step: Step, out: str, carry: str, order: list[str], watermark: str = "10 minutes",
                  ttl: str | None = None, key: str = "symbol") -> DataFrame:
    """Run ``step(rows in order, carried value or None) -> (out rows, carried value)``
    per ``key`` in event time. Puts out the columns of ``out`` and ``is_late``."""
    ship_package(rows.sparkSession)
    schema = StructType.fromDDL(out)
    columns = [f.name for f in schema.fields]
    ttl_ms = 0 if ttl is None else int(pd.Timedelta(ttl).total_seconds() * 1000)
    processor = InEventTime(step, carry, order, columns, ttl_ms)
    timed = rows.withColumn("_event_time", F.col(order[0])).withWatermark("_event_time", watermark).drop("_event_time")
    return timed.groupBy(key).transformWithStateInPandas(
        statefulProcessor=processor, outputStructType=StructType([*schema.fields, StructField("is_late", BooleanType())]),
        outputMode="append", timeMode="eventTime")


def end_marker(rows: DataFrame, key: str = "symbol", time: str = "ts") -> DataFrame:
    """One row with the key ``END`` and a time after all others, other columns null."""
    made = {key: F.lit(END), time: F.lit(END_TIME)}
    return rows.sparkSession.range(1).select(*[made.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in rows.schema.fields])


@contextmanager
def rocksdb(spark: SparkSession):
    """The RocksDB state store for queries started inside."""
    before = spark.conf.get(PROVIDER_CONF, None)
    spark.conf.set(PROVIDER_CONF, ROCKSDB)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(PROVIDER_CONF)
        else:
            spark.conf.set(PROVIDER_CONF, before)


def run_with_late(sdf: DataFrame, name: str, base: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Run over everything available into a Parquet sink partitioned by
    ``is_late``: the results in time, and the late rows. A run with the ``base``
    of an earlier one goes on from its checkpoint."""
    spark = sdf.sparkSession
    base = base or f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
    with rocksdb(spark):
        q = (sdf.writeStream.format("parquet").option("path", f"{base}/data").partitionBy("is_late")
             .option("checkpointLocation", f"{base}/_checkpoint").outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
    out = spark.read.schema(sdf.schema).parquet(f"{base}/data")
    return out.where("not is_late").drop("is_late"), out.where("is_late").drop("is_late")
