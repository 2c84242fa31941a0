"""Sinks: partitioned feature tables, plain tables, alert history."""

from __future__ import annotations

import json
import os
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def write_partitioned(df: DataFrame, path: str, key: str = "symbol", fmt: str = "parquet", order: str = "ts") -> None:
    """Overwrite ``path`` partitioned by ``key`` (only the partitions
    present in ``df`` are replaced). The rows are rebalanced by key: adaptive
    execution splits a hot key by its measured size and merges small ones
    (``spark.sql.adaptive.advisoryPartitionSizeInBytes`` a writer)."""
    w = df.hint("rebalance", F.col(key)).sortWithinPartitions(key, order).write.mode("overwrite").partitionBy(key)
    w = w.option("partitionOverwriteMode", "dynamic")
    if fmt == "csv":
        w = w.option("header", True)
    w.format(fmt).save(path)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    w = df.write.mode(mode)
    if fmt == "csv":
        w = w.option("header", True)
    w.format(fmt).save(path)


def finished_versions(spark: SparkSession, root: str, prefix: str = "") -> list[str]:
    """Names of the completely written folders in ``root``, in order: a
    listing, so there is no pointer file that a crash could lose."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    found = [(st.getPath().getName(), st.getPath()) for st in fs.listStatus(path) if st.isDirectory()]
    return sorted(n for n, p in found if n.startswith(prefix)
                  and fs.exists(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS")))


def remove_versions(spark: SparkSession, root: str, names: list[str]) -> None:
    for n in names:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{root}/{n}")
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


# ------------------------------------------------------------ alert history
# A log of small markers in ``<path>/_log`` over folders of rows in ``<path>/data``. An append writes its rows to a
# folder of its own and then commits a marker under the next free number, created exclusively: of two writers that
# take the same number one fails and goes on to the next, so no append is lost and a broken one leaves no marker.
COMPACT_AFTER = 8  # appended folders that are merged into one
KEPT_LABELS = 1000  # names of merged appends that are still recognised


def _fs(spark: SparkSession, path: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def _create_exclusive(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file unless it exists: the store's exclusive create, on a
    mounted folder a hard link (which appears with its content or not at all)."""
    fs, p = _fs(spark, path)
    fs.mkdirs(p.getParent())
    if fs.getScheme() == "file":
        target = p.toUri().getPath()
        draft = f"{target}.{uuid.uuid4().hex}"
        with open(draft, "w") as f:
            f.write(text)
        try:
            os.link(draft, target)
            return True
        except FileExistsError:
            return False
        finally:
            os.unlink(draft)
    try:
        out = fs.create(p, False)
    except Exception as e:  # py4j wraps FileAlreadyExistsException
        if fs.exists(p):
            return False
        raise e
    out.write(bytearray(text.encode()))
    out.close()
    return True


def _read_text(spark: SparkSession, path: str) -> str:
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


@dataclass
class History:
    """What the markers say: the newest number, the folders that hold the rows
    (merged one first), names of appends, rows kept and their schema."""

    newest: int = 0
    upto: int = 0
    folders: list[str] = field(default_factory=list)
    labels: list[str] = field(default_factory=list)
    keep: int = 0
    schema: str | None = None
    behind: list[str] = field(default_factory=list)  # markers and folders that an earlier merge has replaced


def read_log(spark: SparkSession, path: str) -> History:
    fs, log = _fs(spark, f"{path}/_log")
    if not fs.exists(log):
        return History()
    for attempt in range(5):
        names = sorted(n for n in (st.getPath().getName() for st in fs.listStatus(log)) if n.isdigit())
        try:
            texts = [(int(n), _read_text(spark, f"{path}/_log/{n}")) for n in names]
            break
        except Exception as e:  # a merge of another writer removed an old marker after the listing
            if attempt == 4 or "FileNotFoundException" not in str(e):
                raise
    entries = [(n, json.loads(t)) for n, t in texts if t]  # an empty marker is a commit that broke off
    h = History(newest=int(names[-1]) if names else 0)
    merges = sorted((e["upto"], n) for n, e in entries if e["op"] == "merge")
    base = dict(entries)[merges[-1][1]] if merges else None
    if base:
        h.upto, h.labels, h.keep, h.schema = base["upto"], list(base["labels"]), base["keep"], base["schema"]
        h.folders = [base["data"]]
    if len(merges) > 1:  # readers of the state before the last merge may still be at work; those before it are not
        old, last = merges[-2]
        h.behind = [f"_log/{n:012d}" for n, e in entries if n <= old and n != last] + [
            f"data/{e['data']}" for n, e in entries if n <= old and "data" in e]
    for n, e in entries:
        if n <= h.upto or e["op"] == "merge":
            continue
        if e["op"] == "clear":
            h.folders = []
        else:
            h.folders.append(e["data"])
            h.labels.append(e["label"])
            h.keep, h.schema = e["keep"], e["schema"]
    return h


def _commit(spark: SparkSession, path: str, entry: dict) -> int:
    """Give ``entry`` the next free number."""
    n = read_log(spark, path).newest + 1
    while True:
        made = _create_exclusive(spark, f"{path}/_log/{n:012d}", json.dumps(entry))
        now = read_log(spark, path)
        if made and n > now.upto:
            return n
        n = max(n, now.newest) + 1  # taken, or so old a number that a merge has passed it


def _rows(spark: SparkSession, path: str, h: History) -> DataFrame:
    """The newest ``keep`` rows of the history."""
    if h.schema is None:
        raise ValueError(f"no alert history in {path}")
    schema = StructType.fromJson(json.loads(h.schema))
    parts = [spark.read.parquet(f"{path}/data/{f}") for f in h.folders] or [spark.createDataFrame([], schema)]
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p, allowMissingColumns=True)
    return every.orderBy(F.col("ts").desc(), "symbol", "alert_type").limit(h.keep)


def append_alert_history(alerts: DataFrame, path: str, keep: int = 1000, version: str | None = None) -> str:
    """Append alerts; the history is the newest ``keep`` rows (a bounded top-k).
    Safe beside other writers. Returns the folder of the appended rows.

    ``version`` names the append (a stream passes its epoch): a retried epoch
    finds its name in the log and appends nothing."""
    spark = alerts.sparkSession
    before = read_log(spark, path)
    if version is not None and version in before.labels:
        return path
    folder = uuid.uuid4().hex
    newest = alerts.orderBy(F.col("ts").desc(), "symbol", "alert_type").limit(keep)
    newest.write.parquet(f"{path}/data/{folder}")
    _commit(spark, path, {"op": "add", "data": folder, "label": version or folder, "keep": keep, "schema": alerts.schema.json()})
    after = read_log(spark, path)
    if len(after.folders) > COMPACT_AFTER:
        compact_alert_history(spark, path)
    return f"{path}/data/{folder}"


def compact_alert_history(spark: SparkSession, path: str) -> None:
    """Merge the appended folders into one of the newest ``keep`` rows, and
    remove what the merge before this one has replaced. Appends that commit
    meanwhile have higher numbers than the merge covers and stay."""
    h = read_log(spark, path)
    if not h.newest or h.schema is None:
        return
    folder = uuid.uuid4().hex
    _rows(spark, path, h).write.parquet(f"{path}/data/{folder}")
    _commit(spark, path, {"op": "merge", "data": folder, "upto": h.newest, "labels": h.labels[-KEPT_LABELS:], "keep": h.keep, "schema": h.schema})
    remove_versions(spark, path, h.behind)


def read_alert_history(spark: SparkSession, path: str, n: int = 50) -> DataFrame:
    """The newest ``n`` alerts."""
    return _rows(spark, path, read_log(spark, path)).orderBy(F.col("ts").desc(), "symbol", "alert_type").limit(n)


def clear_alert_history(spark: SparkSession, path: str) -> None:
    """Forget all alerts appended so far."""
    _commit(spark, path, {"op": "clear"})
