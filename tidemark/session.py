"""Session helpers: a local session for tests/bench and checkpoint handling."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Spark conf keys read by the library (all optional).
CHUNK_ROWS_CONF = "tidemark.series.chunkRows"
BUCKET_SECONDS_CONF = "tidemark.series.bucketSeconds"


def local_session(cpus: int | str = 8, app: str = "tidemark", extra: dict | None = None) -> SparkSession:
    """A local session configured like the tests and the bench expect."""
    b = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # no broadcast from static size estimates; AQE broadcasts a side only
        # after measuring it at runtime (below 32 MB)
        .config("spark.sql.autoBroadcastJoinThreshold", "-1")
        .config("spark.sql.adaptive.autoBroadcastJoinThreshold", "32MB")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.parquet.datetimeRebaseModeInRead", "CORRECTED")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster checkpoint dir; set a scratch one only when unset.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used
    as is, and its absence is an error. Only a local session without it gets
    a fresh temp folder.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext._jsc.sc().getCheckpointDir()
        d = d.get() if d.isDefined() else None
    if not d:
        if not spark.conf.get("spark.master", "local").split("[")[0] == "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="tidemark-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", d)
    spark.sparkContext.setCheckpointDir(d)
    return d


def conf_int(spark: SparkSession, key: str, default: int) -> int:
    v = spark.conf.get(key, None)
    return int(v) if v not in (None, "") else default


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``tidemark`` importable in Python workers (pandas functions and
    keyed state are pickled by reference): zip the package once per
    SparkContext and ``addPyFile`` it, so executors get it from the driver."""
    import shutil

    sc = spark.sparkContext
    key = sc.applicationId
    if key in _SHIPPED:
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    base = tempfile.mkdtemp(prefix="tidemark-pkg-")
    archive = shutil.make_archive(os.path.join(base, "tidemark"), "zip", root_dir=os.path.dirname(pkg_dir),
                                  base_dir="tidemark")
    sc.addPyFile(archive)
    _SHIPPED.add(key)
