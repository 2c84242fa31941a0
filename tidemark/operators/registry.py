"""Versioned model registry: a candidate is saved, read back, checked against
what it scored before it was saved, and promoted only if it beats the current
model on the same validation rows.

``<path>/models/<id>`` holds the nodes, the score windows (each symbol's last
scores, from which the rolling risk goes on) and the metadata; the log of
``<path>/_log`` names the promoted models in order and is committed by
exclusive creation, so two trainers cannot promote over each other unseen.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import anomaly as AN
from tidemark.operators.merge import split_by_time
from tidemark.operators.stats import validation_metrics
from tidemark.plans.partitioning import materialize
from tidemark.sinks import _create_exclusive, _fs, _read_text

TOP_SHARE = 0.05  # validation rows whose mean score over all rows' mean is the margin
PLACES = 9


def score_windows(scored: DataFrame, window: int = 100) -> DataFrame:
    """Each symbol's last ``window`` scores in time order: at most that many a symbol."""
    from tidemark.operators.merge import tail_n

    tail = tail_n(scored.select("symbol", "ts", "anomaly_score"), window)
    return tail.groupBy("symbol").agg(F.transform(F.sort_array(F.collect_list(F.struct("ts", "anomaly_score"))),
                                                  lambda r: r["anomaly_score"]).alias("scores"))


def score_onward(features: DataFrame, model: dict, stats: dict, windows: DataFrame, window: int = 100) -> DataFrame:
    """``score_frame`` whose rolling risk goes on from saved score windows."""
    from tidemark.functions.scalar import band_model
    from tidemark.functions.series import minmax_pct
    from tidemark.plans.partitioning import over_series

    scored = AN.score_frame(features, model, stats, window).drop("risk_percentage", "risk_level")
    held = windows.select("symbol", F.posexplode("scores").alias("_place", "anomaly_score"))
    rows = scored.withColumn("_place", F.lit(None).cast("int")).unionByName(held, allowMissingColumns=True)
    # saved scores come before all rows; rows without a time are as new as the others
    rows = rows.withColumn("_at", F.when(F.col("_place").isNotNull(), F.col("_place") - (1 << 20)).otherwise(F.coalesce(F.unix_micros("ts"), F.lit(-1))))
    first = rows.where("_place is null").groupBy("symbol").agg(F.min("_at").alias("_first"))
    rows = rows.join(first, "symbol").withColumn("_at", F.when(F.col("_place").isNotNull(), F.col("_first") + F.col("_at")).otherwise(F.col("_at")))
    out = over_series(rows, lambda d, s: d.withColumn("risk_percentage", minmax_pct("anomaly_score", s, window)), halo=window,
                      order=("_at",), bucket_size=7 * 86400 * 1_000_000, reread=True)
    return out.where("_place is null").drop("_place", "_at", "_first").withColumn("risk_level", band_model("risk_percentage"))


def margin(scored: DataFrame) -> float:
    """Mean score of the highest ``TOP_SHARE`` of the rows less the mean of all."""
    from tidemark.operators.stats import exact_quantile

    scores = materialize(scored.select(F.lit(0).alias("_k"), "anomaly_score"))
    cut = exact_quantile(scores, 1.0 - TOP_SHARE, "_k", "anomaly_score", out="t").first()["t"]
    row = scores.agg(F.avg(F.when(F.col("anomaly_score") >= cut, F.col("anomaly_score"))).alias("top"), F.avg("anomaly_score").alias("all")).first()
    return round(float(row["top"] - row["all"]), PLACES)  # sums differ in their last digits from run to run


def save_candidate(path: str, model: dict, stats: dict, windows: DataFrame, metadata: dict) -> str:
    """Write a model under a fresh id; returns its folder. It is not promoted by this."""
    folder = f"{path}/models/{uuid.uuid4().hex}"
    AN.save({**model, "metadata": metadata}, stats, folder)
    windows.write.parquet(f"{folder}/windows")
    return folder


def load_model(spark: SparkSession, folder: str) -> tuple[dict, dict, DataFrame]:
    """Model (with ``metadata``), scaler, and score windows."""
    model, stats = AN.load(spark, folder)
    return model, stats, spark.read.parquet(f"{folder}/windows")


def promotions(spark: SparkSession, path: str) -> list[str]:
    """Folders of the promoted models, oldest first; the last is the current one."""
    fs, log = _fs(spark, f"{path}/_log")
    if not fs.exists(log):
        return []
    names = sorted(n for n in (st.getPath().getName() for st in fs.listStatus(log)) if n.isdigit())
    return [json.loads(t)["model"] for t in (_read_text(spark, f"{path}/_log/{n}") for n in names) if t]


def promote(spark: SparkSession, path: str, folder: str, over: list[str]) -> bool:
    """Make ``folder`` the current model if the promotions are still ``over``
    (those it was compared with); false if another trainer was faster."""
    return _create_exclusive(spark, f"{path}/_log/{len(over) + 1:012d}", json.dumps({"model": folder}))


def retrain(features: DataFrame, path: str, validation_split: float = 0.2, **kw) -> DataFrame:
    """Split each symbol by time, fit on the first part, validate on the rest,
    save, read back and check the saved model, promote it if it is better than
    the current one. One row: sizes, validation metrics, the greatest
    difference between scores before and after the reload, both margins,
    ``promoted``, and the saved model's folder."""
    spark = features.sparkSession
    split = materialize(split_by_time(features, validation_split))
    train_rows, check_rows = (split.where(F.col("split") == s).drop("split") for s in ("train", "validation"))
    model, stats = AN.train(train_rows, **kw)
    scored = materialize(AN.score_frame(check_rows, model, stats))
    metrics = validation_metrics(scored, "risk_percentage").first().asDict()
    sizes = {"train_rows": stats["rows"], "symbols": train_rows.select("symbol").distinct().count()}
    windows = score_windows(AN.score_frame(train_rows, model, stats))
    folder = save_candidate(path, model, stats, windows, {**sizes, **metrics, "features": stats["columns"]})

    loaded, loaded_stats, loaded_windows = load_model(spark, folder)
    again = AN.score_frame(check_rows, loaded, loaded_stats).select("symbol", "ts", F.col("anomaly_score").alias("_again"))
    pairs = scored.select("symbol", "ts", "anomaly_score").join(again, ["symbol", "ts"])
    same = pairs.agg(F.max(F.abs(F.col("anomaly_score") - F.col("_again"))).alias("d"), F.count(F.lit(1)).alias("n")).first()
    sound = same["n"] == metrics["validation_samples"] and same["d"] == 0.0

    earlier = promotions(spark, path)
    new_margin, old_margin = margin(scored), None
    if earlier:
        current, current_stats, _ = load_model(spark, earlier[-1])
        old_margin = margin(AN.score_frame(check_rows, current, current_stats))
    promoted = sound and (old_margin is None or new_margin > old_margin) and promote(spark, path, folder, earlier)
    row = {**sizes, **metrics, "n_nodes": loaded["nodes"].count(), "kept_scores": loaded_windows.agg(F.sum(F.size("scores"))).first()[0],
           "reload_difference": same["d"], "margin": new_margin, "current_margin": old_margin, "promoted": promoted, "model": folder}
    kinds = {"reload_difference": "double", "margin": "double", "current_margin": "double", "promoted": "boolean", "model": "string",
             "anomaly_rate": "double", "mean_score": "double", "std_score": "double"}
    return spark.createDataFrame([tuple(row.values())], ", ".join(f"{k} {kinds.get(k, 'long')}" for k in row))
