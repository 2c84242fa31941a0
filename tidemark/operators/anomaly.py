"""Distributed Isolation Forest (Liu, Ting & Zhou, 2008) on Spark.

* Sampling: a row's MD5 gives two numbers, from which its place in the sample
  of every tree follows by arithmetic; a row joins a tree's candidates when
  its place is below a threshold slightly above psi / n, and each tree keeps
  its psi smallest places. No n x trees explosion, one hash a row, and the
  sample does not depend on partitioning or arrival order.
* Growth: ``groupBy(tree_id)`` grows one tree per group of at most psi rows,
  level by level. The split feature and the threshold of a node are drawn from
  the MD5 of (seed, tree, node), so any engine can repeat a tree (the
  reference SQL does, with window aggregates).
* Model: a nodes table of at most trees x (2 psi - 1) rows (checked against
  ``MAX_NODES``), so it is shipped to every task as a broadcast variable;
  scoring is a vectorised ``mapInPandas`` traversal, one numpy pass per level.

Inputs of the forest are rounded to 9 places, so the trees do not hang on the
order in which the scaler's sums were added.
"""

from __future__ import annotations

import hashlib
import json
import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

EULER_GAMMA = 0.5772156649015329
NODE_SCHEMA = ("tree_id int, node_id int, left int, right int, feature int, threshold double, "
               "size int, depth int, is_leaf boolean")
SPACE = 1 << 52  # places are whole numbers below, 13 hex digits of an MD5
MAX_TREES = 1024  # a place times a tree number stays below 2^63
MAX_NODES = 2_000_000  # of a model that is broadcast
PLACES = 9  # decimal places of a scaled input


def c_factor(n) -> np.ndarray:
    """Average path length of an unsuccessful BST search among n points."""
    n = np.asarray(n, dtype="float64")
    out = np.zeros_like(n)
    big = n > 2
    out[big] = 2.0 * (np.log(n[big] - 1.0) + EULER_GAMMA) - 2.0 * (n[big] - 1.0) / n[big]
    out[n == 2] = 1.0
    return out


def scaler_stats(df: DataFrame, cols: list[str]) -> dict:
    """Per-feature mean and population std (0 -> 1), and the row count: one aggregate row."""
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        aggs += [F.avg(x).alias(f"m{len(aggs)}"), F.stddev_pop(x).alias(f"s{len(aggs) + 1}")]
    row = df.agg(*aggs, F.count(F.lit(1))).first()
    means = [float(row[2 * i] or 0.0) for i in range(len(cols))]
    scales = [float(row[2 * i + 1] or 0.0) or 1.0 for i in range(len(cols))]
    return {"columns": list(cols), "mean": means, "scale": scales, "rows": int(row[-1])}


def scale(df: DataFrame, stats: dict, prefix: str = "") -> DataFrame:
    """(x - mean) / scale with the fitted statistics as literals (no join)."""
    cols = stats["columns"]
    keep = [c for c in df.columns if c not in cols]
    return df.select(*keep, *[((F.col(c).cast("double") - F.lit(m)) / F.lit(s)).alias(prefix + c)
                              for c, m, s in zip(cols, stats["mean"], stats["scale"])])


def _digits(text: Column, at: int) -> Column:
    return F.conv(F.substring(F.md5(text), at, 13), 16, 10).cast("long")


def _samples(df: DataFrame, features: list[str], key_cols: list[str], n: int, n_trees: int, psi: int, seed: int) -> DataFrame:
    """``tree_id`` and the features of each tree's psi rows of smallest place."""
    frac = min(1.0, (psi + 8.0 * math.sqrt(psi) + 32.0) / max(n, 1))
    limit = math.ceil(frac * SPACE)
    name = F.concat_ws("|", *[F.col(k).cast("string") for k in key_cols], F.lit(str(seed)))
    place = lambda t: (F.col("_a") + t * F.col("_b")) % F.lit(SPACE)
    cand = df.select(*features, *key_cols, _digits(name, 1).alias("_a"), _digits(name, 14).alias("_b")).select(
        "*", F.explode(F.filter(F.sequence(F.lit(0), F.lit(n_trees - 1)), lambda t: place(t) < F.lit(limit))).alias("tree_id"))
    first = Window.partitionBy("tree_id").orderBy(place(F.col("tree_id")), *key_cols)
    return cand.withColumn("_r", F.row_number().over(first)).where(F.col("_r") <= psi).select("tree_id", *features)


def _grow(x: np.ndarray, tree: int, max_depth: int, seed: int) -> list[tuple]:
    """The nodes of one tree over the rows ``x``; node k has the children 2k+1 and 2k+2."""
    out = []
    level = [(0, np.arange(len(x)))]
    for depth in range(max_depth + 1):
        below = []
        for node, rows in level:
            own = x[rows]
            lo, hi = own.min(axis=0), own.max(axis=0)
            usable = np.flatnonzero(hi > lo)
            if depth == max_depth or not len(usable):
                out.append((node, -1, -1, -1, 0.0, len(rows), depth, True))
                continue
            drawn = hashlib.md5(f"{seed}:{tree}:{node}".encode()).hexdigest()
            f = int(usable[int(int(drawn[:13], 16) / SPACE * len(usable))])
            t = float(lo[f] + int(drawn[13:26], 16) / SPACE * (hi[f] - lo[f]))
            out.append((node, 2 * node + 1, 2 * node + 2, f, t, len(rows), depth, False))
            left = own[:, f] < t
            below += [(2 * node + 1, rows[left]), (2 * node + 2, rows[~left])]
        # a threshold that rounds onto the least value leaves nothing to its left
        level = [(node, rows) for node, rows in below if len(rows)]
    return out


def fit(df: DataFrame, features: list[str], key_cols: list[str], n_trees: int = 100, psi: int = 256,
        seed: int = 42, n: int | None = None) -> dict:
    """Fit the forest on (already scaled) ``features``; returns the model:
    a nodes DataFrame plus metadata (psi, depth limit, columns). ``n`` is the
    number of rows, if it is known already."""
    from tidemark.plans.partitioning import materialize
    from tidemark.session import ship_package

    if n_trees > MAX_TREES:
        raise ValueError(f"{n_trees} trees, at most {MAX_TREES}")
    n = df.count() if n is None else n
    psi = int(min(psi, n))
    if n_trees * (2 * psi - 1) > MAX_NODES:
        raise ValueError(f"{n_trees} trees of {psi} rows: more than {MAX_NODES} nodes")
    max_depth = int(math.ceil(math.log2(max(psi, 2))))
    rounded = df.select(*[F.round(F.col(c), PLACES).alias(c) for c in features], *key_cols)

    def grow(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        x = np.nan_to_num(rows[features].to_numpy(dtype="float64"), nan=0.0, posinf=0.0, neginf=0.0)
        nodes = pd.DataFrame(_grow(x, int(key[0]), max_depth, seed), columns=["node_id", "left", "right", "feature", "threshold", "size", "depth", "is_leaf"])
        nodes.insert(0, "tree_id", key[0])
        return nodes

    ship_package(df.sparkSession)
    nodes = _samples(rounded, features, key_cols, n, n_trees, psi, seed).groupBy("tree_id").applyInPandas(grow, NODE_SCHEMA)
    return {"nodes": materialize(nodes), "psi": psi, "max_depth": max_depth, "features": list(features), "n_trees": n_trees,
            "seed": seed, "n_features": len(features)}


def _arrays(nodes_pdf: pd.DataFrame, n_trees: int):
    """Dense per-tree node arrays (tree x node) for vectorised traversal."""
    width = int(nodes_pdf["node_id"].max()) + 1
    shape = (n_trees, width)
    arr = {k: np.zeros(shape, dtype=dt) for k, dt in
           [("left", "int32"), ("right", "int32"), ("feature", "int32"), ("threshold", "float64"),
            ("leafval", "float64"), ("is_leaf", "bool")]}
    arr["is_leaf"][:] = True
    t, nid = nodes_pdf["tree_id"].to_numpy(), nodes_pdf["node_id"].to_numpy()
    arr["left"][t, nid] = nodes_pdf["left"].to_numpy()
    arr["right"][t, nid] = nodes_pdf["right"].to_numpy()
    arr["feature"][t, nid] = nodes_pdf["feature"].to_numpy()
    arr["threshold"][t, nid] = nodes_pdf["threshold"].to_numpy()
    arr["is_leaf"][t, nid] = nodes_pdf["is_leaf"].to_numpy()
    arr["leafval"][t, nid] = nodes_pdf["depth"].to_numpy() + c_factor(nodes_pdf["size"].to_numpy())
    return arr


def score(df: DataFrame, model: dict, out: str = "anomaly_score") -> DataFrame:
    """score = 2 ** (-E[h(x)] / c(psi)) in (0, 1]; higher = more anomalous."""
    from tidemark.session import ship_package

    spark = df.sparkSession
    ship_package(spark)
    n_trees = int(model["n_trees"])
    if n_trees * (2 * int(model["psi"]) - 1) > MAX_NODES:
        raise ValueError(f"a model of more than {MAX_NODES} nodes is not broadcast")
    nodes_pdf = model["nodes"].toPandas()
    present = sorted(nodes_pdf["tree_id"].unique().tolist())
    arr = _arrays(nodes_pdf, n_trees)
    bc = spark.sparkContext.broadcast({"arr": arr, "trees": present, "cpsi": float(c_factor([model["psi"]])[0]),
                                       "depth": int(model["max_depth"])})
    feats = model["features"]
    schema = StructType(list(df.schema.fields) + [StructField(out, DoubleType())])

    def run(batches):
        m = bc.value
        a = m["arr"]
        for pdf in batches:
            x = np.nan_to_num(pdf[feats].to_numpy(dtype="float64"), nan=0.0, posinf=0.0, neginf=0.0)
            rows = np.arange(len(x))
            total = np.zeros(len(x))
            for t in m["trees"]:
                node = np.zeros(len(x), dtype="int64")
                for _ in range(m["depth"] + 1):
                    inner = ~a["is_leaf"][t, node]
                    if not inner.any():
                        break
                    f = a["feature"][t, node]
                    go_left = x[rows, np.maximum(f, 0)] < a["threshold"][t, node]
                    nxt = np.where(go_left, a["left"][t, node], a["right"][t, node])
                    node = np.where(inner, nxt, node)
                total += a["leafval"][t, node]
            eh = total / max(len(m["trees"]), 1)
            pdf[out] = np.power(2.0, -eh / m["cpsi"]) if m["cpsi"] > 0 else 1.0
            yield pdf

    return df.mapInPandas(run, schema)


def save(model: dict, stats: dict | None, path: str) -> None:
    """Nodes as Parquet, metadata (and scaler) as JSON next to them."""
    spark = model["nodes"].sparkSession
    model["nodes"].write.mode("overwrite").parquet(f"{path}/nodes")
    meta = {k: v for k, v in model.items() if k != "nodes"}
    meta["scaler"] = stats
    spark.createDataFrame([(json.dumps(meta),)], "meta string").coalesce(1).write.mode("overwrite").text(f"{path}/meta")


def load(spark, path: str) -> tuple[dict, dict | None]:
    meta = json.loads(spark.read.text(f"{path}/meta").first()[0])
    stats = meta.pop("scaler", None)
    meta["nodes"] = spark.read.parquet(f"{path}/nodes")
    return meta, stats


# ------------------------------------------------------------ compositions
MODEL_FEATURES = ["price_return", "volume_change", "volatility", "breakout_strength", "is_breakout", "pv_divergence"]


def align_features(df: DataFrame, cols=MODEL_FEATURES, keep=()) -> DataFrame:
    """The model feature vector in order: present columns as double, absent
    ones as 0.0, extra columns dropped (``keep`` columns are carried)."""
    return df.select(*keep, *[(F.col(c).cast("double") if c in df.columns else F.lit(0.0)).alias(c) for c in cols])


def train(features_df: DataFrame, cols=MODEL_FEATURES, key_cols=("symbol", "ts"), n_trees: int = 100, psi: int = 256,
          seed: int = 42, contamination: float | None = None) -> tuple[dict, dict]:
    """Scaler + forest on a feature table (all symbols in one job).

    With ``contamination`` the model also keeps a decision threshold: the
    exact (1 - contamination) quantile of the training scores, used by
    ``score_frame`` for an ``is_anomaly`` flag."""
    cols = [c for c in cols]
    aligned = align_features(features_df, cols, key_cols)
    stats = scaler_stats(aligned, cols)
    if all(s == 1.0 for s in stats["scale"]) and all(m == 0.0 for m in stats["mean"]):
        raise ValueError("all model features are constant")
    scaled = scale(aligned, stats)
    model = fit(scaled, cols, list(key_cols), n_trees, psi, seed, stats["rows"])
    if contamination:
        from tidemark.operators.stats import exact_quantile
        from tidemark.plans.partitioning import materialize

        train_scores = materialize(score(scaled, model).select(F.lit(0).alias("_k"), "anomaly_score"))  # read twice
        q = exact_quantile(train_scores, 1.0 - float(contamination), "_k", "anomaly_score", out="t").first()
        model["threshold"] = float(q["t"])
    return model, stats


def score_frame(features_df: DataFrame, model: dict, stats: dict, window: int = 100, **plan) -> DataFrame:
    """Score every row; risk % = rolling min-max of the last ``window``
    scores per symbol (flat -> 50); model band on the risk %."""
    from tidemark.functions.scalar import band_model
    from tidemark.functions.series import minmax_pct
    from tidemark.plans.partitioning import over_series

    cols = stats["columns"]
    aligned = align_features(features_df, cols, [c for c in features_df.columns if c not in cols])
    # scaled copies next to the raw features: scored, then dropped (no join, so no row is lost or multiplied)
    scaled = aligned.withColumns({"_z_" + c: F.round((F.col(c) - F.lit(m)) / F.lit(s), PLACES)
                                  for c, m, s in zip(cols, stats["mean"], stats["scale"])})
    scored = score(scaled, {**model, "features": ["_z_" + c for c in cols]}).drop(*["_z_" + c for c in cols])
    out = over_series(scored, lambda d, s: d.withColumn("risk_percentage", minmax_pct("anomaly_score", s, window)),
                      halo=window, reread=True, **plan)  # rows are scored once
    out = out.withColumn("risk_level", band_model("risk_percentage"))
    if model.get("threshold") is not None:
        out = out.withColumn("is_anomaly", F.col("anomaly_score") > F.lit(model["threshold"]))
    return out


def latest_risk(scored: DataFrame) -> DataFrame:
    from tidemark.operators.risk import latest_per_symbol

    return latest_per_symbol(scored).select("symbol", "ts", "anomaly_score", "risk_percentage")
