"""Isolation Forest invariants (no oracle): range, determinism, extremes, persistence."""

import numpy as np
from pyspark.sql import functions as F

from tidemark.operators import anomaly as AN


def data(spark, n=4000, planted=5):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(n, 3))
    x[:planted] = 12.0
    rows = [(f"S{i % 5}", i, *map(float, r)) for i, r in enumerate(x)]
    return spark.createDataFrame(rows, "symbol string, seq long, a double, b double, c double")


def test_scores_range_and_extremes(spark):
    df = data(spark)
    model = AN.fit(df, ["a", "b", "c"], ["symbol", "seq"], n_trees=50)
    sc = AN.score(df, model).toPandas()
    assert ((sc.anomaly_score > 0) & (sc.anomaly_score <= 1)).all()
    top = sc.sort_values("anomaly_score", ascending=False).head(20)
    assert set(range(5)) <= set(top.seq)


def test_deterministic_across_partitioning(spark):
    df = data(spark, 2000)
    a = AN.fit(df, ["a", "b", "c"], ["symbol", "seq"], n_trees=20)["nodes"]
    b = AN.fit(df.repartition(7), ["a", "b", "c"], ["symbol", "seq"], n_trees=20)["nodes"]
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_tree_size_bound(spark):
    df = data(spark, 3000)
    nodes = AN.fit(df, ["a", "b", "c"], ["symbol", "seq"], n_trees=10, psi=64)["nodes"]
    per_tree = nodes.groupBy("tree_id").count().agg(F.max("count")).first()[0]
    assert per_tree <= 2 * 64 - 1
    leaves = nodes.filter("is_leaf").groupBy("tree_id").agg(F.sum("size").alias("s")).collect()
    assert {r["s"] for r in leaves} == {64}


def test_save_load_round_trip(spark, tmp_path):
    df = data(spark, 1000)
    model = AN.fit(df, ["a", "b", "c"], ["symbol", "seq"], n_trees=10)
    path = str(tmp_path / "m")
    AN.save(model, {"columns": ["a", "b", "c"], "mean": [0, 0, 0], "scale": [1, 1, 1]}, path)
    loaded, stats = AN.load(spark, path)
    assert stats["columns"] == ["a", "b", "c"] and loaded["psi"] == model["psi"]
    s1 = AN.score(df, model).select("seq", "anomaly_score")
    s2 = AN.score(df, loaded).select("seq", "anomaly_score")
    assert s1.exceptAll(s2).count() == 0


def test_contamination_threshold(spark):
    df = data(spark, 3000).withColumn("ts", F.col("seq"))
    model, stats = AN.train(df, ["a", "b", "c"], ("symbol", "ts"), n_trees=30, contamination=0.1)
    sc = AN.score_frame(df, model, stats)
    share = sc.agg(F.avg(F.col("is_anomaly").cast("double"))).first()[0]
    assert abs(share - 0.1) < 0.01


def test_registry_promotes_only_a_better_sound_model(spark, tmp_path):

    import pytest

    from tidemark.operators import registry as RG

    path = str(tmp_path / "registry")
    rows = data(spark, 1500).withColumn("ts", F.timestamp_seconds(F.col("seq") * 60 + 1_700_000_000))
    kw = {"cols": ["a", "b", "c"], "n_trees": 20}
    first = RG.retrain(rows, path, **kw).first()
    assert first["promoted"] and first["current_margin"] is None and first["reload_difference"] == 0.0
    assert first["train_rows"] + first["validation_samples"] == 1500 and first["kept_scores"] == 500
    again = RG.retrain(rows, path, **kw).first()
    assert not again["promoted"] and again["margin"] == again["current_margin"]
    assert RG.promotions(spark, path) == [first["model"]]
    assert not RG.promote(spark, path, again["model"], [])  # another trainer was faster
    model, stats, windows = RG.load_model(spark, first["model"])
    assert model["metadata"]["features"] == ["a", "b", "c"] and windows.count() == 5
    with pytest.raises(ValueError):
        AN.fit(rows, ["a"], ["seq"], n_trees=AN.MAX_TREES + 1)


def test_scores_go_on_from_saved_windows(spark):
    """Scoring in two parts, the second from the windows of the first, equals scoring at once."""
    from tidemark.operators import registry as RG

    rows = data(spark, 900).withColumn("ts", F.timestamp_seconds(F.col("seq") * 60 + 1_700_000_000))
    model, stats = AN.train(rows, ["a", "b", "c"], n_trees=20)
    whole = AN.score_frame(rows, model, stats)
    early = AN.score_frame(rows.where("seq < 700"), model, stats)
    late = RG.score_onward(rows.where("seq >= 700"), model, stats, RG.score_windows(early))
    want = {r["seq"]: r["risk_percentage"] for r in whole.where("seq >= 700").collect()}
    got = {r["seq"]: r["risk_percentage"] for r in late.collect()}
    assert got == want and sorted(late.columns) == sorted(whole.columns)
