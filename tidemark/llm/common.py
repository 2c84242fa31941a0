"""Helpers shared by the corpus operators: scratch tables in the shared folder,
free column names, document keys, and connected components.

Every operator reads only the columns it names, so extra columns of any name
in its input are harmless; where the input's rows are returned, internal
columns get names that the input does not use (``free``).
"""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import ensure_checkpoint_dir


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write ``df`` to the shared folder (``spark.checkpoint.dir``)
    and read it back. A lost executor then costs a re-read, not a recompute."""
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/tidemark-llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def settings(spark: SparkSession, conf: dict[str, str]):
    """Session settings that hold inside."""
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def free(df: DataFrame, base: str) -> str:
    """A column name built on ``base`` that ``df`` does not use (case-insensitive)."""
    used = {c.lower() for c in df.columns}
    name = base
    while name.lower() in used:
        name += "_"
    return name


def body(text: str | Column = "text") -> Column:
    """The text of a row; null counts as empty."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def connected_components(links: DataFrame, name: str = "components", max_rounds: int = 60) -> DataFrame:
    """Connected components of an undirected graph by alternating large-star
    and small-star rounds.

    ``links`` has long columns ``a`` and ``b``. Returns one row per linked node:
    ``node``, ``root`` (the smallest node of its component). Links stay in
    written tables; the driver only sees two numbers a round. Raises if the
    rounds do not settle (they take about the logarithm of the longest chain).
    """
    edges = written(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
                    name)
    before = None
    for k in range(max_rounds):
        seen = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if seen == before or seen[0] == 0:
            return (edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
                    .unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct())
        before = seen
        # large star: every neighbour above u joins the least of u's neighbourhood
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        # small star: u and its smaller neighbours join the least of them
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(least.select("a", F.col("m").alias("b"))).distinct())
        edges = written(small, f"{name}-{k}")
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
