"""Toxicity by non-negative positive-unlabelled (nnPU) learning.

Confirmed toxic examples and a sample of unlabelled texts train a linear
classifier (numpy) under the class-prior-corrected risk estimator
``prior * R_p(+) + max(0, R_u(-) - prior * R_p(-))`` with logistic loss; a
step climbs back when the corrected negative risk falls below zero. The prior
is the toxic share of the labelled training rows.

Features are the distinct words of a text and their leading 4, 5 and 6
letters, so compounds of a word count as the word. Document frequencies over
the two samples choose the features that are frequent in toxic examples.

Bounds (documented parameters of the fit): ``POSITIVES`` toxic examples and
``UNLABELLED`` texts, chosen by a hash of doc_id; every text is scored whole.

Defined cases: null and empty texts get the score of no features; rows with a
null ``doc_id`` are never trained on and count as held out; repeated label rows
count once, conflicting ones as toxic; without any toxic label every score is
0; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import free, written

POSITIVES = 4000
UNLABELLED = 12_000
FEATURES = 3000  # most features of a model
LEAST_FEATURES, LEAST_GAIN = 400, 3.5  # beyond the first 400, a feature needs this gain (in standard deviations)
FOLDS = 5
_WORD = re.compile(r"[^\W\d_]+")


def held_out(doc_id: str | Column = "doc_id", folds: int = FOLDS, fold: int = 0) -> Column:
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(c.cast("string")) % folds == fold, F.lit(True))


def features(text: str | None) -> set[str]:
    words = set(_WORD.findall((text or "").lower()))
    out = {w for w in words if len(w) > 2}
    for n in (4, 5, 6):
        out.update([w[:n] + "*" for w in words if len(w) > n])
    return out


def _share(df: DataFrame, salt: str, bound: int) -> DataFrame:
    """About ``bound`` rows, by a hash of doc_id."""
    n = df.count()
    if n <= bound:
        return df
    return df.where(F.pmod(F.xxhash64(F.lit(salt), "doc_id"), F.lit(1 << 30)) < int((1 << 30) * bound / n))


class Model:
    """Weights by feature and a bias; ``score`` is the probability of label 1."""

    def __init__(self, weights: dict[str, float], bias: float):
        self.weights, self.bias = weights, bias

    def score(self, text: str | None) -> float:
        w = self.weights
        if not w and self.bias == -np.inf:
            return 0.0
        z = self.bias + sum(w[f] for f in features(text) if f in w)
        return float(1 / (1 + np.exp(-np.clip(z, -40, 40))))


def nnpu(pos: list[list[int]], unl: list[list[int]], size: int, prior: float, steps: int = 400, rate: float = 0.05,
         decay: float = 1e-4) -> tuple[np.ndarray, float]:
    """Linear nnPU fit on sparse presence rows (feature indexes a row)."""
    rows = pos + unl
    at = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    col = np.array([c for r in rows for c in r], np.int64)
    is_pos = np.arange(len(rows)) < len(pos)
    w, b = np.zeros(size), 0.0
    m1, m2 = np.zeros(size + 1), np.zeros(size + 1)

    def sigmoid(z):
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))

    for k in range(1, steps + 1):
        z = np.bincount(at, w[col], len(rows)) + b
        soft = np.logaddexp(0, z)  # logistic loss for the negative class
        negative = soft[~is_pos].mean() - prior * soft[is_pos].mean()
        s = sigmoid(z)
        g = np.zeros(len(rows))
        down = np.where(is_pos, -prior * s / len(pos), s / len(unl))  # gradient of the corrected negative risk
        if negative >= 0:
            g = down + np.where(is_pos, prior * (s - 1) / len(pos), 0)
        else:
            g = -down
        grad = np.r_[np.bincount(col, g[at], size) + decay * w, g.sum()]
        m1, m2 = 0.9 * m1 + 0.1 * grad, 0.999 * m2 + 0.001 * grad * grad
        step = rate * (m1 / (1 - 0.9 ** k)) / (np.sqrt(m2 / (1 - 0.999 ** k)) + 1e-8)
        w, b = w - step[:-1], b - step[-1]
    return w, float(b)


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Train on the rows of ``labels`` outside the held-out fold and on unlabelled text."""
    known = (labels.where(~held_out()).where("toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    n, toxic = known.agg(F.count(F.lit(1)), F.sum("toxic")).first()
    if not n or not toxic:
        return Model({}, -np.inf)
    prior = toxic / n
    wanted = _share(known.where("toxic = 1").select("doc_id"), "p", POSITIVES).limit(2 * POSITIVES)
    text = docs.select("doc_id", "text")
    # at most 2 * POSITIVES ids are broadcast
    pos = text.join(F.broadcast(wanted), "doc_id", "left_semi").select(F.lit(True).alias("pos"), "text")
    unl = _share(text.where(~held_out()), "u", UNLABELLED).select(F.lit(False).alias("pos"), "text")

    @F.pandas_udf("array<string>")
    def listed(t: pd.Series) -> pd.Series:
        return t.map(lambda x: sorted(features(x)))

    sample = written(pos.unionByName(unl).select("pos", listed("text").alias("f")), "op3-sample")
    sizes = {r["pos"]: r["count"] for r in sample.groupBy("pos").count().collect()}
    n_pos, n_unl = sizes.get(True, 0), sizes.get(False, 0)
    if not n_pos or not n_unl:
        return Model({}, -np.inf)
    df = (sample.select("pos", F.explode("f").alias("f")).groupBy("f")
          .agg(F.sum(F.col("pos").cast("long")).alias("p"), F.sum((~F.col("pos")).cast("long")).alias("u")))
    ratio = F.col("p") / n_pos / ((F.col("u") + 1) / n_unl)
    # how far a feature is over-represented in toxic examples, in standard deviations
    gain = (F.col("p") - F.col("u") * (n_pos / n_unl)) / F.sqrt(F.col("p") + F.col("u") * (n_pos / n_unl) + 1)
    chosen = df.where((F.col("p") >= 3) & (ratio > 2)).select("f", gain.alias("gain")).orderBy(F.desc("gain"), "f").limit(FEATURES).collect()
    index = {r["f"]: i for i, r in enumerate(chosen) if i < LEAST_FEATURES or r["gain"] > LEAST_GAIN}
    names = F.array(*[F.lit(f) for f in index]) if index else F.array().cast("array<string>")
    rows = sample.select("pos", F.array_intersect("f", names).alias("f")).collect()
    w, b = nnpu([[index[f] for f in r["f"]] for r in rows if r["pos"]], [[index[f] for f in r["f"]] for r in rows if not r["pos"]],
                len(index), prior)
    return Model({f: float(w[i]) for f, i in index.items() if w[i] != 0}, b)


def scorer(model: Model):
    """Column function: text -> score."""
    @F.pandas_udf("double")
    def score(t: pd.Series) -> pd.Series:
        return t.map(model.score).astype("float64")

    return score


def toxicity(docs: DataFrame, labels: DataFrame, model: Model | None = None) -> DataFrame:
    """One row per document: ``doc_id``, ``held_out``, ``score``, ``predicted``."""
    score = scorer(model or fit(docs, labels))
    return (docs.select("doc_id", held_out().alias("held_out"), score("text").alias("score"))
            .withColumn("predicted", (F.col("score") >= 0.5).cast("int")))


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the rows predicted toxic."""
    mark = free(docs, "_score")
    return docs.withColumn(mark, scorer(fit(docs, labels))("text")).where(F.col(mark) < 0.5).select(*docs.columns)
