"""Language id by hierarchical discrimination.

First the language family, then one-versus-one linear support vector machines
between the languages of that family. Texts become hashed counts of their
character one- to three-grams (letters only, everything else a blank), square
root, unit length. All machines are squared-hinge fits in numpy on a bounded
sample of labelled rows: ``PER_LANGUAGE`` documents a language, chosen by a
hash of doc_id (a documented bound of the fit); every text is classified whole.

Defined cases: null text and text without letters are ``und`` with score 0;
rows without a language or in the held-out fold are never trained on; rows with
a null ``doc_id`` count as held out; languages missing from ``FAMILIES`` are a
family of their own; with one family or one language there is nothing to
separate; without training rows all is ``und``; other columns are ignored.
"""

from __future__ import annotations

import re
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.toxicity import held_out

PER_LANGUAGE = 1500
DIMENSIONS = 2048
FOLDS, FOLD = 3, 1
FAMILIES = {  # fixed values: language -> family
    "en": "germanic", "de": "germanic", "nl": "germanic", "sv": "germanic", "da": "germanic", "no": "germanic",
    "fr": "romance", "es": "romance", "it": "romance", "pt": "romance", "ro": "romance", "ca": "romance",
    "ru": "slavic", "uk": "slavic", "pl": "slavic", "cs": "slavic", "sk": "slavic", "bg": "slavic",
}
_OTHER = re.compile(r"[\W\d_]+")


def vector(text: str | None) -> np.ndarray | None:
    """Unit vector of a text, None without letters."""
    plain = _OTHER.sub(" ", (text or "").lower()).strip()
    if not plain:
        return None
    c = np.frombuffer(f" {plain} ".encode("utf-32-le"), np.uint32)
    g2 = c[:-1] * np.uint32(0x9E3779B1) + c[1:]
    g3 = g2[:-1] * np.uint32(0x85EBCA6B) + c[2:]
    grams = np.concatenate((c, g2, g3)) * np.uint32(0xC2B2AE35)
    v = np.sqrt(np.bincount(grams >> np.uint32(32 - DIMENSIONS.bit_length() + 1), minlength=DIMENSIONS).astype(np.float32))
    return v / np.linalg.norm(v)


def svm(x: np.ndarray, y: np.ndarray, steps: int = 150, rate: float = 0.3, decay: float = 1e-4) -> tuple[np.ndarray, float]:
    """Linear machine for labels +1 and -1: squared hinge, classes weighted alike."""
    weight = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum())).astype(np.float32)
    w, b = np.zeros(x.shape[1], np.float32), np.float32(0)
    m1, m2 = np.zeros(x.shape[1] + 1), np.zeros(x.shape[1] + 1)
    for k in range(1, steps + 1):
        slack = np.maximum(0, 1 - y * (x @ w + b))
        g = (-2 * weight * y * slack).astype(np.float32)
        grad = np.r_[x.T @ g + decay * w, g.sum()]
        m1, m2 = 0.9 * m1 + 0.1 * grad, 0.999 * m2 + 0.001 * grad * grad
        step = rate * (m1 / (1 - 0.9 ** k)) / (np.sqrt(m2 / (1 - 0.999 ** k)) + 1e-8)
        w, b = (w - step[:-1]).astype(np.float32), np.float32(b - step[-1])
    return w, float(b)


def _vote(v: np.ndarray, machines: dict[tuple[str, str], tuple[np.ndarray, float]], names: list[str]) -> tuple[str, float]:
    """One-versus-one vote: the winner, and the confidence of its closest duel."""
    if len(names) == 1:
        return names[0], 1.0
    won, worst = dict.fromkeys(names, 0), dict.fromkeys(names, np.inf)
    total = dict.fromkeys(names, 0.0)
    for (p, q), (w, b) in machines.items():
        z = float(v @ w + b)
        won[p if z > 0 else q] += 1
        for name, m in ((p, z), (q, -z)):
            worst[name] = min(worst[name], m)
            total[name] += m
    best = max(names, key=lambda n: (won[n], total[n], n))
    return best, 1 / (1 + float(np.exp(-np.clip(2 * worst[best], -40, 40))))


class Model:
    def __init__(self, vectors: np.ndarray, langs: list[str]):
        names = sorted(set(langs))
        family = [FAMILIES.get(n, n) for n in langs]
        self.families = {f: [n for n in names if FAMILIES.get(n, n) == f] for f in sorted(set(family))}
        self.between = self._duels(vectors, np.array(family, object), list(self.families))
        self.within = {f: self._duels(vectors, np.array(langs, object), own) for f, own in self.families.items()}

    @staticmethod
    def _duels(x, of, names):
        out = {}
        for p, q in combinations(names, 2):
            rows = (of == p) | (of == q)
            out[p, q] = svm(x[rows], np.where(of[rows] == p, 1, -1).astype(np.float32))
        return out

    def predict(self, text: str | None) -> tuple[str, float]:
        v = vector(text) if self.families else None
        if v is None:
            return "und", 0.0
        family, s1 = _vote(v, self.between, list(self.families))
        lang, s2 = _vote(v, self.within[family], self.families[family])
        return lang, s1 * s2


def fit(docs: DataFrame) -> Model:
    rows = docs.where(~held_out("doc_id", FOLDS, FOLD)).where("lang is not null").select("doc_id", "text", "lang")
    counts = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    if not counts:
        return Model(np.zeros((0, DIMENSIONS), np.float32), [])
    share = F.lit(0)
    for lang, n in sorted(counts.items()):
        share = F.when(F.col("lang") == lang, int((1 << 30) * min(1, PER_LANGUAGE / n))).otherwise(share)
    sample = rows.where(F.pmod(F.xxhash64(F.lit("l"), "doc_id"), F.lit(1 << 30)) < share)

    @F.pandas_udf("binary")
    def packed(t: pd.Series) -> pd.Series:
        return t.map(lambda x: None if (v := vector(x)) is None else v.tobytes())

    got = [r for r in sample.select("lang", packed("text").alias("v")).collect() if r["v"] is not None]
    x = np.stack([np.frombuffer(r["v"], np.float32) for r in got]) if got else np.zeros((0, DIMENSIONS), np.float32)
    return Model(x, [r["lang"] for r in got])


def language_id(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """One row per document: ``doc_id``, ``held_out``, ``lang_pred``, ``score``."""
    model = model or fit(docs)

    @F.pandas_udf("lang string, score double")
    def predict(t: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([model.predict(x) for x in t], columns=["lang", "score"])

    out = docs.select("doc_id", held_out("doc_id", FOLDS, FOLD).alias("held_out"), predict("text").alias("p"))
    return out.select("doc_id", "held_out", F.col("p.lang").alias("lang_pred"), F.col("p.score").alias("score"))
