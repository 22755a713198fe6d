"""Toxicity: a linear classifier of character n-grams scaled by naive Bayes log-count ratios.

A text's features are the distinct n-grams of its lower-cased characters, hashed.  The ratio
r of a feature is the logarithm of its smoothed share among toxic documents over its share
among the others.  Logistic regression with a quadratic penalty is fitted to the features
scaled by r; a document scores the logistic function of its sum.

The classifier is fitted on the driver to a bounded sample of labelled rows: at most
`TOXIC_ROWS` toxic and `CLEAN_ROWS` other documents, those first by a hash of their key.
Its weights (`FEATURES` numbers at most) go to the executors; every text is scored in one pass.

Defined results: a null text counts as empty and scores the intercept; labels that are null, or given for
no document, teach nothing; repeated rows are scored one by one; if one class has no labelled
row, every document scores the share of toxic rows (0 without labels); an empty table gives
an empty result; extra columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playlog.llm.common import text_of

ORDERS = (3, 4, 5, 6)
SPACE_BITS = 20
TOXIC_ROWS, CLEAN_ROWS = 2000, 4000
#: Features kept: those whose ratio tells most, if enough documents have them.
FEATURES = 1 << 13
LEAST_ROWS = 4
SMOOTHING = 1.0
PENALTY = 1e-4
ROUNDS = 120
PREDICTED = 0.7
#: Characters of one text that are worked on at once.
PIECE = 1 << 18
_U = np.uint64


@dataclass
class Model:
    """Weight (ratio times coefficient) by feature number, 0 if not kept; and the intercept."""

    weights: np.ndarray
    intercept: float


def ngrams(text: str):
    """Feature numbers of the n-grams of all ORDERS, with repeats, piece by piece."""
    text = text.lower()
    for at in range(0, max(1, len(text)), PIECE):
        part = text[at:at + PIECE + max(ORDERS) - 1]
        codes = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), "<u4").astype(_U) + _U(1)
        run = np.zeros(len(codes), _U)
        for n in range(1, max(ORDERS) + 1):
            if len(codes) < n:
                break
            run = run[:len(codes) - n + 1] * _U(0xD6E8FEB86659FD93) + codes[n - 1:]
            if n in ORDERS:
                yield ((run * _U(0x9E3779B97F4A7C15)) >> _U(64 - SPACE_BITS)).astype(np.intp)


def distinct(text: str, of: np.ndarray | None = None) -> np.ndarray:
    """Distinct feature numbers of a text, sorted; only those that `of` marks, if given."""
    found = [x if of is None else x[of[x]] for x in ngrams(text)]
    return np.unique(np.concatenate(found)) if found else np.zeros(0, np.intp)


def logistic(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35, 35)))


def fit(texts: list[str], toxic: np.ndarray) -> Model:
    """`toxic` has 0 or 1 for each text."""
    size = 1 << SPACE_BITS
    share = float(toxic.mean()) if len(toxic) else 0.0
    if share in (0.0, 1.0):
        return Model(np.zeros(size), 35.0 if share else -35.0)
    bad, good = np.zeros(size), np.zeros(size)
    for text, t in zip(texts, toxic, strict=True):
        (bad if t else good)[distinct(text)] += 1
    #: shares of documents, as each document has a feature once
    ratio = np.log((bad + SMOOTHING) / (toxic.sum() + 2 * SMOOTHING)) - np.log(
        (good + SMOOTHING) / ((1 - toxic).sum() + 2 * SMOOTHING))
    tells = np.abs(ratio) * np.sqrt(bad + good) * (bad + good >= LEAST_ROWS)
    keep = np.sort(np.argsort(-tells, kind="stable")[:FEATURES])
    keep = keep[tells[keep] > 0]
    marked = np.zeros(size, bool)
    marked[keep] = True
    own = [np.searchsorted(keep, distinct(text, marked)) for text in texts]
    col = np.concatenate(own)
    row = np.repeat(np.arange(len(own)), [len(x) for x in own])
    value = ratio[keep][col]
    dot = lambda w: np.bincount(row, value * w[col], minlength=len(own))
    back = lambda g: np.bincount(col, value * g[row], minlength=len(keep))
    step = 1.0 / (_largest(dot, back, len(keep)) / len(own) / 4 + PENALTY + 0.25)
    w, b = np.zeros(len(keep)), float(np.log(share / (1 - share)))
    vw, vb, t = w, b, 1.0
    for _ in range(ROUNDS):
        g = logistic(dot(vw) + vb) - toxic
        nw = vw - step * (back(g) / len(own) + PENALTY * vw)
        nb = vb - step * g.mean()
        t, was = (1 + (1 + 4 * t * t) ** 0.5) / 2, t
        vw, vb = nw + (was - 1) / t * (nw - w), nb + (was - 1) / t * (nb - b)
        w, b = nw, nb
    weights = np.zeros(size)
    weights[keep] = w * ratio[keep]
    return Model(weights, float(b))


def _largest(dot, back, n: int) -> float:
    """Largest eigenvalue of a matrix times its transpose, by power iteration, with a margin."""
    x, size = np.ones(n), 1.0
    for _ in range(15):
        x = back(dot(x))
        size = float(np.linalg.norm(x)) or 1.0
        x /= size
    return 1.1 * size


def score(model: Model, marked: np.ndarray, text: str) -> float:
    """`marked` tells which features have a weight."""
    return float(logistic(model.weights[distinct(text, marked)].sum() + model.intercept))


def train(docs: DataFrame, labels: DataFrame, use: Column, key: str = "doc_id",
          text: str = "text", label: str = "toxic") -> Model:
    """Fit to the labelled rows for which `use`, a condition on the key, holds."""
    given = labels.where(use).select(labels[key].alias("key"), labels[label].alias("label")).where(
        "key IS NOT NULL AND label IN (0, 1)").groupBy("key").agg(F.max("label").alias("label"))
    order = F.xxhash64("key")
    sample = given.where("label = 1").orderBy(order, "key").limit(TOXIC_ROWS).union(
        given.where("label = 0").orderBy(order, "key").limit(CLEAN_ROWS))
    rows = docs.select(docs[key].alias("key"), text_of(text).alias("text"))
    #: TOXIC_ROWS + CLEAN_ROWS keys at most
    found = rows.join(F.broadcast(sample), "key").select("key", "label", "text")
    texts, toxic = [], []
    for r in found.orderBy("key", "text").limit(TOXIC_ROWS + CLEAN_ROWS).toLocalIterator():
        texts.append(r["text"])
        toxic.append(r["label"])
    return fit(texts, np.array(toxic, float))


def toxicity(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of `docs`: key, score (0 to 1) and predicted."""
    kind = docs.schema[key].dataType.simpleString()

    places = np.flatnonzero(model.weights)
    small = places, model.weights[places], model.intercept  # FEATURES numbers at most

    def judge(batches):
        own = Model(np.zeros(1 << SPACE_BITS), small[2])
        own.weights[small[0]] = small[1]
        marked = own.weights != 0
        for b in batches:
            s = [score(own, marked, t.as_py()) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(s, pa.float64()),
                 pa.array([int(x >= PREDICTED) for x in s], pa.int32())],
                ["key", "score", "predicted"])

    return docs.select(docs[key].alias("key"), text_of(text).alias("text")).mapInArrow(
        judge, f"key {kind}, score double, predicted int").withColumnRenamed("key", key)
