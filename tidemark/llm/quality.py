"""Quality classifier by non-negative positive-unlabelled learning.

Trusted positives are documents labelled as good; unlabelled web text is any documents; the class prior
is the share of good ones among the labelled. A linear model minimises the non-negative unbiased risk
``prior * R+(positives) + max(0, R-(unlabelled) - prior * R-(positives))`` with logistic loss, so its
sigmoid is the probability of a good document. Where the second term turns negative, which only
overfitting can do, the step goes back on it.

Features say how a text is built, not what it says: frequencies of pairs of byte classes, and how far
words and lines repeat. Every text is read whole. Training takes a bounded sample: at most ``SAMPLE``
positives and ``SAMPLE`` unlabelled documents, those of the smallest hash of their id; the prior is
counted over all labels outside the held-out fold. Scoring is one pass without a shuffle.

Defined cases: null and empty texts are scored by their zero features; a null doc_id counts as held out
and is never learned from; a document with both labels is none; no positives at all score everything
0.5; an empty table gives no rows; other columns are ignored or, by ``accepted``, carried.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SAMPLE = 20_000
FOLDS = 5
THRESHOLD = 0.3
STEPS = 600
RATE = 0.05
RIDGE = 1e-4

#: Byte classes: bytes of one string share a class; the rest fall into lower case, upper case, digits,
#: other signs, and bytes beyond ASCII.
_CLASSES = (" ", "\n", "\t\r\v\f", ".", ",;:", "!", "?", "#$%&*", "|", "<>{}[]\\/=_", "'\"-()")
_N = len(_CLASSES) + 5
_SLICE = 1 << 20


def _class_table() -> np.ndarray:
    table = np.full(256, _N - 2, np.uint8)
    for c in range(256):
        if chr(c).isascii() and chr(c).isalnum():
            table[c] = _N - 5 + (chr(c).isupper() + 2 * chr(c).isdigit())
        elif c >= 128:
            table[c] = _N - 1
    for k, signs in enumerate(_CLASSES):
        table[list(signs.encode())] = k
    return table


_TABLE = _class_table()
N_FEATURES = _N * _N + 6


def features(text: str | None) -> np.ndarray:
    """Feature vector of one whole text."""
    out = np.zeros(N_FEATURES, np.float32)
    data = (text or "").encode("utf-8", "surrogatepass")
    if not data:
        return out
    pairs = np.zeros(_N * _N, np.int64)
    for at in range(0, max(1, len(data) - 1), _SLICE):
        kinds = _TABLE[np.frombuffer(data[at : at + _SLICE + 1], np.uint8)]
        pairs += np.bincount(kinds[:-1].astype(np.uint16) * _N + kinds[1:], minlength=_N * _N)
    out[: _N * _N] = np.sqrt(pairs / max(1, len(data) - 1))
    words = data.split()
    lines = [x for x in data.split(b"\n") if x.strip()]
    n = max(1, len(words))
    out[_N * _N :] = (
        sum(map(eq, words, words[1:])) / n,
        len(set(words)) / n,
        sum(map(len, words)) / n / 10,
        np.log1p(len(words)) / 10,
        1 - len(set(lines)) / max(1, len(lines)),
        min(1.0, len(words) / max(1, len(lines)) / 200),
    )
    return out


def fold(doc_id: Column) -> Column:
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(FOLDS))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(fold(doc_id) == 0, F.lit(True))


@dataclass(frozen=True)
class Model:
    """Weights over standardised features; ``prior`` is the estimated share of good documents."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float
    prior: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Probabilities of a good document; features far out count as eight deviations."""
        return _sigmoid(np.clip((x - self.mean) / self.scale, -8, 8) @ self.weights + self.bias)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def minimise(positive: np.ndarray, unlabelled: np.ndarray, prior: float) -> Model:
    """Fit by full-batch Adam steps on the non-negative risk."""
    both = np.concatenate([positive, unlabelled]).astype(np.float32)
    mean = both.mean(axis=0, dtype=np.float64)
    scale = np.sqrt(((both - mean.astype(np.float32)) ** 2).mean(axis=0, dtype=np.float64))
    scale = np.maximum(scale, 1e-3)
    both -= mean.astype(np.float32)
    both /= scale.astype(np.float32)
    np.clip(both, -8, 8, out=both)
    both = np.column_stack([both, np.ones(len(both), np.float32)])
    p, u = both[: len(positive)], both[len(positive) :]
    w = np.zeros(p.shape[1])
    m, v = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, STEPS + 1):
        now = w.astype(np.float32)
        zp, zu = p @ now, u @ now
        negative = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
        up = -p.T @ _sigmoid(-zp) / len(p)
        down = u.T @ _sigmoid(zu) / len(u) - prior * (p.T @ _sigmoid(zp)) / len(p)
        grad = prior * up + down if negative >= 0 else -down
        grad[:-1] += RIDGE * w[:-1]
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        w -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return Model(mean, scale, w[:-1], float(w[-1]), prior)


@F.pandas_udf(T.BinaryType())
def _vectors(texts: pd.Series) -> pd.Series:
    """Feature vectors as bytes, a quarter of the size they have as numbers of Python."""
    return pd.Series([features(t).tobytes() for t in texts])


def _sampled(docs: DataFrame, ids: DataFrame, sample: int) -> np.ndarray:
    """Features of the ``sample`` documents of the smallest hash; only their ids are sorted and sent."""
    hashed = F.xxhash64(F.col("doc_id").cast("string"))
    chosen = ids.select("doc_id").distinct().orderBy(hashed, "doc_id").limit(sample)
    rows = docs.join(F.broadcast(chosen), "doc_id", "left_semi").select("doc_id", _vectors("text").alias("x"))
    # Of rows alike in doc_id one counts, the same in every run.
    found = sorted(rows.groupBy("doc_id").agg(F.min("x").alias("x")).collect(), key=lambda r: r["doc_id"])
    return np.frombuffer(b"".join(r["x"] for r in found), np.float32).reshape(-1, N_FEATURES)


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model | None:
    """The model learned outside the held-out fold; None where nothing is known to be good."""
    known = labels.filter(F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id")))
    per_doc = known.groupBy("doc_id").agg(F.min("quality").alias("low"), F.max("quality").alias("high"))
    per_doc = per_doc.filter("low = high").select("doc_id", "low")
    good, rated = per_doc.agg(F.sum("low"), F.count("low")).first()
    if not good:
        return None
    positive = _sampled(docs, per_doc.filter("low = 1"), sample)
    unlabelled = _sampled(docs, docs.filter(~held_out(F.col("doc_id"))), sample)
    if not len(positive) or not len(unlabelled):
        return None
    return minimise(positive, unlabelled, (good + 0.5) / (rated + 1))


def _scored(model: Model | None):
    """A scoring function whose state is a few hundred numbers."""

    @F.pandas_udf(T.DoubleType())
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            if model is None:
                yield pd.Series(np.full(len(texts), 0.5))
                continue
            x = np.zeros((len(texts), N_FEATURES), np.float32)
            for i, text in enumerate(texts):
                x[i] = features(text)
            yield pd.Series(model.scores(x))

    return score


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """Per document: held_out, score and the class at THRESHOLD."""
    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), _scored(model)("text").alias("score"))
    return rows.withColumn("predicted", F.when(F.col("score") >= THRESHOLD, 1).otherwise(0))


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the classifier takes for good, with their columns."""
    model = fit(docs, labels)
    rows = docs.select(F.struct(*docs.columns).alias("doc"), _scored(model)("text").alias("score"))
    return rows.filter(F.col("score") >= THRESHOLD).select("doc.*")
