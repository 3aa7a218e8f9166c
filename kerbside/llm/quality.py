"""Quality classifier: random-indexing word vectors, pooled per document, and a two-layer network.

Random indexing: every token (a run of letters and digits, or a run of signs) falls into one of
BUCKETS hash buckets; each bucket has a fixed sparse index vector of +1 and -1. A bucket's word
vector is the sum of the index vectors of all neighbours its tokens have, two to either side,
over the whole texts of all documents. Tasks add up their share and ship one row per bucket.

A document is described by the mean vector over its tokens, the mean over its distinct tokens, its
length, how many of its tokens are distinct and the length of the mean vector. A two-layer numpy
network learns labels from a bounded sample; a temperature fitted on rows kept apart calibrates it.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.llm.common import id_remainder, labelled_sample
from kerbside.llm.tokens import Words, blocks, encoded, kinds, words_of

BUCKETS = 8192
DIMENSIONS = 48
NONZEROS = 4
WINDOW = 2
EXTRA = 3

_ALNUM = b"0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ" + bytes(range(128, 256))
_SIGNS = bytes(c for c in range(33, 127) if c not in _ALNUM)
_TABLE = kinds(_ALNUM, _SIGNS)


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the non-zeros of each bucket's index vector; the same on every machine."""
    rng = np.random.default_rng(20240)
    places = rng.permuted(np.tile(np.arange(DIMENSIONS), (BUCKETS, 1)), axis=1)[:, :NONZEROS]
    return places, rng.choice([-1.0, 1.0], size=(BUCKETS, NONZEROS))


def _buckets(words: Words) -> np.ndarray:
    return (words.hash >> np.uint64(64 - 13)).astype(np.int64)


def word_vectors(documents: DataFrame) -> np.ndarray:
    """BUCKETS x DIMENSIONS unit vectors over the whole texts of all documents; the driver gets BUCKETS rows at most."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        places, signs = index_vectors()
        total = np.zeros(BUCKETS * DIMENSIONS)
        for batch in batches:
            for texts in blocks([encoded(t) for t in batch["text"]]):
                words = words_of(texts, _TABLE)
                b = _buckets(words)
                for step in range(1, WINDOW + 1):
                    same = words.owner[step:] == words.owner[:-step]
                    left, right = b[:-step][same], b[step:][same]
                    for target, context in ((left, right), (right, left)):
                        cell = target[:, None] * DIMENSIONS + places[context]
                        total += np.bincount(cell.ravel(), signs[context].ravel(), BUCKETS * DIMENSIONS)
        rows = total.reshape(BUCKETS, DIMENSIONS)
        seen = np.flatnonzero(np.abs(rows).sum(1))
        yield pd.DataFrame({"bucket": seen} | {f"d{i}": rows[seen, i] for i in range(DIMENSIONS)})

    columns = [f"d{i}" for i in range(DIMENSIONS)]
    summed = (
        documents.select("text")
        .mapInPandas(run, "bucket bigint, " + ", ".join(f"{c} double" for c in columns))
        .groupBy("bucket")
        .agg(*[F.sum(c).alias(c) for c in columns])
    )
    out = np.zeros((BUCKETS, DIMENSIONS))
    for r in summed.collect():  # one row per bucket
        out[r[0]] = r[1:]
    size = np.linalg.norm(out, axis=1, keepdims=True)
    return (out / np.where(size > 0, size, 1)).astype(np.float32)


def document_features(texts: list[str | None], vectors: np.ndarray) -> np.ndarray:
    """One row per text: pooled vectors and the three figures; zeros for texts without tokens."""
    parts = []
    for block in blocks([encoded(t) for t in texts]):
        words = words_of(block, _TABLE)
        n, out = words.n_texts, np.zeros((words.n_texts, 2 * DIMENSIONS + EXTRA))
        counts = np.bincount(words.owner, minlength=n).astype(float)
        if len(words.start):
            b = _buckets(words)
            has = np.flatnonzero(counts)
            cut = np.searchsorted(words.owner, has)
            out[has, :DIMENSIONS] = np.add.reduceat(vectors[b], cut, axis=0) / counts[has, None]
            key = np.unique((words.owner.astype(np.uint64) << np.uint64(40)) | (words.hash >> np.uint64(24)))
            owner = (key >> np.uint64(40)).astype(np.int64)
            distinct = np.bincount(owner, minlength=n).astype(float)
            once = ((key & np.uint64((1 << 40) - 1)) >> np.uint64(40 - 13)).astype(np.int64)
            out[has, DIMENSIONS : 2 * DIMENSIONS] = (
                np.add.reduceat(vectors[once], np.searchsorted(owner, has), axis=0) / distinct[has, None]
            )
            out[:, -3] = np.log1p(counts)
            out[has, -2] = distinct[has] / counts[has]
            out[:, -1] = np.linalg.norm(out[:, :DIMENSIONS], axis=1)
        parts.append(out)
    return np.concatenate(parts) if parts else np.zeros((0, 2 * DIMENSIONS + EXTRA))


@dataclass
class QualityNet:
    """Two layers: tanh units, then one logit, divided by the temperature."""

    center: np.ndarray
    spread: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        x = np.clip((x - self.center) / self.spread, -8, 8)
        return np.tanh(x @ self.w1 + self.b1) @ self.w2 + self.b2

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -30, 30)))


def fit_net(x: np.ndarray, y: np.ndarray, hidden: int = 32, epochs: int = 60, seed: int = 7) -> QualityNet:
    """Adam on log loss over four fifths of the rows; the temperature minimises log loss on the rest."""
    n, d = x.shape
    rng = np.random.default_rng(seed)
    net = QualityNet(
        x.mean(0) if n else np.zeros(d),
        (x.std(0) if n else np.ones(d)) + 1e-6,
        rng.normal(0, 1 / math.sqrt(d), (d, hidden)),
        np.zeros(hidden),
        rng.normal(0, 1 / math.sqrt(hidden), hidden),
        0.0,
    )
    if not n:
        net.w2[:] = 0
        return net
    apart = np.arange(n) % 5 == 4
    fit = np.flatnonzero(~apart)
    xs = np.clip((x - net.center) / net.spread, -8, 8)
    state = {k: [np.zeros_like(v), np.zeros_like(v)] for k in ("w1", "b1", "w2") for v in [getattr(net, k)]} | {"b2": [0.0, 0.0]}
    t = 0
    for _ in range(epochs):
        order = rng.permutation(fit)
        for at in range(0, len(order), 128):
            rows = order[at : at + 128]
            h = np.tanh(xs[rows] @ net.w1 + net.b1)
            p = 1 / (1 + np.exp(-np.clip(h @ net.w2 + net.b2, -30, 30)))
            g = (p - y[rows]) / len(rows)
            back = np.outer(g, net.w2) * (1 - h * h)
            t += 1
            slopes = {"w1": xs[rows].T @ back + 1e-4 * net.w1, "b1": back.sum(0), "w2": h.T @ g + 1e-4 * net.w2, "b2": g.sum()}
            for k, slope in slopes.items():
                m, v = state[k]
                state[k] = [m := 0.9 * m + 0.1 * slope, v := 0.999 * v + 0.001 * slope * slope]
                setattr(net, k, getattr(net, k) - 0.003 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8))
    held = np.flatnonzero(apart) if apart.any() else fit
    z, goal = net.logits(x[held]), y[held]

    def loss(temperature: float) -> float:
        s = np.clip(z / temperature, -30, 30)
        return float(np.mean(np.logaddexp(0, s) - goal * s))

    net.temperature = min(np.exp(np.linspace(math.log(0.25), math.log(8), 71)).tolist(), key=loss)
    return net


@dataclass
class QualityModel:
    vectors: np.ndarray
    net: QualityNet


def fit_quality(documents: DataFrame, labels: DataFrame, learnable: Column, sample_rows: int = 12_000) -> QualityModel:
    """Word vectors over all documents; the network from about ``sample_rows`` labelled rows at most.

    The driver gets one pooled vector per sampled row. Without labels every score is one half.
    """
    vectors = word_vectors(documents)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = document_features(list(batch["text"]), vectors)
            yield pd.DataFrame({"doc_id": batch["doc_id"], "target": batch["target"], "x": list(x)})

    sample = labelled_sample(documents, labels, "quality", learnable, sample_rows)
    kind = sample.schema["doc_id"].dataType.simpleString()
    rows = sample.select("doc_id", "target", "text").mapInPandas(run, f"doc_id {kind}, target int, x array<double>")
    found = sorted(rows.collect(), key=lambda r: (r.doc_id, r.x))  # sample_rows pooled vectors
    x = np.array([r.x for r in found]).reshape(len(found), 2 * DIMENSIONS + EXTRA)
    return QualityModel(vectors, fit_net(x, np.array([r.target for r in found], dtype=float)))


def quality_score(model: QualityModel, text: Column) -> Column:
    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(model.net.probability(document_features(list(batch), model.vectors)), dtype="float64")

    return score(text)


def score_quality(documents: DataFrame, labels: DataFrame, learnable: Column | None = None, threshold: float = 0.3, **fit) -> DataFrame:
    """(doc_id, score, predicted) of every row; NULL and empty texts get the score of a text without tokens.

    Repeated rows are scored one by one; NULL ids are scored and never learned from.
    """
    model = fit_quality(documents, labels, F.lit(True) if learnable is None else learnable, **fit)
    scored = documents.select("doc_id", quality_score(model, F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def drop_low_quality(documents: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """``documents`` without the rows scored below ``threshold``; columns unchanged."""
    model = fit_quality(documents, labels, id_remainder(F.col("doc_id"), 5) != 0)
    return documents.where(quality_score(model, F.col("text")) >= threshold)
