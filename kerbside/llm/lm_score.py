"""Masked pseudo-likelihood: a bidirectional window network predicts every token from both sides.

Tokens are words and runs of signs. The most frequent ones are classes of their own, the more the more
different tokens the corpus has; every other token belongs to one of the tail classes, by its last two bytes, in
which its share is its count over the class's count. Counts come from the whole texts of all documents. Shares of
the SHIPPED most frequent tail tokens go to the tasks, those of all others meet the documents in a join.

The network: embeddings of the two tokens to the left and the two to the right, one per place, are
summed, pass a tanh layer and a softmax over classes. It starts from a fit on a bounded sample; then every
task goes on from there over its own documents, and the weights are averaged by tokens seen (local
gradient steps with one averaging round), so all tokens of all documents take part. A document's score
is the sum of log p(token | both sides) over its tokens.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.llm.common import ROW, bounded_draw
from kerbside.llm.tokens import Words, blocks, encoded, kinds, words_of
from kerbside.session import stage

HEAD = 192  # classes of single tokens, before those a corpus adds by its number of different tokens
TAIL = 62  # classes of all other tokens
EDGE = HEAD + TAIL  # what stands beyond the ends of a text
CLASSES = HEAD + TAIL  # predicted
SIDE = 2
UNITS = 24

_ALNUM = b"0123456789abcdefghijklmnopqrstuvwxyz" + bytes(range(128, 256))
_SIGNS = bytes(c for c in range(33, 127) if c not in _ALNUM)
_TABLE = kinds(_ALNUM, _SIGNS)
#: Distinct tokens a task counts before it hands them on.
FLUSH = 400_000
#: Tail tokens whose shares the tasks get in advance; only saves rows of the join, which knows all others.
SHIPPED = 1 << 16


def head_size(types: int) -> int:
    """Classes of single tokens for a corpus of so many different tokens."""
    return HEAD + round(types ** (1 / 3))


@dataclass
class Vocabulary:
    """Classes of frequent tokens by hash (sorted), the size of each tail class, and shares of tail tokens by hash (sorted)."""

    hashes: np.ndarray
    classes: np.ndarray
    tail_tokens: np.ndarray  # all occurrences in each tail class
    tail_types: np.ndarray  # distinct tokens in each tail class
    head: int = HEAD
    shipped: np.ndarray = field(default_factory=lambda: np.zeros(0, dtype=np.uint64))
    shipped_gain: np.ndarray = field(default_factory=lambda: np.zeros(0))

    @property
    def size(self) -> int:
        """Number of classes; the next number stands for what is beyond the ends of a text."""
        return self.head + TAIL

    def classify(self, words: Words) -> np.ndarray:
        at, known = _found(self.hashes, words.hash)
        out = self.head + tail_classes(words)
        out[known] = self.classes[at[known]]
        return out

    def within(self, classes: np.ndarray) -> np.ndarray:
        """log p(token | class) without ``gain``: 0 for classes of one token, an even share of the class's types for the others."""
        share = np.zeros(self.size + 1)
        share[self.head : self.head + TAIL] = -np.log(np.maximum(self.tail_types, 1))
        return share[classes]

    def even_count(self) -> np.ndarray:
        """Of each tail class, the count of a token that has just an even share; its gain is 0."""
        return np.maximum(self.tail_tokens, 1) / np.maximum(self.tail_types, 1)

    def gain(self, words: Words, classes: np.ndarray) -> np.ndarray:
        """log of the token's count over the even count: 0 in classes of one token, NaN for what is not shipped."""
        out = np.zeros(len(classes))
        tail = np.flatnonzero(classes >= self.head)
        at, known = _found(self.shipped, words.hash[tail])
        out[tail] = np.nan
        out[tail[known]] = self.shipped_gain[at[known]]
        return out


def _found(hashes: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in sorted ``hashes`` and whether the wanted hash stands there."""
    if not len(hashes):
        return np.zeros(len(wanted), dtype=np.int64), np.zeros(len(wanted), dtype=bool)
    at = np.minimum(np.searchsorted(hashes, wanted), len(hashes) - 1)
    return at, hashes[at] == wanted


def tail_classes(words: Words) -> np.ndarray:
    """Tail class by the last two bytes of a token."""
    a = np.frombuffer(words.block, dtype=np.uint8).astype(np.int64)
    last = a[words.end - 1]
    before = np.where(words.end - words.start > 1, a[words.end - 2], 0)
    return (last * 131 + before * 7) % TAIL


def token_counts(documents: DataFrame) -> DataFrame:
    """(hash, tail, n): every distinct token of all documents and its count."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept: list[np.ndarray] = []
        size = 0

        def added() -> pd.DataFrame:
            rows = np.concatenate(kept)
            order = np.argsort(rows["h"], kind="stable")
            rows = rows[order]
            first = np.flatnonzero(np.append(True, rows["h"][1:] != rows["h"][:-1]))
            return pd.DataFrame(
                {"hash": rows["h"][first].view(np.int64), "tail": rows["t"][first], "n": np.add.reduceat(rows["n"], first)}
            )

        for batch in batches:
            for block in blocks([encoded(t).lower() for t in batch["text"]]):
                words = words_of(block, _TABLE)
                if not len(words.start):
                    continue
                h, first, n = np.unique(words.hash, return_index=True, return_counts=True)
                rows = np.zeros(len(h), dtype=[("h", np.uint64), ("t", np.int64), ("n", np.int64)])
                rows["h"], rows["t"], rows["n"] = h, tail_classes(words)[first], n
                kept.append(rows)
                size += len(h)
                if size > FLUSH:
                    yield added()
                    kept, size = [], 0
        if kept:
            yield added()

    return (
        documents.select("text")
        .mapInPandas(run, "hash bigint, tail bigint, n bigint")
        .groupBy("hash", "tail")
        .agg(F.sum("n").alias("n"))
    )


def fit_vocabulary(counts: DataFrame) -> Vocabulary:
    """From all (hash, tail, n). The driver gets the most frequent tokens, SHIPPED beside the head, and TAIL sums."""
    tail_tokens, tail_types = np.zeros(TAIL), np.zeros(TAIL)
    for r in counts.groupBy("tail").agg(F.sum("n").alias("n"), F.count("*").alias("types")).collect():  # TAIL rows
        tail_tokens[r.tail], tail_types[r.tail] = r.n, r.types
    size = head_size(int(tail_types.sum()))
    top = counts.orderBy(F.desc("n"), "hash").limit(size + SHIPPED).toPandas()
    head, rest = top[:size], top[size:]
    np.subtract.at(tail_tokens, head["tail"].to_numpy(np.int64), head["n"].to_numpy(np.int64))
    np.subtract.at(tail_types, head["tail"].to_numpy(np.int64), 1)
    hashes, shipped = (x["hash"].to_numpy(np.int64).view(np.uint64) for x in (head, rest))
    order, behind = np.argsort(hashes), np.argsort(shipped)
    out = Vocabulary(hashes[order], np.arange(len(head))[order], tail_tokens, tail_types, size, shipped[behind])
    out.shipped_gain = np.log(rest["n"].to_numpy(float) / out.even_count()[rest["tail"].to_numpy(np.int64)])[behind]
    return out


def group_width(classes: int) -> int:
    """Classes of a group, so that there are about as many groups as classes in one."""
    return int(np.ceil(np.sqrt(classes)))


@dataclass
class WindowNet:
    """p(class | window) = p(group | window) p(class | group, window), both softmaxes over the same hidden units.

    Classes of consecutive numbers form a group, so a token costs two short softmaxes in place of one over
    all classes, and the probabilities of all classes still add up to one.
    """

    places: np.ndarray  # (2 * SIDE, classes + 1, UNITS) embeddings per place
    groups: np.ndarray  # (UNITS, groups)
    group_bias: np.ndarray  # (groups,)
    out: np.ndarray  # (UNITS, classes)
    bias: np.ndarray  # (classes,)

    @staticmethod
    def shapes(classes: int) -> list[tuple[int, ...]]:
        groups = -(-classes // group_width(classes))
        return [(2 * SIDE, classes + 1, UNITS), (UNITS, groups), (groups,), (UNITS, classes), (classes,)]

    @classmethod
    def fresh(cls, seed: int = 9, classes: int = CLASSES) -> WindowNet:
        rng = np.random.default_rng(seed)
        spread = (0.3, 0.2, 0.0, 0.2, 0.0)
        return cls(*[rng.normal(0, s, shape).astype(np.float32) for s, shape in zip(spread, cls.shapes(classes), strict=True)])

    def parts(self) -> list[np.ndarray]:
        return [self.places, self.groups, self.group_bias, self.out, self.bias]

    def flat(self) -> np.ndarray:
        return np.concatenate([x.ravel() for x in self.parts()])

    @classmethod
    def of(cls, flat: np.ndarray, classes: int) -> WindowNet:
        shapes = cls.shapes(classes)
        ends = np.cumsum([int(np.prod(x)) for x in shapes])
        parts = np.split(flat.astype(np.float32)[: ends[-1]], ends[:-1])
        return cls(*[x.reshape(shape).copy() for x, shape in zip(parts, shapes, strict=True)])

    def hidden(self, context: np.ndarray) -> np.ndarray:
        total = self.places[0][context[:, 0]]
        for k in range(1, 2 * SIDE):
            total += self.places[k][context[:, k]]
        return np.tanh(total, out=total)

    def by_group(self, target: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[tuple[int, int, int, int]]]:
        """The group of each target, the rows in order of groups, and (first row, end, first class, end) of each."""
        width = group_width(len(self.bias))
        group = (target // width).astype(np.uint16)
        order = np.argsort(group, kind="stable")
        sizes = np.bincount(group, minlength=len(self.group_bias))
        ends = np.cumsum(sizes)
        spans = [
            (int(ends[g] - sizes[g]), int(ends[g]), int(g) * width, min((int(g) + 1) * width, len(self.bias)))
            for g in np.flatnonzero(sizes)
        ]
        return group, order, spans

    def log_probabilities(self, context: np.ndarray, target: np.ndarray) -> np.ndarray:
        h = self.hidden(context)
        group, order, spans = self.by_group(target)
        out = _log_softmax_at(h @ self.groups + self.group_bias, group)
        h, wanted = h[order], target[order]
        within = np.empty(len(target), dtype=out.dtype)
        for first, end, low, high in spans:
            within[first:end] = _log_softmax_at(h[first:end] @ self.out[:, low:high] + self.bias[low:high], wanted[first:end] - low)
        out[order] += within
        return out

    def learn(self, context: np.ndarray, target: np.ndarray, rate: float, batch: int = 256) -> None:
        """Plain gradient steps over the rows, in the order given."""
        embeddings = self.places.reshape(-1, UNITS)
        starts = np.arange(2 * SIDE) * self.places.shape[1]
        small = np.uint16 if len(embeddings) < 1 << 16 else np.int64  # the short type is sorted by counting
        for at in range(0, len(target), batch):
            group, order, spans = self.by_group(target[at : at + batch])
            c, y = context[at : at + batch][order], target[at : at + batch][order]
            n = len(y)
            step = np.float32(rate / n)
            h = self.hidden(c)
            p = _softmax(h @ self.groups + self.group_bias)
            p[np.arange(n), group[order]] -= 1
            back = p @ self.groups.T
            self.groups -= step * (h.T @ p)
            self.group_bias -= step * p.sum(0)
            for first, end, low, high in spans:
                some, weights = h[first:end], self.out[:, low:high]
                p = _softmax(some @ weights + self.bias[low:high])
                p[np.arange(end - first), y[first:end] - low] -= 1
                back[first:end] += p @ weights.T
                weights -= step * (some.T @ p)
                self.bias[low:high] -= step * p.sum(0)
            back *= 1 - h * h
            back *= step
            places = (c + starts).ravel().astype(small)
            by_place = np.argsort(places, kind="stable")  # sums per place and class
            own = places[by_place]
            first_of = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
            embeddings[own[first_of]] -= np.add.reduceat(back[by_place // (2 * SIDE)], first_of)


def _softmax(z: np.ndarray) -> np.ndarray:
    z -= z.max(1, keepdims=True)
    np.exp(z, out=z)
    z /= z.sum(1, keepdims=True)
    return z


def _log_softmax_at(z: np.ndarray, at: np.ndarray) -> np.ndarray:
    z -= z.max(1, keepdims=True)
    own = z[np.arange(len(z)), at]
    return own - np.log(np.exp(z, out=z).sum(1))


def contexts(texts: list[bytes], vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of every token of some texts: classes around it (left to right), its own class, its text."""
    return _contexts(words_of(texts, _TABLE), vocabulary)


def _contexts(words: Words, vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    classes = vocabulary.classify(words)
    around = np.full((len(classes), 2 * SIDE), vocabulary.size)
    for d in range(1, SIDE + 1):
        same = words.owner[d:] == words.owner[:-d]
        np.copyto(around[d:, SIDE - d], classes[:-d], where=same)
        np.copyto(around[:-d, SIDE + d - 1], classes[d:], where=same)
    return around, classes, words.owner


def fit_network(documents: DataFrame, vocabulary: Vocabulary, sample_rows: int = 1500, stride: int = 1) -> WindowNet:
    """Start: about ``sample_rows`` documents. Then one round over all documents: of each, every
    ``stride``-th token from an offset given by its length is a target (all are context), by default all."""

    def train(net: WindowNet, texts: list[bytes], every: int, rate: float, batch: int) -> int:
        seen = 0
        for block in blocks(texts):
            around, target, owner = contexts(block, vocabulary)
            rows = np.flatnonzero((np.arange(len(target)) + np.array([len(t) for t in block])[owner]) % every == 0) if len(target) else []
            if len(rows):
                net.learn(around[rows], target[rows], rate, batch)
                seen += len(rows)
        return seen

    drawn = bounded_draw(documents, sample_rows).select("doc_id", "text")

    def task(start: np.ndarray, every: int, rounds: tuple[float, ...], rows: int):
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            net, seen = WindowNet.of(start, vocabulary.size), 0
            for batch in batches:
                texts = [encoded(t).lower() for t in batch["text"]]
                for rate in rounds:
                    seen += train(net, texts, every, rate, rows)
            if seen:
                flat = padded(net).reshape(-1, 64).astype(float)
                yield pd.DataFrame({"piece": np.arange(len(flat)), "seen": seen} | {f"w{i}": flat[:, i] * seen for i in range(64)})

        return run

    columns = [f"w{i}" for i in range(64)]
    schema = "piece bigint, seen bigint, " + ", ".join(f"{c} double" for c in columns)

    def averaged(df: DataFrame, start: np.ndarray, every: int, rounds: tuple[float, ...], rows: int) -> np.ndarray:
        summed = df.select("text").mapInPandas(task(start, every, rounds, rows), schema).groupBy("piece").agg(
            F.sum("seen").alias("seen"), *[F.sum(c).alias(c) for c in columns]
        )
        out = start.copy().reshape(-1, 64)
        for r in summed.collect():  # as many rows as the network has
            out[r.piece] = np.array(r[2:]) / r.seen
        return out.ravel()

    flat = padded(WindowNet.fresh(classes=vocabulary.size))
    flat = averaged(stage(drawn.coalesce(1), "lm_sample"), flat, 1, (0.5, 0.5, 0.25), 256)
    return WindowNet.of(averaged(documents, flat, stride, (0.3,), 2048), vocabulary.size)


def padded(net: WindowNet) -> np.ndarray:
    flat = net.flat()
    return np.concatenate([flat, np.zeros(-len(flat) % 64, dtype=flat.dtype)])


def score_documents(documents: DataFrame, **fit) -> DataFrame:
    """(doc_id, n_tokens, log_likelihood, mean_log_likelihood) of every row of ``documents``.

    Texts without tokens, NULL ones included, have 0 tokens, a sum of 0 and a NULL mean. Repeated rows are
    scored one by one; only doc_id and text are read.
    """
    documents = documents.select("doc_id", "text")
    counts = stage(token_counts(documents), "token_counts")
    vocabulary = fit_vocabulary(counts)
    net = fit_network(documents, vocabulary, **fit)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            n_tokens, sums, rare = [], [], []
            for block in blocks([encoded(t).lower() for t in batch["text"]]):
                words = words_of(block, _TABLE)
                around, target, owner = _contexts(words, vocabulary)
                found = np.zeros(len(target))
                for at in range(0, len(target), 4096):
                    found[at : at + 4096] = net.log_probabilities(around[at : at + 4096], target[at : at + 4096])
                gain = vocabulary.gain(words, target)
                left = np.flatnonzero(np.isnan(gain))
                gain[left] = 0.0
                found += vocabulary.within(target) + gain
                n_tokens.append(np.bincount(owner, minlength=len(block)))
                sums.append(np.bincount(owner, found, len(block)))
                ends = np.searchsorted(owner[left], np.arange(1, len(block)))
                rare += np.split(words.hash[left].view(np.int64), ends)
            n, s = (np.concatenate(v) if v else np.zeros(0) for v in (n_tokens, sums))
            yield pd.DataFrame({"doc_id": batch["doc_id"], "n_tokens": n.astype(np.int64), "known": s, "rare": rare})

    kind = documents.schema["doc_id"].dataType.simpleString()
    passed = documents.mapInPandas(run, f"doc_id {kind}, n_tokens bigint, known double, rare array<bigint>")
    passed = stage(passed.withColumn(ROW, F.monotonically_increasing_id()), "lm_scores")
    even = F.array(*[F.lit(float(x)) for x in np.log(vocabulary.even_count())])
    gains = counts.select("hash", (F.log("n") - F.get(even, F.col("tail").cast("int"))).alias("gain"))
    added = passed.select(ROW, F.explode("rare").alias("hash")).join(gains, "hash").groupBy(ROW).agg(F.sum("gain").alias("gain"))
    scored = passed.join(added, ROW, "left").select(
        "doc_id", "n_tokens", (F.col("known") + F.coalesce("gain", F.lit(0.0))).alias("log_likelihood")
    )
    return scored.withColumn(
        "mean_log_likelihood", F.when(F.col("n_tokens") > 0, F.col("log_likelihood") / F.col("n_tokens"))
    )
