"""Embedding near-duplicates by iterative quantisation and multi-index Hamming tables.

Learn: on a bounded sample, unit vectors are centred, turned onto their principal axes and rotated so
that signs lose least (ITQ); each bit is cut at its median, so codes are balanced. Further rotations
from other starts give further bits. Index: the code is cut into substrings, one Hamming table each; two
vectors are candidates if a substring is equal. The number of substrings follows from a measurement on
the sample: pairs made to lie exactly at the threshold, the hardest case, must meet with the wanted
probability. Rerank: candidates are compared by cosine of the original vectors in double precision.

Buckets are cut into blocks, and a task compares one pair of blocks, so a bucket that holds a third of
all vectors is many small tasks. A pair that meets in several tables counts in the first one only, which
both codes tell; no list of pairs is shuffled: a block returns counts and one link per vector. Equal
vectors are one vector with a multiplicity before all that.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.llm.components import components
from kerbside.session import stage

#: Parts into which the rows of each bucket are dealt for the join with its size.
SALTS = 16


@dataclass
class HammingTables:
    """Codes of vectors of one length, cut into ``tables`` substrings of ``bits`` bits."""

    center: np.ndarray
    rotations: np.ndarray  # (dimensions, all bits)
    cuts: np.ndarray
    bits: int
    tables: int

    def keys(self, unit: np.ndarray) -> np.ndarray:
        """(rows, tables) substring values."""
        code = ((unit - self.center) @ self.rotations > self.cuts)[:, : self.bits * self.tables]
        weights = 1 << np.arange(self.bits, dtype=np.int64)
        return code.reshape(len(unit), self.tables, self.bits) @ weights


def _itq(projected: np.ndarray, start: np.ndarray, rounds: int = 30) -> np.ndarray:
    """The rotation that brings the projections close to their signs, from a given start."""
    rotation = start
    for _ in range(rounds):
        u, _, v = np.linalg.svd(np.sign(projected @ rotation).T @ projected)
        rotation = (u @ v).T
    return rotation


def fit_tables(sample: np.ndarray, largest: int, threshold: float, recall: float = 0.9995, bucket: int = 256) -> HammingTables:
    """Tables for vectors like ``sample`` (unit rows), of which ``largest`` are to be compared with each other.

    Substrings have about log2(largest / bucket) bits, as is usual for multi-index hashing, so buckets
    keep their size as the data grow; tables are added until pairs at the threshold meet with
    probability ``recall``.
    """
    n, d = sample.shape
    rng = np.random.default_rng(5)
    bits = int(np.clip(round(math.log2(max(largest, 1) / bucket)), 0, 24))
    center = sample.mean(0) if n else np.zeros(d)
    x = sample - center
    axes = np.linalg.eigh(x.T @ x)[1][:, ::-1] if n else np.eye(d)
    # Pairs exactly at the threshold: each sampled vector, turned by the angle in a random direction.
    probe = sample[: 4096] if n else np.eye(d)
    side = rng.normal(size=probe.shape)
    side -= (side * probe).sum(1, keepdims=True) * probe
    norms = np.linalg.norm(side, axis=1, keepdims=True)
    side = np.divide(side, norms, out=np.zeros_like(side), where=norms > 0)
    turned = threshold * probe + math.sqrt(max(0.0, 1 - threshold * threshold)) * side
    rotations, cuts = np.zeros((d, 0)), np.zeros(0)
    if not bits:  # so few that all share one bucket
        return HammingTables(center, rotations, cuts, 0, 1)
    while True:
        start = np.linalg.qr(rng.normal(size=(d, d)))[0]
        view = axes @ _itq(x @ axes, start) if n > 1 else start
        order = rng.permutation(d)
        rotations = np.hstack([rotations, view[:, order]])
        cuts = np.concatenate([cuts, (np.median(x @ view, axis=0) if n else np.zeros(d))[order]])
        tables = rotations.shape[1] // bits
        if not tables:
            continue
        model = HammingTables(center, rotations, cuts, bits, tables)
        meets = np.logical_or.accumulate(model.keys(probe) == model.keys(turned), axis=1).mean(0)
        enough = np.flatnonzero(meets >= recall)
        if len(enough) or tables >= 128:
            if not len(enough):
                raise RuntimeError(f"{tables} tables find {meets[-1]:.4f} of the pairs at the threshold; {recall} are asked for")
            model.tables = int(enough[0]) + 1
            return model


def _scaled(rows: np.ndarray) -> np.ndarray:
    """Rows times powers of two, so that squares neither vanish nor overflow and nothing else changes."""
    return np.ldexp(rows, -np.frexp(np.abs(rows).max(1))[1][:, None])


def _unit(rows: np.ndarray) -> np.ndarray:
    rows = _scaled(rows)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def _forest(n: int, a: np.ndarray, b: np.ndarray, names: np.ndarray) -> np.ndarray:
    """For each of n rows the smallest name in its component under links a-b."""
    low = names.copy()
    while True:
        before = low.copy()
        np.minimum.at(low, a, before[b])
        np.minimum.at(low, b, before[a])
        if (low == before).all():
            return low


def near_vectors(
    embeddings: DataFrame,
    threshold: float = 0.98,
    sample_rows: int = 4096,
    block_rows: int = 256,
    bucket_rows: int = 256,
) -> DataFrame:
    """(vec_id, n_links, component_id, kept): one row per vec_id, and one for each row without one.

    Vectors with equal non-NULL labels and a cosine of ``threshold`` or more are linked. Vectors that are
    NULL, empty, zero, or hold NULL or non-finite components link with nothing, nor do vectors of
    different lengths. A vec_id that is repeated counts once, with its smallest label and vector; a row
    with a NULL vec_id has no links and a NULL component. Other columns are not read. The sample for the
    rotation is ``sample_rows`` rows at most per vector length; every row is indexed. ``bucket_rows`` is
    the wanted size of a bucket, ``block_rows`` the most rows a task compares with as many others.
    """
    named = embeddings.where(F.col("vec_id").isNotNull())
    rows = named.groupBy("vec_id").agg(F.min(F.struct("label", "embedding")).alias("v")).select(
        "vec_id", "v.label", F.col("v.embedding").cast("array<double>").alias("embedding")
    )
    rows = stage(rows, "vectors")
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    usable = rows.where(
        F.col("label").isNotNull()
        & F.col("embedding").isNotNull()
        & finite
        & F.exists("embedding", lambda x: x != 0)
    )
    distinct = stage(
        usable.groupBy("label", "embedding").agg(F.min("vec_id").alias("first_id"), F.count("*").alias("copies")),
        "distinct_vectors",
    )
    per_length = (
        distinct.groupBy(F.size("embedding").alias("length"), "label")
        .count()
        .groupBy("length")
        .agg(F.max("count").alias("largest"), F.sum("count").alias("total"))
    )
    tables: dict[int, HammingTables] = {}
    for r in per_length.collect():  # one row per length of vectors
        share = min(1.0, sample_rows / r.total)
        drawn = distinct.where(F.size("embedding") == r.length).where(
            F.pmod(F.xxhash64("first_id"), F.lit(1 << 30)) < F.lit(int(share * (1 << 30)))
        )
        found = drawn.orderBy("first_id").limit(sample_rows).select("embedding").collect()
        sample = _unit(np.array([x.embedding for x in found])) if found else np.zeros((0, r.length))
        tables[r.length] = fit_tables(sample, r.largest, threshold, bucket=bucket_rows)

    kind, label_kind = (rows.schema[c].dataType.simpleString() for c in ("vec_id", "label"))

    def code(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keys: list = [None] * len(batch)
            lengths = batch["embedding"].map(len).to_numpy()
            for length in np.unique(lengths):
                at = np.flatnonzero(lengths == length)
                unit = _unit(np.stack(batch["embedding"].to_numpy()[at]).astype(float))
                for i, k in zip(at, tables[int(length)].keys(unit), strict=True):
                    keys[i] = k
            yield batch.assign(keys=keys)

    coded = stage(
        distinct.mapInPandas(
            code, f"label {label_kind}, embedding array<double>, first_id {kind}, copies bigint, keys array<bigint>"
        ),
        "vector_codes",
    )
    bucket = ["label", "length", "table", "key"]
    entries = coded.select(
        "label", F.size("embedding").alias("length"), F.posexplode("keys").alias("table", "key"), "first_id", "copies", "keys", "embedding"
    )
    sizes = entries.groupBy(*bucket).agg(F.ceil(F.count("*") / block_rows).cast("int").alias("blocks"), F.count("*").alias("n"))
    own = F.pmod(F.xxhash64("first_id", "table"), F.col("blocks")).cast("int")
    # A bucket may hold a third of all vectors: it meets its size in SALTS parts.
    salts = sizes.where("n > 1").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    paired = (
        entries.withColumn("salt", F.pmod(F.xxhash64("first_id"), F.lit(SALTS)).cast("int"))
        .join(salts, [*bucket, "salt"])
        .withColumn("block", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("low", F.least("block", "other"))
        .withColumn("high", F.greatest("block", "other"))
        .drop("n", "blocks", "other", "salt")
    )

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        table, low, high = (int(group[c].iloc[0]) for c in ("table", "low", "high"))
        x = np.stack(group["embedding"].to_numpy()).astype(float)
        keys = np.stack(group["keys"].to_numpy())
        block, names, copies = (group[c].to_numpy() for c in ("block", "first_id", "copies"))
        left, right = np.flatnonzero(block == low), np.flatnonzero(block == high)
        x = _scaled(x)
        norm = np.sqrt((x * x).sum(1))
        cosine = (x[left] @ x[right].T) / (norm[left][:, None] * norm[right][None, :])
        i, j = np.nonzero(cosine >= threshold)
        a, b = left[i], right[j]
        once = names[a] < names[b] if low == high else np.ones(len(a), dtype=bool)
        once &= ~(keys[a, :table] == keys[b, :table]).any(1)
        a, b = a[once], b[once]
        n = np.bincount(a, copies[b], len(x)) + np.bincount(b, copies[a], len(x))
        linked = np.flatnonzero(n)
        smallest = _forest(len(x), a, b, names)
        return pd.DataFrame({"first_id": names[linked], "n": n[linked].astype(np.int64), "smallest": smallest[linked]})

    counted = stage(
        paired.groupBy(*bucket, "low", "high").applyInPandas(compare, f"first_id {kind}, n bigint, smallest {kind}"), "vector_links"
    )
    n_links = counted.groupBy("first_id").agg(F.sum("n").alias("n"))
    member = components(counted.select("first_id", "smallest"), "first_id", "smallest").select(
        F.col("node").alias("first_id"), F.col("component")
    )
    result = distinct.join(n_links, "first_id", "left").join(member, "first_id", "left").select(
        "label",
        "embedding",
        (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n"),
        F.coalesce("component", "first_id").alias("component"),
    )
    # ids of the vectors behind each distinct one; the smallest of a component is its smallest first_id
    of_row = usable.join(stage(result, "vector_results"), ["label", "embedding"]).select("vec_id", "n", "component")
    unnamed = embeddings.where(F.col("vec_id").isNull()).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(False).alias("kept")
    )
    judged = rows.select("vec_id").join(of_row, "vec_id", "left").select(
        "vec_id",
        F.coalesce("n", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component", "vec_id").alias("component_id"),
        F.coalesce(F.coalesce("component", "vec_id") == F.col("vec_id"), F.lit(False)).alias("kept"),
    )
    return judged.unionByName(unnamed)
