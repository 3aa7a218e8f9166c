"""SimHash near-duplicates by a grid over segment bit counts.

A 64-bit fingerprint is mapped to the bit counts of its 32 two-bit segments. The Manhattan distance
of two such vectors never exceeds the Hamming distance of the fingerprints, so vectors farther apart
than the allowed distance need no look. The 32 axes are cut into ``max_bits + 3`` bands; fingerprints
within ``max_bits`` agree in all counts of at least 3 bands, so each fingerprint is put into one grid
cell for every choice of 3 bands, and cells meet in an equi-join. Pairs of a cell pass the Manhattan
bound, then the exact bit distance.

Cells with more than ``cell_limit`` fingerprints (one text copied with small edits a million times)
are not paired. Their fingerprints are listed under themselves and all fingerprints within
``max_bits / 2`` flips; for an even distance two fingerprints are linked exactly if they share such a
midpoint, and a midpoint has at most 65 fingerprints (for 2 bits), so the work stays in proportion.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.llm.common import ROW, choose_rows, with_row_key
from kerbside.llm.components import components
from kerbside.session import stage

SEED = 42
SEGMENT_BITS = 2
SEGMENTS = 64 // SEGMENT_BITS
#: Hashes whose bits are summed at once; bounds memory for very long texts.
CHUNK = 1 << 15


def fingerprint_of(text: str | None, shingle: int = 3) -> int:
    """SimHash of the word shingles of one text, as a signed 64-bit integer; 0 without words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: ASCII letters and ASCII white space only
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, dtype=np.int64)
    for start in range(0, n, CHUNK):
        hashes = np.array(
            [digest(b" ".join(words[i : i + shingle]), SEED) for i in range(start, min(n, start + CHUNK))], dtype="<u8"
        )
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > n, bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprints(documents: DataFrame, shingle: int = 3) -> DataFrame:
    """(doc_id, fp) of every row; fp is the fingerprint as a signed long."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            fp = [fingerprint_of(t, shingle) for t in batch["text"]]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "fp": np.array(fp, dtype=np.int64)})

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", "text").mapInPandas(run, f"doc_id {kind}, fp bigint")


def _counts(fp: Column) -> Column:
    """The 32 two-bit counts, each in its own two-bit field of a long (0, 1 or 2)."""
    mask = F.lit(0x5555555555555555)
    even, odd = fp.bitwiseAND(mask), F.shiftrightunsigned(fp, 1).bitwiseAND(mask)
    return even.bitwiseXOR(odd).bitwiseOR(F.shiftleft(even.bitwiseAND(odd), 1))


def _manhattan(a: Column, b: Column) -> Column:
    """Sum of absolute differences of the count fields: for 0, 1, 2 it is read off the bits."""
    mask = F.lit(0x5555555555555555)
    x = a.bitwiseXOR(b)
    low, high = x.bitwiseAND(mask), F.shiftrightunsigned(x, 1).bitwiseAND(mask)
    # xor of fields: 01 -> 1 apart (0,1), 10 -> 2 apart (0,2), 11 -> 1 apart (1,2)
    return F.bit_count(low) + 2 * F.bit_count(high.bitwiseAND(F.bitwise_not(low)))


def _masks(max_bits: int) -> list[int]:
    """For every choice of 3 bands, the fields of these bands as a signed mask."""
    bands = np.array_split(np.arange(SEGMENTS), max_bits + 3)
    out = []
    for chosen in combinations(bands, 3):
        value = sum(3 << (2 * int(s)) for band in chosen for s in band)
        out.append(value - (1 << 64) if value >= 1 << 63 else value)
    return out


def fingerprint_links(distinct: DataFrame, max_bits: int = 2, cell_limit: int = 64) -> DataFrame:
    """(a, b): links that connect exactly the fingerprints reachable in steps of ``max_bits`` bits.

    ``distinct`` has the column fp, each value once. Not every link need be listed: inside a crowded
    cell those to the smallest fingerprint around a midpoint stand for the rest.
    """
    if max_bits % 2:
        raise ValueError("an even number of bits is needed for midpoints")
    cells = stage(
        distinct.select("fp", _counts(F.col("fp")).alias("counts")).select(
            "fp",
            "counts",
            F.posexplode(F.array(*[F.col("counts").bitwiseAND(F.lit(m)) for m in _masks(max_bits)])).alias("grid", "cell"),
        ),
        "cells",
    )
    sizes = cells.groupBy("grid", "cell").agg(F.count("*").alias("n")).where("n > 1")
    shared = stage(cells.join(sizes, ["grid", "cell"]), "shared_cells")
    few = shared.where(F.col("n") <= cell_limit).select("grid", "cell", "fp", "counts")
    left = few.select("grid", "cell", F.col("fp").alias("a"), F.col("counts").alias("ca"))
    right = few.select("grid", "cell", F.col("fp").alias("b"), F.col("counts").alias("cb"))
    paired = (
        left.join(right, ["grid", "cell"])
        .where(F.col("a") < F.col("b"))
        .where(_manhattan(F.col("ca"), F.col("cb")) <= max_bits)
        .where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits)
        .select("a", "b")
    )
    flips = [0]
    for k in range(1, max_bits // 2 + 1):
        flips += [sum(1 << i for i in c) for c in combinations(range(64), k)]
    flips = [v - (1 << 64) if v >= 1 << 63 else v for v in flips]
    around = (
        shared.where(F.col("n") > cell_limit)
        .select("fp")
        .distinct()
        .select("fp", F.explode(F.array(*[F.col("fp").bitwiseXOR(F.lit(v)) for v in flips])).alias("midpoint"))
        .groupBy("midpoint")
        .agg(F.array_sort(F.collect_list("fp")).alias("near"))
        .where(F.size("near") > 1)
    )
    crowded = around.select(F.explode(F.slice("near", 2, len(flips))).alias("a"), F.col("near")[0].alias("b")).distinct()
    return paired.unionAll(crowded)


def simhash_components(
    documents: DataFrame, shingle: int = 3, max_bits: int = 2, cell_limit: int = 64
) -> DataFrame:
    """(doc_id, fp, component_id) of every row of ``documents``.

    component_id is the smallest doc_id reachable over fingerprints at ``max_bits`` or fewer differing
    bits. NULL or word-free texts have fingerprint 0 and are linked like any other. Rows with a NULL
    doc_id keep their fingerprint and connect others, but never name a component (NULL if alone).
    Repeated rows give repeated result rows; other columns of ``documents`` are not read.
    """
    prints = stage(fingerprints(documents, shingle), "fingerprints")
    # Copies meet here: one row per fingerprint, summed up before the shuffle.
    distinct = stage(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct_fingerprints")
    links = fingerprint_links(distinct.select("fp"), max_bits, cell_limit)
    member = components(links).select(F.col("node").alias("fp"), "component")
    named = distinct.join(member, "fp", "left").select("fp", "first_id", F.coalesce("component", "fp").alias("component"))
    named = stage(named, "named_fingerprints")
    smallest = named.groupBy("component").agg(F.min("first_id").alias("component_id"))
    by_print = named.join(smallest, "component").select("fp", "component_id")
    return prints.join(by_print, "fp").select("doc_id", "fp", "component_id")


def hexadecimal(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def drop_near_copies(documents: DataFrame, shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """``documents`` with one row of each group, that of the smallest doc_id; columns unchanged.

    Every row is judged by its own text, so repeated rows are copies and another text under the same
    doc_id is not. Rows with a NULL doc_id give way to each other, not to those with one: a group keeps
    one of either kind.
    """
    rows = with_row_key(documents)
    found = simhash_components(rows.select(F.col(ROW).alias("doc_id"), "text"), shingle, max_bits)
    grouped = found.select(F.col("doc_id").alias(ROW), "component_id").join(rows.select(ROW, "doc_id"), ROW)
    kept = grouped.groupBy("component_id", F.col("doc_id").isNull().alias("unnamed")).agg(
        F.min(F.struct("doc_id", ROW))[ROW].alias(ROW)
    )
    return choose_rows(rows, stage(kept.select(ROW), "kept_rows")).select(*documents.columns)
