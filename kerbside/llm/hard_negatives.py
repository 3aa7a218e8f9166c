"""Hard-negative mining by exact search in an inverted multi-index.

Vectors become integers, floor(scale * x). Each half of a vector has a codebook; the two nearest codewords
name a row's cell. The score of an anchor with any row of a cell is at most the sum of its two half-scores
with the codewords plus each half's length times the codeword's radius, and at least the same sum with the
radii taken off. A heap over the two sorted lists of half-bounds (multi-sequence) visits cells in falling
order of their upper bound. What an anchor looks for are windows of scores: it stops once every window holds
its wanted rows and no cell left can reach them, or can only lie outside. So results are exact whatever the
codebooks, which are fitted on a bounded sample (SAMPLE rows); the radii cover all rows.

Search runs in two rounds of one distributed join: the first visits cells of about ``first_rows`` rows, the
second all further cells that the rows found leave open. Neighbouring small cells form lots of about
LOT_ROWS rows; a lot's rows are dealt over chunks and its anchors over blocks, so a hot cell is split on both
sides. Equal vectors of one label take part with their ``positives + 1`` smallest ids: no result can hold more.

Odd input: rows with a NULL id, label or vector or with a NULL or non-finite component take no part; shorter
vectors count as filled with zeros; identical rows count once, different rows of one id each for itself;
other columns are not read; an empty table gives no rows. Scores that are no 64-bit integers are an error.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kerbside.llm.common import prepare
from kerbside.session import stage

#: Rows the codebooks are fitted on, codewords of a half at most, rounds of fitting.
SAMPLE, CODEWORDS, FITS = 20_000, 256, 8
#: Rows of a cell aimed at, of a lot, of a chunk; anchors of a block.
CELL_ROWS, LOT_ROWS, CHUNK_ROWS, BLOCK_ANCHORS = 256, 2048, 4096, 1024

RESULT = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"


def _matrix(column: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    """Rows of a list column, filled with zeros up to ``dim``."""
    array = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    n, values = len(array), array.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if len(values) == n * dim:  # no row is longer than dim
        return values.reshape(n, dim)
    out, ends = np.zeros((n, dim)), np.cumsum([0, *(len(x) for x in array)])
    for i in range(n):
        out[i, : ends[i + 1] - ends[i]] = values[ends[i] : ends[i + 1]]
    return out


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of integers held as doubles."""
    largest = max((np.abs(x).max() if x.size else 0.0) for x in (a, b))
    if largest**2 * max(1, a.shape[1]) < 2.0**53:
        return (a @ b.T).astype(np.int64)
    whole = np.vectorize(int, otypes=[object])
    exact = whole(a) @ whole(b).T
    return exact.astype(np.int64)  # raises beyond 64 bits


def _nearest(x: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest codeword of each row, and a distance from it that rounding has not made too small."""
    square = (words**2).sum(axis=1)[None, :] - 2.0 * (x @ words.T)
    word = np.argmin(square, axis=1)
    return word, np.sqrt(((x - words[word]) ** 2).sum(axis=1)) * (1 + 1e-9)


def _fit(x: np.ndarray, k: int, seed: int) -> np.ndarray:
    """k-means; a codeword that loses its rows stays where it is."""
    rng = np.random.default_rng(seed)
    different = np.unique(x, axis=0)
    words = different[rng.permutation(len(different))[:k]].astype(np.float64)
    for _ in range(FITS):
        word, _ = _nearest(x, words)
        count = np.bincount(word, minlength=len(words))
        sums = np.zeros_like(words)
        np.add.at(sums, word, x)
        words = np.where(count[:, None] > 0, sums / np.maximum(count, 1)[:, None], words)
    return words


class Index(NamedTuple):
    """What an anchor needs to order the cells: bounded by CODEWORDS, whatever the table."""

    words: tuple[np.ndarray, np.ndarray]
    radii: tuple[np.ndarray, np.ndarray]
    lot: np.ndarray  # lot of each cell, -1 for an empty one
    lot_rows: list[int]

    def halves(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        cut = self.words[0].shape[1]
        return x[..., :cut], x[..., cut:]

    def bounds(self, anchor: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each half the lowest and highest half-score its codewords' rows can have."""
        out = []
        for half, words, radii in zip(self.halves(anchor), self.words, self.radii, strict=True):
            middle, reach = words @ half, np.sqrt(half @ half) * radii
            slack = 1e-6 + 1e-9 * (np.abs(middle) + reach)
            out.append((middle - reach - slack, middle + reach + slack))
        return out

    def cells(self, anchor: np.ndarray) -> Iterator[tuple[int, float, float]]:
        """(cell, lowest, highest score) in falling order of the highest: the multi-sequence heap."""
        (low1, high1), (low2, high2) = self.bounds(anchor)
        order1, order2 = np.argsort(-high1), np.argsort(-high2)
        k1, k2 = len(order1), len(order2)
        h1, h2 = high1[order1].tolist(), high2[order2].tolist()
        heap = [(-(h1[0] + h2[0]), 0, 0)]
        while heap:
            high, i, j = heapq.heappop(heap)
            # each pair is entered once: from its left neighbour, or along the first column from above
            if j + 1 < k2:
                heapq.heappush(heap, (-(h1[i] + h2[j + 1]), i, j + 1))
            if j == 0 and i + 1 < k1:
                heapq.heappush(heap, (-(h1[i + 1] + h2[0]), i + 1, 0))
            a, b = order1[i], order2[j]
            yield int(a) * k2 + int(b), low1[a] + low2[b], -high


def _visits(index: Index, anchor: np.ndarray, windows: list[dict], first_rows: int, second: bool) -> list[int]:
    """Lots the anchor looks into in one of the two rounds, in the order of the heap.

    A window has bounds ``low`` and ``high`` (None: open) and ``cut``, the score of the last of its wanted
    rows (None: not all found yet). A row as good as the cut can still displace it by a smaller id. The
    second round goes through the first one's lots again, without the cuts, to know where that ended.
    """
    most = [np.inf if w["high"] is None else w["high"] for w in windows]
    start = [-np.inf if w["low"] is None else w["low"] for w in windows]
    cut = [a if w["cut"] is None else max(a, w["cut"]) for a, w in zip(start, windows, strict=True)]
    seen: set[int] = set()
    out, passed = [], 0
    for cell, low, high in index.cells(anchor):
        first = passed < first_rows
        least = start if first else cut
        if high < min(least, default=np.inf) or not (first or second):
            break
        lot = int(index.lot[cell])
        if lot < 0 or lot in seen or not any(high >= a and low <= b for a, b in zip(least, most, strict=True)):
            continue
        seen.add(lot)
        passed += index.lot_rows[lot] if first else 0
        if first != second:
            out.append(lot)
    return out


def _score_block(same: bool, wanted: int, dim: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """The best ``wanted`` rows of a chunk for each window of each anchor of a block."""

    def score(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        out: list[tuple[int, int, int, int]] = []
        if anchors.num_rows and rows.num_rows:
            ids = rows.column("vec_id").to_numpy()
            order = np.argsort(ids, kind="stable")  # so that equal scores stay in order of ids
            ids, labels = ids[order], rows.column("label").to_numpy()[order]
            vectors, theirs = _matrix(rows.column("v"), dim)[order], _matrix(anchors.column("v"), dim)
            scores = _products(theirs, vectors)
            names = zip(*(anchors.column(c).to_pylist() for c in ("row", "anchor_id", "anchor_label", "windows")), strict=True)
            for k, (row, anchor, label, windows) in enumerate(names):
                fits = labels == label if same else labels != label
                if same:
                    for i in np.flatnonzero(ids == anchor):
                        fits[i] &= not np.array_equal(vectors[i], theirs[k])
                mine = np.flatnonzero(fits)
                mine = mine[np.argsort(-scores[k, mine], kind="stable")]
                falling = -scores[k, mine]
                for w in windows:
                    first = 0 if w["high"] is None else int(np.searchsorted(falling, -w["high"], side="left"))
                    end = len(mine) if w["low"] is None else int(np.searchsorted(falling, -w["low"], side="right"))
                    best = mine[first : min(end, first + wanted)]
                    out += zip([row] * len(best), [w["w"]] * len(best), ids[best].tolist(), scores[k, best].tolist(), strict=True)
        columns = list(zip(*out, strict=True)) if out else [[], [], [], []]
        types = (pa.int64(), pa.int32(), pa.int64(), pa.int64())
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["row", "w", "vec_id", "score"])

    return score


WINDOWS = "array<struct<w: int, low: bigint, high: bigint, cut: bigint>>"


class _Search:
    """Exact search of the windows of all anchors among the indexed rows."""

    def __init__(self, rows: DataFrame, index: Index, dim: int, vector_type: str, first_rows: int):
        self.rows, self.index, self.dim = rows, index, dim
        self.vector_type, self.first_rows = vector_type, first_rows
        spark = rows.sparkSession
        self.chunks = spark.createDataFrame(
            [(lot, -(-n // CHUNK_ROWS)) for lot, n in enumerate(index.lot_rows)], "lot int, chunks int"
        )

    def _requests(self, anchors: DataFrame, second: bool) -> DataFrame:
        index, dim, first_rows = self.index, self.dim, self.first_rows

        def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                vectors, windows = _matrix(batch.column("v"), dim), batch.column("windows").to_pylist()
                lots = [_visits(index, v, w, first_rows, second) for v, w in zip(vectors, windows, strict=True)]
                owners = pa.array([i for i, some in enumerate(lots) for _ in some], pa.int64())
                found = pa.array([lot for some in lots for lot in some], pa.int32())
                yield pa.RecordBatch.from_arrays([*batch.take(owners).columns, found], [*batch.schema.names, "lot"])

        schema = f"row bigint, anchor_id bigint, anchor_label bigint, v array<{self.vector_type}>, windows {WINDOWS}, lot int"
        return anchors.mapInArrow(visit, schema)

    def _round(self, anchors: DataFrame, same: bool, wanted: int, second: bool) -> DataFrame:
        requests = stage(self._requests(anchors, second), "requests")
        asked = requests.groupBy("lot").agg(F.ceil(F.count("*") / F.lit(BLOCK_ANCHORS)).cast("int").alias("blocks"))
        shape = self.chunks.join(asked, "lot")
        block = F.pmod(F.xxhash64("row"), F.col("blocks")).cast("int").alias("block")
        chunk = F.pmod(F.xxhash64("vec_id", "v"), F.col("chunks")).cast("int").alias("chunk")

        def each(n: str, name: str) -> Column:
            return F.explode(F.sequence(F.lit(0), F.col(n) - 1)).alias(name)

        left = requests.join(shape, "lot").select(
            F.col("lot").alias("lot"), block, each("chunks", "chunk"), "row", "anchor_id", "anchor_label", "v", "windows"
        )
        right = self.rows.join(shape, "lot").select(F.col("lot").alias("lot"), chunk, each("blocks", "block"), "vec_id", "label", "v")
        keys = ["lot", "chunk", "block"]
        return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(
            _score_block(same, wanted, self.dim), "row bigint, w int, vec_id bigint, score bigint"
        )

    def best(self, anchors: DataFrame, same: bool, wanted: int) -> DataFrame:
        """(row, w, vec_id, score, rank): the first ``wanted`` rows of each window of each anchor."""
        order = Window.partitionBy("row", "w").orderBy(F.desc("score"), F.asc("vec_id"))

        def first(found: DataFrame) -> DataFrame:
            return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= wanted)

        found = stage(first(self._round(anchors, same, wanted, False)), "found")
        cuts = found.where(F.col("rank") == wanted).groupBy("row").agg(F.map_from_entries(F.collect_list(F.struct("w", "score"))).alias("cuts"))

        def with_cut(w: Column) -> Column:
            return F.struct(w["w"].alias("w"), w["low"].alias("low"), w["high"].alias("high"), F.col("cuts")[w["w"]].alias("cut"))

        narrowed = anchors.join(cuts, "row", "left").withColumn("windows", F.transform("windows", with_cut)).drop("cuts")
        further = self._round(stage(narrowed.select(anchors.columns), "narrowed"), same, wanted, True)
        return stage(first(found.drop("rank").unionByName(further)), "best")


def _build_index(items: DataFrame, dim: int, rows: int, vector_type: str) -> tuple[DataFrame, Index]:
    """The rows with their lot, and the index."""
    spark, cut = items.sparkSession, dim // 2
    k = int(min(CODEWORDS, max(1, 2 ** round(np.log2(max(1.0, rows / CELL_ROWS)) / 2))))
    drawn = items.select("v", F.xxhash64("vec_id", "v").alias("draw"))
    share = min(1.0, 1.2 * SAMPLE / rows)
    drawn = drawn.where(F.pmod("draw", F.lit(1 << 30)) <= F.lit(int(share * (1 << 30)))).orderBy("draw").limit(SAMPLE)
    sample = _matrix(pa.array([r.v for r in drawn.select("v").collect()], pa.list_(pa.float64())), dim)
    words = (_fit(sample[:, :cut], k, 1), _fit(sample[:, cut:], k, 2))
    k2 = len(words[1])

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column("v"), dim)
            (c1, d1), (c2, d2) = _nearest(x[:, :cut], words[0]), _nearest(x[:, cut:], words[1])
            new = [pa.array(c1 * k2 + c2, pa.int32()), pa.array(d1, pa.float64()), pa.array(d2, pa.float64())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], [*batch.schema.names, "cell", "d1", "d2"])

    placed = items.mapInArrow(assign, f"vec_id bigint, label bigint, v array<{vector_type}>, cell int, d1 double, d2 double")
    placed = stage(placed, "cells")
    # at most CODEWORDS squared rows
    cells = placed.groupBy("cell").agg(F.count("*").alias("n"), F.max("d1").alias("d1"), F.max("d2").alias("d2")).collect()
    radii, lot, lot_rows = (np.zeros(len(words[0])), np.zeros(k2)), np.full(len(words[0]) * k2, -1), []
    for c in sorted(cells):
        a, b = divmod(c.cell, k2)
        radii[0][a], radii[1][b] = max(radii[0][a], c.d1), max(radii[1][b], c.d2)
        if not lot_rows or lot_rows[-1] >= LOT_ROWS or lot_rows[-1] + c.n > CHUNK_ROWS:
            lot_rows.append(0)
        lot[c.cell] = len(lot_rows) - 1
        lot_rows[-1] += c.n
    lots = spark.createDataFrame([(c.cell, int(lot[c.cell])) for c in cells], "cell int, lot int")
    return placed.join(lots, "cell").select("lot", "vec_id", "label", "v"), Index(words, radii, lot, lot_rows)


def mine_hard_negatives(
    vectors: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 3, low_percent: int = 50,
    high_percent: int = 95, scale: float = 256.0, first_rows: int = 8192,
) -> DataFrame:
    """RESULT rows: for each anchor and each of its first positives, the first negatives within the window.

    ``vectors``: vec_id, label, embedding; ``is_anchor`` is an expression over vec_id. Positives are other
    rows of the label, negatives rows of other labels whose score is between ``low_percent`` and
    ``high_percent`` of the positive's.
    """
    spark = prepare(vectors.sparkSession)
    sound = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    scaled = F.transform("embedding", lambda x: F.lit(scale) * x.cast("double"))
    usable = vectors.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & sound)
    # a double's floor as a double, however large
    whole = F.transform(scaled, lambda x: F.when(F.abs(x) < F.lit(2.0**52), F.floor(x).cast("double")).otherwise(x))
    rows = usable.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("label").cast("bigint").alias("label"), whole.alias("v"))
    rows = stage(rows.distinct(), "vectors")
    size = rows.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("dim"), F.max(F.array_max(F.transform("v", F.abs))).alias("top")).first()
    if not size.n:
        return spark.createDataFrame([], RESULT)
    vector_type = "smallint" if (size.top or 0) < 1 << 15 else "double"
    rows = rows.withColumn("v", F.col("v").cast(f"array<{vector_type}>"))

    copies = Window.partitionBy("label", "v").orderBy("vec_id")
    items = rows.withColumn("copy", F.row_number().over(copies)).where(F.col("copy") <= max(positives + 1, negatives)).drop("copy")
    indexed, index = _build_index(items, size.dim, size.n, vector_type)
    search = _Search(indexed, index, size.dim, vector_type, first_rows)

    nothing = F.lit(None).cast("bigint")
    anywhere = F.array(F.struct(F.lit(0).alias("w"), nothing.alias("low"), nothing.alias("high"), nothing.alias("cut")))
    anchors = rows.where(is_anchor).select(
        F.monotonically_increasing_id().alias("row"), F.col("vec_id").alias("anchor_id"), F.col("label").alias("anchor_label"), "v",
        anywhere.cast(WINDOWS).alias("windows"),
    )
    anchors = stage(anchors, "anchors")
    found = search.best(anchors, True, positives).select(
        "row", F.col("rank").alias("w"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")
    )
    # low_percent * p <= 100 * s <= high_percent * p, for integers s
    p = F.col("positive_score").cast("decimal(38,0)")
    low = (F.lit(-1) * F.floor(p * F.lit(-low_percent) / F.lit(100))).cast("bigint")
    high = F.floor(p * F.lit(high_percent) / F.lit(100)).cast("bigint")
    windows = found.withColumn("low", low).withColumn("high", high).where("low <= high")
    windows = windows.groupBy("row").agg(F.collect_list(F.struct("w", "low", "high", nothing.alias("cut"))).cast(WINDOWS).alias("windows"))
    seekers = stage(anchors.drop("windows").join(windows, "row").select(anchors.columns), "seekers")
    best = search.best(seekers, False, negatives)
    names = [F.col(c) for c in ("anchor_id", "positive_id", "rank")]
    return (
        best.join(found, ["row", "w"])
        .join(anchors.select("row", "anchor_id"), "row")
        .select(*names, F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
    )
