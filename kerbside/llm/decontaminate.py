"""Benchmark decontamination by winnowed fingerprints.

Every text gives the smallest hash of each run of WINNOW consecutive k-grams of words, with
k + WINNOW - 1 = WINDOW: two texts that share WINDOW words in a row share at least one fingerprint,
wherever the span lies. Items shorter than a window are one window each and are their own fingerprint.

1. Fingerprints of the benchmark, each with the words around it. A Bloom filter of fixed size over
   their hashes goes to the tasks, however large the benchmark is.
2. One pass over the documents: words are counted and fingerprints taken; the Bloom filter drops
   those no item has. A document with any left keeps its text beside them.
3. Fingerprints meet in an equi-join on the hash; hits of a document come together and are extended
   word by word to both sides. Only runs of equal words as long as a window count, so neither hash
   collisions nor false positives of the filter change the result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.llm.common import ROW, choose_rows, with_row_key
from kerbside.llm.tokens import blocks, encoded, kinds, mix, words_of
from kerbside.session import stage

WINDOW = 10
GRAM = 5
WINNOW = WINDOW - GRAM + 1
_WORD_BYTES = b"0123456789abcdefghijklmnopqrstuvwxyz" + bytes(range(128, 256))
_TABLE = kinds(_WORD_BYTES)
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
#: 64-bit words of the Bloom filter: 4 MB, whatever the size of the benchmark.
BLOOM_WORDS = 1 << 19
_STEP = np.uint64(0xD6E8FEB86659FD93)


def contract_words(text: str | None) -> list[bytes]:
    """Lower-cased runs of ASCII letters, digits and non-ASCII characters, as UTF-8."""
    return _WORD.findall(encoded(text).lower())


def _gram_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k-gram that begins at each place (k - 1 fewer than words)."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = np.zeros(n, dtype=np.uint64)
    for j in range(k):
        out = out * _STEP + h[j : j + n]
    return mix(out + np.uint64(k))


def fingerprint_places(h: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the winnowed k-grams: the last smallest one of every window within one text."""
    if len(h) < WINDOW:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
    grams = _gram_hashes(h, GRAM)
    whole = owner[WINDOW - 1 :] == owner[: len(h) - WINDOW + 1]
    best = np.arange(len(whole))
    least = grams[: len(whole)].copy()
    for j in range(1, WINNOW):
        other = grams[j : j + len(whole)]
        better = other <= least
        best[better] = np.flatnonzero(better) + j
        least[better] = other[better]
    places = np.unique(best[whole])
    return places, grams[places]


def _bloom_bits(hashes: np.ndarray) -> list[np.ndarray]:
    """Two bit numbers per hash."""
    size = np.uint64(BLOOM_WORDS * 64)
    return [hashes % size, mix(hashes) % size]


def item_fingerprints(items: DataFrame) -> DataFrame:
    """(item_id, hash, length, need, back, around): per fingerprint of an item, the size of its gram, the
    words a run needs, how many words stand before the gram in ``around``, and the words around it."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for item, text in zip(batch["item_id"], batch["text"], strict=True):
                words = words_of([encoded(text).lower()], _TABLE)
                n = len(words.start)
                if n == 0:
                    continue
                own = [words.block[s:e] for s, e in zip(words.start, words.end, strict=True)]
                if n < WINDOW:
                    rows.append((item, int(_gram_hashes(words.hash, n).view(np.int64)[0]), n, n, 0, b" ".join(own)))
                    continue
                places, hashes = fingerprint_places(words.hash, words.owner)
                for p, h in zip(places.tolist(), hashes.view(np.int64).tolist(), strict=True):
                    first = max(0, p - (WINDOW - GRAM))
                    rows.append((item, h, GRAM, WINDOW, p - first, b" ".join(own[first : p + WINDOW])))
            yield pd.DataFrame(rows, columns=["item_id", "hash", "length", "need", "back", "around"])

    kind = items.schema["item_id"].dataType.simpleString()
    schema = f"item_id {kind}, hash bigint, length int, need int, back int, around binary"
    return items.select("item_id", "text").mapInPandas(run, schema)


def _bloom(prints: DataFrame) -> np.ndarray:
    """Bit array over the hashes, put together by the executors: BLOOM_WORDS rows at most reach the driver."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            bits = np.unique(np.concatenate(_bloom_bits(batch["hash"].to_numpy(np.int64).view(np.uint64))))
            yield pd.DataFrame(
                {
                    "word": (bits >> np.uint64(6)).astype(np.int64),
                    "bit": (np.uint64(1) << (bits & np.uint64(63))).view(np.int64),
                }
            )

    out = np.zeros(BLOOM_WORDS, dtype=np.uint64)
    rows = prints.select("hash").mapInPandas(run, "word bigint, bit bigint").groupBy("word").agg(F.bit_or("bit").alias("bits"))
    for r in rows.toLocalIterator():
        out[r.word] = np.int64(r.bits).view(np.uint64)
    return out


def _document_pass(documents: DataFrame, bloom: np.ndarray, short_lengths: list[int]) -> DataFrame:
    """(part, row, doc_id, n_words, length, pos, hash, text): one row per document; arrays of the
    fingerprints the filter lets through, and the text if there are any. (part, row) names the row."""
    from pyspark import TaskContext

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, row = TaskContext.get().partitionId(), 0
        for batch in batches:
            texts = list(batch["text"])
            n_words, found = [], []
            for block in blocks([encoded(t).lower() for t in texts]):
                words = words_of(block, _TABLE)
                firsts = np.searchsorted(words.owner, np.arange(words.n_texts + 1))
                n_words += np.diff(firsts).tolist()
                sets = [(GRAM, *fingerprint_places(words.hash, words.owner))]
                for k in short_lengths:
                    grams = _gram_hashes(words.hash, k)
                    whole = np.flatnonzero(words.owner[k - 1 :] == words.owner[: len(grams)])
                    sets.append((k, whole, grams[whole]))
                own: list[list] = [[[], [], []] for _ in range(words.n_texts)]
                for k, places, hashes in sets:
                    known = np.ones(len(hashes), dtype=bool)
                    for bits in _bloom_bits(hashes):
                        known &= (bloom[bits >> np.uint64(6)] >> (bits & np.uint64(63))) & np.uint64(1) == 1
                    for p, h in zip(places[known].tolist(), hashes[known].view(np.int64).tolist(), strict=True):
                        t = int(words.owner[p])
                        own[t][0].append(k)
                        own[t][1].append(p - int(firsts[t]))
                        own[t][2].append(h)
                found += own
            yield pd.DataFrame(
                {
                    "part": part,
                    "row": np.arange(row, row + len(texts)),
                    "doc_id": batch["doc_id"],
                    "n_words": n_words,
                    "length": [f[0] for f in found],
                    "pos": [f[1] for f in found],
                    "hash": [f[2] for f in found],
                    "text": [t if f[0] else None for t, f in zip(texts, found, strict=True)],
                }
            )
            row += len(texts)

    kind = documents.schema["doc_id"].dataType.simpleString()
    schema = f"part int, row bigint, doc_id {kind}, n_words bigint, length array<int>, pos array<int>, hash array<bigint>, text string"
    return documents.select("doc_id", "text").mapInPandas(run, schema)


def _extended(words: list[bytes], hits: list) -> tuple[np.ndarray, set]:
    """Which words lie inside an occurrence of a window, and the items with any."""
    hit = np.zeros(len(words), dtype=bool)
    items = set()
    for h in hits:
        around = h["around"].split(b" ")
        shift = h["pos"] - h["back"]  # place in the document of around[0]
        first = h["back"]
        if any(not 0 <= shift + j < len(words) or words[shift + j] != around[j] for j in range(first, first + h["length"])):
            continue
        last = first + h["length"]
        while first > 0 and shift + first > 0 and words[shift + first - 1] == around[first - 1]:
            first -= 1
        while last < len(around) and shift + last < len(words) and words[shift + last] == around[last]:
            last += 1
        if last - first >= h["need"]:
            hit[shift + first : shift + last] = True
            items.add(h["item_id"])
    return hit, items


def contamination(documents: DataFrame, items: DataFrame) -> DataFrame:
    """One row per row of ``documents``: doc_id, n_words, n_hit, n_items, item_ids (sorted as strings).

    A word is hit if it lies inside an occurrence of a window of an item: WINDOW words in a row of an
    item, or all words of a shorter one. NULL texts have no words; items without words or with a NULL id
    fit nothing; the same words under two ids count for both; repeated documents give repeated rows;
    an empty benchmark leaves every document clean.
    """
    prints = stage(item_fingerprints(items.where(F.col("item_id").isNotNull())), "item_fingerprints")
    short = [r.length for r in prints.where(F.col("need") < WINDOW).select("length").distinct().collect()]  # below WINDOW
    passed = stage(_document_pass(documents, _bloom(prints), sorted(short)), "document_fingerprints")
    some = passed.where(F.col("text").isNotNull())
    places = some.select("part", "row", F.explode(F.arrays_zip("length", "pos", "hash")).alias("f")).select(
        "part", "row", F.col("f.length").alias("length"), F.col("f.pos").alias("pos"), F.col("f.hash").alias("hash")
    )
    hits = (
        places.join(prints, ["hash", "length"])
        .groupBy("part", "row")
        .agg(F.collect_list(F.struct("pos", "item_id", "length", "need", "back", "around")).alias("hits"))
    )

    def extend(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for part, row, text, hits in zip(batch["part"], batch["row"], batch["text"], batch["hits"], strict=True):
                hit, items = _extended(contract_words(text), hits)
                rows.append((part, row, int(hit.sum()), sorted(map(str, items))))
            yield pd.DataFrame(rows, columns=["part", "row", "n_hit", "item_ids"])

    extended = (
        some.select("part", "row", "text")
        .join(hits, ["part", "row"])
        .mapInPandas(extend, "part int, row bigint, n_hit bigint, item_ids array<string>")
        .where("n_hit > 0")
    )
    return passed.select("part", "row", "doc_id", "n_words").join(extended, ["part", "row"], "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce(F.size("item_ids"), F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
    )


def drop_contaminated(documents: DataFrame, items: DataFrame) -> DataFrame:
    """``documents`` without those that hold a window of any item; columns unchanged.

    Every row is judged by its own text: rows with a NULL or repeated doc_id go one by one.
    """
    rows = with_row_key(documents)
    found = contamination(rows.select(F.col(ROW).alias("doc_id"), "text"), items).where("n_hit > 0")
    found = stage(found.select(F.col("doc_id").alias(ROW)), "contaminated")
    return choose_rows(rows, found, keep=False).select(*documents.columns)
