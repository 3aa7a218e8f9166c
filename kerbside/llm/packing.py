"""Best-two-fit packing of documents into token sequences of a fixed capacity.

A document is its token ids and an end id; what is longer than a sequence is cut into whole sequences
and a last piece. How many pieces have each length is all that packing needs: at most ``capacity``
counts, whatever the corpus. Best-two-fit over those counts gives a plan of bins, equal bins being one
row of it. Each piece then finds its place by its number among the pieces of its length.

Best-two-fit: a bin is filled greedily, always with the longest piece that still fits. Then its smallest
document gives way to two unpacked ones whose sum fits the expanded gap more tightly, if there are any.

Pieces are numbered within the task that made them, and a task's first number comes from a sum over
(task, length) counts, so a length that a third of all pieces share is never gathered. Ids and bytes of
texts stay in the task that reads them; only one short row a piece travels.

Odd input: a NULL or empty text is a document of the end id alone; NULL and repeated ids are documents of
their own; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from bisect import bisect_right
from collections import Counter
from collections.abc import Callable, Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from kerbside.llm.common import prepare
from kerbside.session import stage

#: Bytes of text split into words at once; half the words a Python worker remembers, about 200 bytes each.
SEGMENT, REMEMBERED = 1 << 22, 250_000
_SPACE = re.compile(rb"[ \t\n\r\x0b\x0c]")
# small letters of ASCII and Latin-1: one token before the merges, and untouched by normalisation
_LETTERS = re.compile(rb"(?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])+")
# such letters, then signs of ASCII without the apostrophe: two tokens before the merges
_LETTERS_AND_SIGNS = re.compile(rb"((?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])+)([!-&(-/:-@\[-`{-~]+)")


class WordIds:
    """Ids (little-endian unsigned 32 bit) of each white-space separated word, kept while words come again.

    For vocabularies that lower-case and split texts into words and signs, where no token spans two words.
    Words of small letters alone go straight to the tokenizer's merges, all others through the whole of it.
    ``special`` starts the tokenizer's special tokens, whose spelling counts.
    """

    def __init__(self, vocabulary: str, special: bytes = b"<|"):
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.tokenizer, self.merges = Tokenizer.from_str(vocabulary), Tokenizer.from_str(vocabulary)
        self.merges.normalizer = normalizers.Sequence([])
        self.merges.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.special, self.recent, self.older = special, {}, {}

    def text_ids(self, text: bytes) -> bytes:
        if len(text) <= SEGMENT:
            return self._segment(text)
        parts, at = [], 0
        while at < len(text):
            cut = _SPACE.search(text, at + SEGMENT)
            end = cut.start() if cut else len(text)
            parts.append(self._segment(text[at:end]))
            at = end
        return b"".join(parts)

    def _segment(self, text: bytes) -> bytes:
        if self.special not in text:
            text = text.lower()
        words = text.split()
        found = list(map(self.recent.get, words))
        try:
            return b"".join(found)
        except TypeError:  # a word is new; texts of known words are not looked through once more
            new = [i for i, ids in enumerate(found) if ids is None]
        recent = self._learn({words[i] for i in new})
        for i in new:
            found[i] = recent[words[i]]
        return b"".join(found)

    def _learn(self, words: set[bytes]) -> dict[bytes, bytes]:
        """The memory with ``words`` in it; when it is full, only what is used again outlives the next half."""
        if len(self.recent) > REMEMBERED:
            self.recent, self.older = {}, self.recent
        recent, older = self.recent, self.older
        split, plain, other = {}, set(), set()
        for word in words:
            if word in older:
                recent[word] = older[word]
            elif _LETTERS.fullmatch(word):
                plain.add(word)
            elif m := _LETTERS_AND_SIGNS.fullmatch(word):
                split[word] = letters, signs = m.groups()
                if letters not in recent:
                    plain.add(letters)
                if signs not in recent:
                    other.add(signs)
            else:
                other.add(word)
        for tokenizer, some in ((self.merges, list(plain)), (self.tokenizer, list(other))):
            encoded = tokenizer.encode_batch_fast([w.decode() for w in some], add_special_tokens=False)
            for word, e in zip(some, encoded, strict=True):
                recent[word] = struct.pack(f"<{len(e)}I", *e.ids)
        for word, (letters, signs) in split.items():
            recent[word] = recent[letters] + recent[signs]
        return recent


@lru_cache(maxsize=1)
def _word_ids(vocabulary: str) -> WordIds:
    """One memory of words for all tasks that a Python worker runs."""
    return WordIds(vocabulary)


class WholeIds:
    """Ids of whole texts, for any other vocabulary."""

    def __init__(self, vocabulary: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(vocabulary)

    def text_ids(self, text: bytes) -> bytes:
        ids = self.tokenizer.encode(text.decode(), add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)


def _pieces(
    schema: pa.Schema, encoder: Callable[[], WordIds | WholeIds], capacity: int, end_id: int
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """One row a piece, numbered by ``place`` among the pieces of its length and ``part``, the task."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        texts, end = encoder(), struct.pack("<I", end_id)
        part, seen = TaskContext.get().partitionId(), Counter()
        for batch in batches:
            rows, owners = [], []
            for owner, text in enumerate(batch.column("text").to_pylist()):
                ids = texts.text_ids(text or b"") + end
                for piece, first in enumerate(range(0, len(ids), 4 * capacity)):
                    body = ids[first : first + 4 * capacity]
                    length = len(body) // 4
                    rows.append((piece, first // 4, length, zlib.crc32(body), part, seen[length]))
                    owners.append(owner)
                    seen[length] += 1
            if rows:
                columns = [batch.column("doc_id").take(pa.array(owners)), *map(pa.array, zip(*rows, strict=True))]
                columns = [c.cast(f.type) for c, f in zip(columns, schema, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return cut


class Bins(NamedTuple):
    """``repeat`` equal bins from number ``first`` on, each with ``used``: {length: pieces}."""

    first: int
    repeat: int
    used: dict[int, int]


def _tighter_pair(lengths: np.ndarray, unpacked: np.ndarray, room: int, smallest: int) -> tuple[int, int] | None:
    """Two unpacked lengths, longer first, with the largest sum above ``smallest`` that fits ``room``."""
    can = (unpacked > 0) & (lengths < room)
    lengths, unpacked = lengths[can], unpacked[can]
    if not len(lengths):
        return None
    partner = np.searchsorted(lengths, room - lengths, side="right") - 1
    alone = (partner == np.arange(len(lengths))) & (unpacked < 2)
    partner = partner - alone
    total = np.where(partner >= 0, lengths + lengths[partner], 0)
    best = len(total) - 1 - int(np.argmax(total[::-1]))  # of equal sums the one with the longest document
    if total[best] <= smallest:
        return None
    return int(lengths[best]), int(lengths[partner[best]])


def best_two_fit(counts: dict[int, int], capacity: int) -> list[Bins]:
    """Bins for ``counts`` pieces of each length: bin after bin, equal ones taken together.

    A bin is repeated as long as every length it looked at is there in the number it needed, which is
    as long as the next bin would come out the same. At most a few bins a length are different, so the
    plan is bounded by ``capacity``.
    """
    left = {n: c for n, c in counts.items() if c > 0}
    if left and (min(left) < 1 or max(left) > capacity):
        raise ValueError("lengths must lie between 1 and the capacity")
    plan, first, alive = [], 0, sorted(left)
    while alive:
        greedy: dict[int, int] = {}
        gap, at = capacity, len(alive) - 1
        while at >= 0:
            length = alive[at]
            greedy[length] = min(gap // length, left[length])
            gap -= greedy[length] * length
            at = bisect_right(alive, min(gap, length - 1)) - 1
        used, smallest = dict(greedy), min(greedy)
        if gap and sum(greedy.values()) > 1:
            lengths = np.array(alive)
            unpacked = np.array([left[n] - greedy.get(n, 0) for n in alive])
            pair = _tighter_pair(lengths, unpacked, gap + smallest, smallest)
            if pair:
                used[smallest] -= 1
                for n in pair:
                    used[n] = used.get(n, 0) + 1
                used = {n: c for n, c in used.items() if c}
        # the next equal bin must find all that the greedy step took and all that the bin holds
        repeat = min((left[n] - max(greedy.get(n, 0), c)) // c + 1 for n, c in used.items())
        plan.append(Bins(first, repeat, used))
        first += repeat
        for n, c in used.items():
            left[n] -= repeat * c
        alive = [n for n in alive if left[n]]
    return plan


def _places(plan: list[Bins]) -> np.ndarray:
    """Rows (length, lowest number, pieces of the length in a bin, first bin, offset) by length and number."""
    rows, given = [], Counter()
    for bins in plan:
        offset = 0
        for length in sorted(bins.used, reverse=True):
            held = bins.used[length]
            rows.append((length, given[length], held, bins.first, offset))
            given[length] += bins.repeat * held
            offset += held * length
    return np.array(sorted(rows), dtype=np.int64).reshape(-1, 5)


def pack_documents(
    documents: DataFrame, vocabulary: str, capacity: int = 4096, end_id: int = 1, whole_words: bool = True
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset: where each piece of each document lies.

    ``vocabulary`` is the path of a tokenizer file on the driver; its content goes to the tasks.
    ``whole_words`` says that it lower-cases and that no token of it spans white space.
    """
    prepare(documents.sparkSession)
    with open(vocabulary, encoding="utf-8") as f:
        content = f.read()
    encoder = (lambda: _word_ids(content)) if whole_words else (lambda: WholeIds(content))
    id_type = documents.schema["doc_id"].dataType
    piece = T.StructType().add("doc_id", id_type).add("piece", "integer").add("start", "long").add("length", "long")
    piece = piece.add("ids_crc32", "long")
    schema = T.StructType(list(piece.fields)).add("part", "integer").add("place", "long")
    cut = _pieces(to_arrow_schema(schema), encoder, capacity, end_id)
    pieces = stage(documents.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(cut, schema), "pieces")

    by_task = pieces.groupBy("length", "part").agg(F.count("*").alias("n"))
    # at most one row a length: bounded by the capacity
    counts = {r.length: r.n for r in by_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    places = _places(best_two_fit(counts, capacity))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = by_task.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier"))
    numbered = pieces.join(firsts, ["length", "part"]).withColumn("number", F.col("earlier") + F.col("place"))

    out = T.StructType(list(piece.fields)).add("sequence_id", "long").add("offset", "long")
    return numbered.select("doc_id", "piece", "start", "length", "ids_crc32", "number").mapInArrow(
        _placed(places, to_arrow_schema(out)), out
    )


def _placed(places: np.ndarray, schema: pa.Schema) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Adds the sequence and offset that the plan has for each numbered piece."""
    keys = (places[:, 0] << 44) | places[:, 1]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, number = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("length", "number"))
            row = places[np.searchsorted(keys, (length << 44) | number, side="right") - 1]
            bin_, within = np.divmod(number - row[:, 1], np.maximum(row[:, 2], 1))
            new = [pa.array(row[:, 3] + bin_), pa.array(row[:, 4] + within * length)]
            columns = [*batch.columns[:5], *new]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    return place
