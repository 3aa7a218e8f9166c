"""Source divergence audit: how the word use of a language's sources differs, by a minimal-perfect-hash recount.

First pass: every term's number of documents in its language, exactly; those in at least ``min_docs`` are
kept. The kept (term, language) keys are dealt by hash into shards of about SHARD_TERMS, and each shard
gets a minimal perfect hash that stores its keys. Second pass: the shards are broadcast, a term is looked up
and compared with the stored key, and its dense slot in the counts of its (language, source) group goes up.
A key longer than LONG_KEY bytes is stored as its SHA-256, so a shard is bounded by its number of terms, and
WAVE_SHARDS shards at most are broadcast at once: a vocabulary beyond that is recounted in several passes.

Shares are integers: p = 1 + floor(scale * (count + smoothing) / (N + smoothing * V)).

Odd input: NULL text, lang and source are read as empty; an empty lang or source is a group like any other;
groups without a kept term are compared with value 0; a source alone in its language has no pairs; an empty
table gives no rows; NULL or repeated ids count as rows of their own, since ids are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kerbside.llm.common import prepare
from kerbside.session import stage

#: Terms of a shard; shards in one broadcast; bytes up to which a key is stored as it is.
SHARD_TERMS, WAVE_SHARDS, LONG_KEY = 1 << 14, 128, 64
#: What a task holds before it hands it on: different terms in counters, bytes of dense slots, bytes of text read.
HELD_TERMS, HELD_BYTES, HELD_TEXT = 350_000, 1 << 26, 1 << 30
#: Slots and sources compared at once.
BLOCK_SLOTS, BLOCK_SOURCES = 256, 256
SEGMENT = 1 << 22

_FOLD = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))
_OUTSIDE = re.compile(rb"[\x00-\x40\x5b-\x60\x7b-\x7f]")
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _terms(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text in order, a long text in several lists."""
    at = 0
    while at < len(text):
        cut = _OUTSIDE.search(text, at + SEGMENT)
        end = cut.start() if cut else len(text)
        yield text[at:end].translate(_FOLD).split()
        at = end


def _key(term: bytes, lang: bytes) -> bytes:
    """One text for both: no term holds a zero byte, and no short key begins with one."""
    key = term + b"\0" + lang
    return key if len(key) <= LONG_KEY else b"\0" + hashlib.sha256(key).digest()


def _count_documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, term, n): documents of the task that hold the term."""
    held: dict[str, Counter] = defaultdict(Counter)

    def hand_on() -> Iterator[pa.RecordBatch]:
        for lang, counts in held.items():
            if counts:
                terms = pa.array(list(counts), pa.binary()).cast(pa.string())
                columns = [pa.array([lang] * len(counts), pa.string()), terms, pa.array(list(counts.values()), pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["lang", "term", "n"])
        held.clear()

    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
            found: set[bytes] = set()
            for terms in _terms(text):
                found.update(terms)
            held[lang].update(found)
        if sum(map(len, held.values())) > HELD_TERMS:
            yield from hand_on()
    yield from hand_on()


def _hashes(keys: list[bytes]) -> np.ndarray:
    """Two 64-bit hashes of each key."""
    digests = b"".join(map(xxhash.xxh3_128_digest, keys))
    return np.frombuffer(digests, dtype=">u8").astype(np.uint64).reshape(-1, 2)


def _shard_of(hashes: np.ndarray, shards: int) -> np.ndarray:
    """By the upper bits of the first hash; a shard's buckets take the remainder of the whole of it."""
    return ((hashes[:, 0] >> np.uint64(32)) % np.uint64(shards)).astype(np.int64)


class PerfectHash:
    """Slot of each key of a fixed set, 0 to n-1 without gaps, and none for any other key.

    Keys fall into buckets; a bucket's seed sends its keys to free slots. Large buckets choose first, and a
    bucket of one key names its slot itself. Stored keys tell foreign keys apart.
    """

    def __init__(self, seeds: np.ndarray, ends: np.ndarray, blob: bytes):
        self.seeds, self.ends, self.blob = seeds, ends, blob
        self.n = len(ends) - 1

    @staticmethod
    def _slot(h: np.ndarray, seed: np.ndarray, n: int) -> np.ndarray:
        x = h + seed.astype(np.uint64) * _ODD
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        return ((x ^ (x >> np.uint64(32))) % np.uint64(n)).astype(np.int64)

    @classmethod
    def build(cls, keys: list[bytes]) -> PerfectHash:
        hashes = _hashes(keys)
        made = cls(cls._seeds(hashes), np.zeros(len(keys) + 1, dtype=np.int64), b"")
        order = np.argsort(made.guess(hashes))
        made.blob = b"".join(keys[i] for i in order)
        np.cumsum([len(keys[i]) for i in order], out=made.ends[1:])
        return made

    @classmethod
    def _seeds(cls, h: np.ndarray) -> np.ndarray:
        n = len(h)
        buckets = max(1, n // 3)
        home = (h[:, 0] % np.uint64(buckets)).astype(np.int64)
        by_home = np.argsort(home, kind="stable")
        size = np.bincount(home, minlength=buckets)
        first = np.cumsum(size) - size
        free, seeds = np.ones(n, dtype=bool), np.zeros(buckets, dtype=np.int64)
        tries = np.arange(256)
        for b in np.argsort(-size, kind="stable"):
            if size[b] < 2:
                break
            mine = h[by_home[first[b] : first[b] + size[b]], 1]
            for start in range(0, 1 << 17, len(tries)):
                slots = cls._slot(mine[None, :], (start + tries)[:, None], n)
                fits = free[slots].all(axis=1)
                if size[b] > 1:
                    ordered = np.sort(slots, axis=1)
                    fits &= (ordered[:, 1:] != ordered[:, :-1]).all(axis=1)
                if fits.any():
                    k = int(np.argmax(fits))
                    seeds[b], free[slots[k]] = start + k, False
                    break
            else:
                raise ValueError("keys repeat")
        lone = np.flatnonzero(size == 1)
        seeds[lone] = -np.flatnonzero(free)[: len(lone)] - 1
        return seeds

    def guess(self, h: np.ndarray) -> np.ndarray:
        """The slot each hashed key would have if it were one of the set."""
        seed = self.seeds[(h[:, 0] % np.uint64(len(self.seeds))).astype(np.int64)]
        return np.where(seed < 0, -seed - 1, self._slot(h[:, 1], np.maximum(seed, 0), self.n))

    def slots(self, keys: list[bytes], hashes: np.ndarray) -> np.ndarray:
        """The slot of each key, -1 where the key stored there is another."""
        guess, blob = self.guess(hashes), self.blob
        starts, ends = self.ends[guess].tolist(), self.ends[guess + 1].tolist()
        same = [blob[a:b] == k for a, b, k in zip(starts, ends, keys, strict=True)]
        return np.where(same, guess, -1)

    def to_bytes(self) -> bytes:
        head = np.array([len(self.seeds), self.n], dtype="<i8")
        return b"".join([head.tobytes(), self.seeds.astype("<i4").tobytes(), self.ends.astype("<i4").tobytes(), self.blob])

    @classmethod
    def from_bytes(cls, data: bytes) -> PerfectHash:
        buckets, n = np.frombuffer(data, "<i8", 2).tolist()
        at = 16 + 4 * buckets
        seeds = np.frombuffer(data, "<i4", buckets, 16).astype(np.int64)
        return cls(seeds, np.frombuffer(data, "<i4", n + 1, at).astype(np.int64), data[at + 4 * (n + 1) :])


def _build_shard(terms: pd.DataFrame) -> pd.DataFrame:
    """The terms of a shard with their slots; the row of slot 0 carries the shard's hash."""
    keys = [_key(t.encode(), g.encode()) for t, g in zip(terms.term, terms.lang, strict=True)]
    made = PerfectHash.build(keys)
    out = terms[["shard", "lang", "term"]].assign(slot=made.guess(_hashes(keys)))
    out["hash"] = [made.to_bytes() if s == 0 else None for s in out.slot]
    return out


def _with_shard(shards: int):
    """Adds the shard of each (lang, term)."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = (batch.column(c).to_pylist() for c in ("lang", "term"))
            keys = [_key(term.encode(), lang.encode()) for lang, term in zip(*names, strict=True)]
            shard = pa.array(_shard_of(_hashes(keys), shards), pa.int32())
            yield pa.RecordBatch.from_arrays([*batch.columns, shard], [*batch.schema.names, "shard"])

    return deal


def _recount(broadcast, shards: int):
    """(lang, source, shard, slot, n) of the kept terms; (lang, source, -1, -1, 0) for every group."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = {shard: PerfectHash.from_bytes(data) for shard, data in broadcast.value.items()}
        groups: dict[tuple[str, str], Counter] = defaultdict(Counter)
        dense: dict[tuple[tuple[str, str], int], np.ndarray] = {}
        seen: set[tuple[str, str]] = set()
        read = 0

        def rows(group, shard, slots, n) -> pa.RecordBatch:
            size = len(slots)
            columns = [
                pa.array([group[0]] * size, pa.string()), pa.array([group[1]] * size, pa.string()),
                pa.array([shard] * size, pa.int32()), pa.array(slots, pa.int32()), pa.array(n, pa.int64()),
            ]
            return pa.RecordBatch.from_arrays(columns, ["lang", "source", "shard", "slot", "n"])

        def increment() -> Iterator[pa.RecordBatch]:
            for group, counts in groups.items():
                end = b"\0" + group[0].encode()
                keys = [t + end if len(t) + len(end) <= LONG_KEY else _key(t, end[1:]) for t in counts]
                numbers, h = np.fromiter(counts.values(), np.int64, len(counts)), _hashes(keys)
                shard_of = _shard_of(h, shards)
                order = np.argsort(shard_of, kind="stable")
                for some in np.split(order, np.flatnonzero(np.diff(shard_of[order])) + 1):
                    shard = int(shard_of[some[0]]) if len(some) else -1
                    if shard not in hashes:
                        continue
                    slots = hashes[shard].slots([keys[i] for i in some], h[some])
                    if (group, shard) not in dense:
                        dense[group, shard] = np.zeros(hashes[shard].n, dtype=np.uint32)
                    # a slot belongs to one key, so no slot occurs twice here
                    dense[group, shard][slots[slots >= 0]] += numbers[some[slots >= 0]].astype(np.uint32)
                if sum(a.nbytes for a in dense.values()) > HELD_BYTES:
                    yield from hand_on()
            groups.clear()

        def hand_on() -> Iterator[pa.RecordBatch]:
            for (group, shard), slots in dense.items():
                used = np.flatnonzero(slots)
                if len(used):
                    yield rows(group, shard, used, slots[used])
            dense.clear()

        for batch in batches:
            names = (batch.column(c).to_pylist() for c in ("lang", "source", "text"))
            for lang, source, text in zip(*names, strict=True):
                group = (lang, source)
                if group not in seen:
                    seen.add(group)
                    yield rows(group, -1, [-1], [0])
                for terms in _terms(text):
                    groups[group].update(terms)
                read += len(text)
                if read > HELD_TEXT:  # long before a slot of 32 bits could overflow
                    yield from increment()
                    yield from hand_on()
                    read = 0
            if sum(map(len, groups.values())) > HELD_TERMS:
                yield from increment()
        yield from increment()
        yield from hand_on()

    return count


def _compare_block(seen: pd.DataFrame, sources: pd.DataFrame) -> pd.DataFrame:
    """Sums of |p - q| over a block of terms, for one block of sources against all sources of the language.

    ``seen``: place, slot, p of counts above zero; ``sources``: place, source, p0 (the share of a count of
    zero) and part, whose rows marked ``mine`` are compared with all.
    """
    sources = sources.sort_values("place")
    seen = seen[seen.slot >= 0]
    slots, column = np.unique(seen.slot.to_numpy(), return_inverse=True)
    shares = np.repeat(sources.p0.to_numpy(dtype=np.int64)[:, None], len(slots), axis=1)
    shares[seen.place.to_numpy(), column] = seen.p.to_numpy(dtype=np.int64)
    names, mine = sources.source.to_numpy(), np.flatnonzero(sources.mine.to_numpy())
    out = []
    for i in mine:
        value = np.abs(shares - shares[i]).sum(axis=1)
        others = np.arange(len(names)) != i
        out.append(pd.DataFrame({"source": names[i], "item": names[others], "value": value[others]}))
    made = pd.concat(out) if out else pd.DataFrame({"source": [], "item": [], "value": []})
    return made.assign(lang=sources.lang.iloc[0] if len(sources) else "")[["lang", "source", "item", "value"]]


def source_divergence(
    documents: DataFrame, min_docs: int = 30, smoothing: int = 5, scale: int = 10**9, top: int = 50,
    shard_terms: int = SHARD_TERMS, wave_shards: int = WAVE_SHARDS,
) -> DataFrame:
    """lang, source, part, item, value, rank: sources by distance (``pair``), terms a source overuses (``term``)."""
    spark = prepare(documents.sparkSession)

    def words(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit("")).alias(name)

    docs = documents.select(words("lang"), words("source"), words("text").cast("binary").alias("text"))

    frequency = docs.select("lang", "text").mapInArrow(_count_documents, "lang string, term string, n bigint")
    kept = stage(frequency.groupBy("lang", "term").agg(F.sum("n").alias("n")).where(F.col("n") >= min_docs), "kept_terms")
    shards = max(1, -(-kept.count() // shard_terms))
    sharded = kept.select("lang", "term").mapInArrow(_with_shard(shards), "lang string, term string, shard int")
    built = sharded.groupBy("shard").applyInPandas(_build_shard, "shard int, lang string, term string, slot int, hash binary")
    slots = stage(built, "slots")

    counted = None
    for wave in range(0, shards, wave_shards):
        chosen = slots.where(F.col("hash").isNotNull() & F.col("shard").between(wave, wave + wave_shards - 1))
        # at most wave_shards rows, each bounded by shard_terms keys of LONG_KEY bytes
        broadcast = spark.sparkContext.broadcast({r.shard: r.hash for r in chosen.select("shard", "hash").collect()})
        found = docs.mapInArrow(_recount(broadcast, shards), "lang string, source string, shard int, slot int, n bigint")
        counted = found if counted is None else counted.unionByName(found)
    counts = stage(counted.groupBy("lang", "source", "shard", "slot").agg(F.sum("n").alias("n")), "counts")

    def share(n: Column | str, total: Column | str, terms: Column | str) -> Column:
        part = (F.col(n) if isinstance(n, str) else n).cast("decimal(20,0)") + F.lit(smoothing)
        whole = F.col(total).cast("decimal(20,0)") + F.col(terms).cast("decimal(20,0)") * F.lit(smoothing)
        floor = F.call_function("div", (part * F.lit(scale).cast("decimal(12,0)")).cast("decimal(38,0)"), whole.cast("decimal(38,0)"))
        return F.lit(1).cast("bigint") + floor

    vocabulary = slots.groupBy("lang").agg(F.count("*").alias("v"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    groups = counts.groupBy("lang", "source").agg(F.sum("n").alias("total")).join(vocabulary, "lang", "left")
    groups = stage(groups.withColumn("place", place), "groups")

    # terms that a source has more often than its language
    seen = counts.where("n > 0").join(groups, ["lang", "source"]).withColumn("p", share("n", "total", "v"))
    of_lang = counts.groupBy("shard", "slot").agg(F.sum("n").alias("lang_n"))
    lang_totals = groups.groupBy("lang").agg(F.sum("total").alias("lang_total"))
    known = slots.select("shard", "slot", "lang", "term").join(of_lang, ["shard", "slot"]).join(lang_totals, "lang").join(vocabulary, "lang")
    known = known.select("shard", "slot", "term", share("lang_n", "lang_total", "v").alias("q"))
    over = seen.join(known, ["shard", "slot"]).where("p > q").select("lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    terms = over.withColumn("rank", F.row_number().over(by_value)).where(F.col("rank") <= top)

    # distances of sources: blocks of slots, and blocks of sources against all of the language
    block = F.col("shard").cast("bigint") * F.lit(1 << 20) + F.floor(F.col("slot") / F.lit(BLOCK_SLOTS))
    parts = groups.select("lang", F.floor(F.col("place") / F.lit(BLOCK_SOURCES)).alias("part")).distinct()
    shown = counts.join(groups.select("lang", "source", "total", "v", "place"), ["lang", "source"])
    shown = shown.select("lang", block.alias("block"), "place", "slot", F.when(F.col("n") > 0, share("n", "total", "v")).alias("p"))
    left = shown.join(parts, "lang")
    blocks = left.select("lang", "block", "part").distinct()
    # a count of zero has this share; without terms there is none
    nothing = F.when(F.col("v") > 0, share(F.lit(0), "total", "v")).otherwise(F.lit(0)).alias("p0")
    mine = (F.floor(F.col("place") / F.lit(BLOCK_SOURCES)) == F.col("part")).alias("mine")
    keys = ["lang", "block", "part"]
    # fresh names, as both sides come from the same counts
    right = blocks.join(groups, "lang").select(*[F.col(k).alias(k) for k in keys], "place", "source", nothing, mine)
    sums = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(
        _compare_block, "lang string, source string, item string, value bigint"
    )
    pairs = sums.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    pairs = pairs.withColumn("rank", F.row_number().over(by_value))

    columns = ["lang", "source", "part", "item", "value", "rank"]
    return pairs.withColumn("part", F.lit("pair")).select(columns).unionByName(terms.withColumn("part", F.lit("term")).select(columns))
