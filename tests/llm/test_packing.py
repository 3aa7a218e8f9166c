"""Packing: plan against a bin-by-bin version, ids against the tokenizer, places against their rules."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from __spark_entry__ import queries
from kerbside.llm.packing import WordIds, best_two_fit, pack_documents

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def one_by_one(lengths, capacity):
    """Best-two-fit as its definition says, a bin at a time over a list of documents."""
    left, bins = sorted(lengths, reverse=True), []
    while left:
        held, gap = [], capacity
        for n in list(left):
            if n <= gap:
                held.append(n)
                left.remove(n)
                gap -= n
        if gap and len(held) > 1:
            small = min(held)
            pairs = [
                (a + b, a, b)
                for i, a in enumerate(left)
                for b in left[i + 1 :]
                if small < a + b <= gap + small
            ]
            if pairs:
                _, a, b = max(pairs)
                held.remove(small)
                left.append(small)
                for n in (a, b):
                    held.append(n)
                    left.remove(n)
                left.sort(reverse=True)
        bins.append(sorted(held))
    return bins


@pytest.mark.parametrize("seed", range(60))
def test_plan_is_bin_by_bin(seed):
    r = random.Random(seed)
    capacity = r.choice([7, 12, 30, 64])
    lengths = [r.randint(1, r.choice([capacity, max(2, capacity // 2)])) for _ in range(r.randint(0, 90))]
    got = [sorted(Counter(b.used).elements()) for b in best_two_fit(Counter(lengths), capacity) for _ in range(b.repeat)]
    assert got == one_by_one(lengths, capacity)


def test_two_documents_replace_the_smallest():
    # greedily 6 + 3; 2 + 2 fit the gap of 4 that the 3 leaves more tightly
    assert [b.used for b in best_two_fit({6: 1, 3: 1, 2: 2}, 10)] == [{6: 1, 2: 2}, {3: 1}]


def test_plan_is_bounded_by_the_lengths():
    r = random.Random(1)
    counts = {n: r.randint(1, 10**9) for n in range(1, 4097)}
    plan = best_two_fit(counts, 4096)
    assert len(plan) < 4 * 4096
    total = sum(n * c for n, c in counts.items())
    assert sum(b.repeat for b in plan) <= 1.01 * -(-total // 4096)


TEXTS = [
    None, "", " ", "plain words, with signs!", "UPPER <|endoftext|> lower <|ENDOFTEXT|>", "don't we'll I'S 'T",
    "é é É Å ≮ ≮ ≠x", "a\x1cb\xa0c d\x85e​f", "ΟΔΟΣ İstanbul ß × ÷ ×, ÷!", "１２３ ½ 12,5%",
    "“,” «!» …?", "한국 한", "x" * 5000 + "," + "y" * 70, "word " * 9000, "%%% a%%% é%%% ñ,,;", "﻿bom á, ö!",
]


def test_word_ids_are_the_tokenizers():
    tokenizer = Tokenizer.from_file(VOCABULARY)
    with open(VOCABULARY, encoding="utf-8") as f:
        words = WordIds(f.read())
    for text in TEXTS:
        got = np.frombuffer(words.text_ids((text or "").encode()), dtype="<u4").tolist()
        assert got == tokenizer.encode(text or "", add_special_tokens=False).ids, text


def check(rows, docs, capacity=4096):
    """Every token of every document once, cut and placed as the contract says; returns the sequences."""
    tokenizer = Tokenizer.from_file(VOCABULARY)
    ids = [tokenizer.encode(t or "", add_special_tokens=False).ids + [1] for _, t in docs]
    want = Counter()
    for (doc, _), x in zip(docs, ids, strict=True):
        for piece, start in enumerate(range(0, len(x), capacity)):
            body = np.array(x[start : start + capacity], dtype="<u4").tobytes()
            want[doc, piece, start, len(body) // 4, zlib.crc32(body)] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for held in sequences.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences), sum(map(len, ids))


def test_registered_query(spark):
    sf = "/root/testdata/sf0.01"
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    used, tokens = check(queries()["op13_packing"](spark, sf).collect(), docs)
    assert used <= -(-tokens // 4096) + 1


def test_odd_rows(spark):
    docs = [(i % 5 if i % 7 else None, t) for i, t in enumerate(TEXTS * 3)]
    frame = spark.createDataFrame([(*d, 1, 2) for d in docs], "doc_id bigint, text string, length int, part int").repartition(5)
    check(pack_documents(frame, VOCABULARY, capacity=64).collect(), docs, 64)
    assert pack_documents(frame.limit(0), VOCABULARY).count() == 0


def test_other_vocabularies(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    frame = spark.createDataFrame([(1, "two  words"), (2, None)], "doc_id int, text string")
    n = len(Tokenizer.from_file(path).encode("two  words", add_special_tokens=False).ids)
    rows = pack_documents(frame, path, end_id=50256, whole_words=False).collect()
    assert {r.doc_id: r.length for r in rows} == {1: n + 1, 2: 1}


def test_a_hot_length_is_spread(spark):
    frame = spark.range(20000).selectExpr("id as doc_id", "case when id % 3 = 0 then 'same' else repeat('w ', cast(id % 90 as int)) end as text")
    rows = pack_documents(frame.repartition(8), VOCABULARY, capacity=128).collect()
    total = sum(r.length for r in rows)
    assert len(rows) == 20000 and len({r.sequence_id for r in rows}) <= -(-total // 128) + 1
    assert len({(r.sequence_id, r.offset) for r in rows}) == 20000
