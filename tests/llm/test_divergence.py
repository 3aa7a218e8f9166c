"""Source divergence: the perfect hash by its definition, the audit against SQL and a plain version."""

import random
import re
from collections import Counter, defaultdict

import pytest
from compare import connect, difference

from __spark_entry__ import oracle_sql, queries
from kerbside.llm import divergence
from kerbside.llm.divergence import PerfectHash, _hashes, source_divergence


@pytest.mark.parametrize("n", [1, 2, 3, 5, 17, 100, 3000])
def test_perfect_hash(n):
    keys = [f"{i * 7919}\0en".encode() for i in range(n)]
    made = PerfectHash.from_bytes(PerfectHash.build(keys).to_bytes())
    assert sorted(made.slots(keys, _hashes(keys))) == list(range(n))
    other = [b"other", b"", b"7918\0en"]
    assert (made.slots(other, _hashes(other)) == -1).all()


def test_equal_keys_are_refused():
    with pytest.raises(ValueError):
        PerfectHash.build([b"a", b"a", b"b"])


def plain(docs, min_docs, top=50):
    split = lambda t: [x.translate({i: i + 32 for i in range(65, 91)}) for x in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", t or "")]
    docs = [(lang or "", source or "", split(text)) for text, lang, source in docs]
    held, counts, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for lang, source, words in docs:
        held[lang].update(set(words))
        groups[lang].add(source)
    for lang, source, words in docs:
        for w in words:
            if held[lang][w] >= min_docs:
                counts[lang, source][w] += 1
                counts[lang][w] += 1
    out = set()
    for lang, sources in groups.items():
        terms = [w for w, n in held[lang].items() if n >= min_docs]
        share = lambda c: {w: 1 + 10**9 * (c[w] + 5) // (sum(c.values()) + 5 * len(terms)) for w in terms}
        of_lang, of = share(counts[lang]), {s: share(counts[lang, s]) for s in sources}
        for s in sources:
            pairs = [(-sum(abs(of[s][w] - of[o][w]) for w in terms), o.encode(), o) for o in sources - {s}]
            over = [
                (of_lang[w] - of[s][w], w.encode(), w) for w in terms if counts[lang, s][w] and of[s][w] > of_lang[w]
            ]
            for part, rows in (("pair", sorted(pairs)), ("term", sorted(over)[:top])):
                out |= {(lang, s, part, o, -v, k + 1) for k, (v, _, o) in enumerate(rows)}
    return out


def rows(df):
    got = [(r.lang, r.source, r.part, r.item, r.value, r["rank"]) for r in df.collect()]
    assert len(got) == len(set(got))
    return set(got)


def fixture(n=400, seed=3):
    r = random.Random(seed)
    words = [f"{a}{b}" for a in "abcdefgh" for b in "xyzé字"] + ["Zebra", "ZEBRA", "L" * 300, "İst"]
    docs = []
    for i in range(n):
        lang, source = r.choice(["en", "en", "de", None, "en\0x"]), r.choice(["hot", "hot", "s1", "s2", "s3", None])
        text = r.choice([" ", ", 7 ", "-"]).join(r.choices(words, weights=range(1, len(words) + 1), k=r.randint(0, 30)))
        docs.append((None if i % 50 == 0 else text, lang, source))
    return [*docs, ("", "xx", "lonely"), (None, "yy", "a"), ("one", "yy", "b")]


@pytest.mark.parametrize("sizes", [{}, {"shard_terms": 7, "wave_shards": 3}])
def test_against_a_plain_version(spark, monkeypatch, sizes):
    docs = fixture()
    frame = spark.createDataFrame([(i, *d, 1) for i, d in enumerate(docs)], "doc_id int, text string, lang string, source string, shard int")
    assert rows(source_divergence(frame.repartition(5), min_docs=8, top=6, **sizes)) == plain(docs, 8, 6)


def test_held_terms_are_handed_on(spark, monkeypatch):
    """The parts of a task that are handed on early add up to the same."""
    for name in ("HELD_TERMS", "HELD_BYTES", "SEGMENT"):
        monkeypatch.setattr(divergence, name, 10)
    docs = [("a b c d e f g h", "en", "s")] * 3 + [("a A a", "en", "t"), ("b c", "en", "s")]
    batch = __import__("pyarrow").RecordBatch.from_pylist([{"lang": x, "source": s, "text": t.encode()} for t, x, s in docs])
    totals = Counter()
    for part in divergence._count_documents(iter([batch, batch])):
        for r in part.to_pylist():
            totals[r["term"]] += r["n"]
    assert totals == {"a": 8, "b": 8, "c": 8, "d": 6, "e": 6, "f": 6, "g": 6, "h": 6}


def test_no_rows(spark):
    assert source_divergence(spark.createDataFrame([], "doc_id int, text string, lang string, source string")).count() == 0


def test_registered_query_equals_sql(spark):
    sf = "/root/testdata/sf0.01"
    assert difference(queries()["op12_source_divergence"](spark, sf), connect(sf), oracle_sql()["op12_source_divergence"]) is None
