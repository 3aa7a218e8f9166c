"""SimHash and embedding near-duplicates against all pairs, and their odd rows."""

import random

import numpy as np
import pytest
from plain import near_vectors, simhash, simhash_groups
from pyspark.sql import functions as F

from kerbside.llm import embedding_dedup, simhash_dedup
from kerbside.llm.common import prepare
from kerbside.llm.components import components

DOCS = "doc_id long, text string, lang string, source string, n_chars long, fp string, component string, fingerprint int"


def _docs(spark, rows):
    prepare(spark)
    return spark.createDataFrame([(i, t, "en", "s", 1, "x", "y", 0) for i, t in rows], DOCS)


def _texts(seed=1, n=60):
    """Texts of 30 to 300 words; most have copies with a word or two changed."""
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefg") for _ in range(5))
    out = []
    while len(out) < n:
        base = [word() for _ in range(r.randint(30, 300))]
        for _ in range(r.randint(1, 6)):
            copy = list(base)
            for _ in range(r.randint(0, 2)):
                copy[r.randrange(len(copy))] = word()
            out.append(" ".join(copy))
    return out


@pytest.mark.parametrize("cell_limit", [64, 1])
def test_simhash_equals_all_pairs(spark, cell_limit):
    """With a limit of 1 every shared cell takes the way of crowded cells."""
    texts = {10 + i: t for i, t in enumerate(_texts())}
    texts |= {1: "", 2: None, 3: "A b", 4: "a B", 5: " \t ", 6: "word " * 40_000}
    found = simhash_dedup.simhash_components(_docs(spark, texts.items()), cell_limit=cell_limit)
    rows = found.select("doc_id", simhash_dedup.hexadecimal(F.col("fp")).alias("f"), "component_id").collect()
    assert {r.doc_id: (r.f, r.component_id) for r in rows} == simhash_groups(texts)
    assert len({c for _, c in simhash_groups(texts).values()}) < len(texts)


def test_every_close_fingerprint_is_linked(spark):
    """Fingerprints at 0 to 4 bits from each other, made directly: links join exactly those within two bits."""
    r = random.Random(4)
    values = {0, -1, 1 << 62}
    for _ in range(40):
        base = r.getrandbits(64) - (1 << 63)
        for bits in range(5):
            flipped = base & ((1 << 64) - 1)
            for b in r.sample(range(64), bits):
                flipped ^= 1 << b
            values.add(flipped - (1 << 64) if flipped >> 63 else flipped)
    from plain import roots

    near = [(a, b) for a in values for b in values if a < b and ((a ^ b) & ((1 << 64) - 1)).bit_count() <= 2]
    for limit in (64, 1):
        links = simhash_dedup.fingerprint_links(spark.createDataFrame([(v,) for v in values], "fp long"), cell_limit=limit)
        got = {tuple(x) for x in links.collect()}
        assert roots(values, got) == roots(values, near)
    with pytest.raises(ValueError):
        simhash_dedup.fingerprint_links(spark.createDataFrame([], "fp long"), max_bits=3)


def test_simhash_odd_rows(spark):
    rows = [(None, "a b c d"), (7, "a b c d"), (7, "a b c d"), (None, "z z z q")]
    got = simhash_dedup.simhash_components(_docs(spark, rows)).collect()
    assert sorted(f"{r.doc_id} {r.component_id}" for r in got) == ["7 7", "7 7", "None 7", "None None"]
    assert simhash_dedup.simhash_components(_docs(spark, [])).count() == 0
    kept = simhash_dedup.drop_near_copies(_docs(spark, [(3, "x y z"), (1, "x y z"), (2, "other words here"), (None, "x y z")]))
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "2", "None"]
    assert kept.columns == _docs(spark, []).columns
    assert simhash_dedup.drop_near_copies(_docs(spark, [])).count() == 0


def test_long_texts_are_hashed_in_chunks(monkeypatch):
    text = " ".join(f"w{i % 97}" for i in range(3000))
    monkeypatch.setattr(simhash_dedup, "CHUNK", 64)
    assert simhash_dedup.fingerprint_of(text) & ((1 << 64) - 1) == simhash(text)


def test_components_of_chains_and_hubs(spark):
    chain = [(i, i + 1) for i in range(100, 130)]
    hub = [(5, i) for i in range(6, 60)]
    links = spark.createDataFrame([*chain, *hub, (1, 1), (None, 3), (70, 60), (60, 70)], "a long, b long")
    got = {r.node: r.component for r in components(links).collect()}
    assert got == {**{i: 100 for i in range(100, 131)}, **{i: 5 for i in range(5, 60)}, 60: 60, 70: 60}
    assert components(links.limit(0)).count() == 0


VECTORS = "vec_id long, label int, embedding array<float>, keys int, n string, block int"


def _vectors(spark, rows):
    prepare(spark)
    return spark.createDataFrame([(i, label, v, 0, "", 1) for i, label, v in rows], VECTORS)


def _near(rng, v, cosine):
    side = rng.normal(size=len(v))
    side -= side @ v * v
    return cosine * v + np.sqrt(1 - cosine**2) * side / np.linalg.norm(side)


def _checked(df) -> dict:
    return {r.vec_id: (r.n_links, r.component_id, r.kept) for r in df.collect()}


@pytest.mark.parametrize("bucket_rows", [256, 4])
def test_embeddings_equal_all_pairs(spark, bucket_rows):
    """Groups of close vectors just inside and outside the threshold, in blocks smaller than the groups."""
    rng = np.random.default_rng(3)
    rows, i = [], 0
    for _ in range(25):
        base = rng.normal(size=32)
        base /= np.linalg.norm(base)
        for _ in range(int(rng.integers(1, 14))):
            v = _near(rng, base, float(rng.choice([0.97, 0.985, 0.992, 0.999]))) * rng.uniform(0.2, 5)
            rows.append((i, int(rng.integers(0, 2)), [float(np.float32(x)) for x in v]))
            i += 1
    rows += [(1000 + k, label, v) for k, (_, label, v) in enumerate(rows[:10])]  # equal vectors
    want = near_vectors(rows)
    assert sum(n for n, _, _ in want.values()) > 100
    assert _checked(embedding_dedup.near_vectors(_vectors(spark, rows), block_rows=16, bucket_rows=bucket_rows)) == want


def test_tables_meet_at_the_threshold():
    """Recall of the hardest pairs, on vectors the tables were not fitted on, at several sizes."""
    rng = np.random.default_rng(8)
    x = rng.normal(size=(3000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    for largest in (100, 100_000, 10_000_000):
        tables = embedding_dedup.fit_tables(x[:1500], largest, 0.98)
        turned = np.stack([_near(rng, v, 0.98) for v in x[1500:]])
        assert (tables.keys(x[1500:]) == tables.keys(turned)).any(1).mean() > 0.995
        bits = tables.keys(x[1500:])
        assert len(np.unique(bits[:, 0])) > 0.5 * min(1500, 2**tables.bits)  # balanced


def test_embeddings_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, 1, [1.0, 0.0]), (2, 1, [2.0, 0.0]), (3, None, [1.0, 0.0]), (4, 1, None), (5, 1, []), (6, 1, [0.0, 0.0]),
        (7, 1, [nan, 1.0]), (8, 1, [inf, 1.0]), (9, 1, [None, 1.0]), (10, 2, [1.0, 0.0]), (11, 1, [1.0, 0.0, 0.0]),
    ]
    assert _checked(embedding_dedup.near_vectors(_vectors(spark, rows))) == near_vectors(rows)
    repeated = [(1, 1, [1.0, 0.0]), (1, 1, [1.0, 0.0]), (2, 1, [1.0, 0.1]), (None, 1, [1.0, 0.0])]
    got = _checked(embedding_dedup.near_vectors(_vectors(spark, repeated)))
    assert got == {1: (1, 1, True), 2: (1, 1, False), None: (0, None, False)}
    assert embedding_dedup.near_vectors(_vectors(spark, [])).count() == 0


def test_one_row_of_each_group_is_kept(spark):
    """Repeated rows, copies without an id, and another text under the id of a removed copy."""
    rows = [(1, "x y z"), (1, "x y z"), (2, "x y z"), (2, "quite other words here"), (None, "only unnamed copies"), (None, "only unnamed copies")]
    kept = simhash_dedup.drop_near_copies(_docs(spark, rows)).collect()
    assert sorted(str((r.doc_id, r.text)) for r in kept) == [
        "(1, 'x y z')", "(2, 'quite other words here')", "(None, 'only unnamed copies')"
    ]


def test_tables_that_miss_the_recall_are_an_error():
    x = np.random.default_rng(8).normal(size=(200, 64))
    with pytest.raises(RuntimeError):
        embedding_dedup.fit_tables(x / np.linalg.norm(x, axis=1, keepdims=True), 10_000_000, 0.3)


def test_vectors_without_id_and_of_extreme_size(spark):
    prepare(spark)
    rows = [(None, 1, [1.0, 0.0])] * 2 + [(None, 2, None)]
    rows += [(1, 1, [1e-200, 0.0]), (2, 1, [3.0, 3.0]), (3, 1, [1e200, 0.0]), (4, 1, [1e200, 1e199]), (5, 1, [1e-300, 1e-300])]
    frame = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    got = embedding_dedup.near_vectors(frame).collect()
    assert sorted(str((r.vec_id, r.n_links, r.component_id, r.kept)) for r in got) == sorted(
        ["(None, 0, None, False)"] * 3
        + ["(1, 2, 1, True)", "(2, 1, 2, True)", "(3, 2, 1, False)", "(4, 2, 1, False)", "(5, 1, 2, False)"]
    )
