"""Raking against a plain loop, and the pipeline against plain versions of its exact stages."""

import random

import numpy as np
import pytest
from plain import contamination, simhash_groups
from pyspark.sql import functions as F

import corpus_pipeline
from kerbside.llm import mixing
from kerbside.llm.common import prepare

COUNTED = "source string, language int, topic int, tokens long"


def _plain_rake(cells, power, sweeps=2000):
    """cells: {(source, language, topic): tokens} -> weight of each cell over its tokens."""
    sources = sorted({s for s, _, _ in cells}, key=str)
    n = np.zeros((len(sources), len(mixing.LANGUAGES) + 1, mixing.TOPICS))
    for (s, language, topic), t in cells.items():
        n[sources.index(s), language, topic] += t
    w = n.astype(float)
    for _ in range(sweeps):
        for axis in range(3):
            others = tuple(a for a in range(3) if a != axis)
            observed, now = n.sum(others), w.sum(others)
            goal = np.where(observed > 0, observed, 0) ** power * (observed > 0)
            goal /= goal.sum()
            shape = [-1 if a == axis else 1 for a in range(3)]
            w = w * np.divide(goal, now, out=np.zeros_like(goal), where=now > 0).reshape(shape)
    return {k: w[sources.index(k[0]), k[1], k[2]] / t for k, t in cells.items() if t}


def test_raking_equals_a_plain_loop(spark):
    prepare(spark)
    r = random.Random(5)
    cells = {(s, a, b): r.randint(0, 500) for s in ("x", "y", None, "hot") for a in range(5) for b in range(8) if r.random() < 0.8}
    cells[("hot", 0, 0)] = 30_000
    rows = [(s, a, b, t) for (s, a, b), t in cells.items()]
    got = mixing.rake(spark.createDataFrame(rows + [("empty", 0, 1, 0)], COUNTED), tolerance=1e-10, budget_share=0.3)
    factor = {x.source: x.source_factor for x in got.sources.collect()}
    want = _plain_rake(cells, 0.5)
    for (s, a, b), w in want.items():
        assert factor[s] * got.language[a] * got.topic[b] == pytest.approx(w, rel=1e-5)
    drawn = sum(t * min(1.0, got.scale * want[k]) for k, t in cells.items() if t)
    assert drawn == pytest.approx(0.3 * sum(cells.values()), rel=1e-5)


def test_explicit_targets(spark):
    rows = [(s, a, b, 900 if (s, a) == ("a", 0) else 20 + 7 * b) for s in "ab" for a in (0, 1) for b in (0, 1, 2)]
    got = mixing.rake(spark.createDataFrame(rows, COUNTED), language_target=np.array([0.5, 0.5, 0.3, 0, 0]), tolerance=1e-9)
    factor = {x.source: x.source_factor for x in got.sources.collect()}
    shares = np.zeros(2)
    for s, a, b, t in rows:
        shares[a] += t * factor[s] * got.language[a] * got.topic[b]
    assert shares == pytest.approx([0.5, 0.5], abs=1e-6)  # the class without tokens gives up its share


DOCS = "doc_id long, text string, lang string, source string, n_chars long, topic string, probability int, kept string, u int, m int"


def _docs(spark, rows):
    prepare(spark)
    return spark.createDataFrame([(i, t, lang, s, 1, "", 0, "", 0, 0) for i, t, lang, s in rows], DOCS)


def test_mixing_odd_rows_and_draw(spark):
    r = random.Random(9)
    words = "river stone green market house light water paper".split()
    text = lambda n: " ".join(r.choice(words) for _ in range(n))
    rows = [(i, text(r.randint(1, 60)), r.choice(["en", "en", "en", "de", "xx"]), "big" if i % 3 else f"s{i % 4}") for i in range(400)]
    rows += [(1000, None, "en", "big"), (1001, "", None, None), (None, text(9), None, "big"), (1002, text(60_000), "fr", "s1"), rows[0], rows[0]]
    docs = _docs(spark, rows)
    got = mixing.mix_sources(docs).collect()
    assert len(got) == len(rows) and all(0 <= x.probability <= 1 for x in got)
    assert {x.doc_id: x.tokens for x in got}[1002] == 60_000 and {x.doc_id: x.tokens for x in got}[1000] == 0
    assert len({(x.probability, x.kept) for x in got if x.doc_id == 0}) == 1
    expected = sum(x.tokens * x.probability for x in got)
    assert expected == pytest.approx(0.5 * sum(x.tokens for x in got), rel=1e-3)
    sampled = mixing.sample_mixture(docs)
    assert sampled.columns == docs.columns
    assert sorted(str(x.doc_id) for x in sampled.collect()) == sorted(str(x.doc_id) for x in got if x.kept)
    assert mixing.mix_sources(docs.limit(0)).count() == 0 and mixing.sample_mixture(docs.limit(0)).count() == 0


def test_topics_do_not_depend_on_the_batch(spark):
    docs = _docs(spark, [(i, f"word{i % 5} word{i % 5} other a b", "en", "s") for i in range(50)] + [(99, None, "en", "s")])
    got = docs.select("doc_id", mixing.token_and_topic(F.col("text")).alias("m")).collect()
    one = docs.repartition(7).select("doc_id", mixing.token_and_topic(F.col("text")).alias("m")).collect()
    assert sorted(got) == sorted(one) and {r.m.tokens for r in got} == {5, 0} and len({r.m.topic for r in got}) > 1


def test_pipeline_stages(spark):
    """Each stage on its predecessor's rows; the exact ones against brute force."""
    sf_dir = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES][2:4] == ["SimHash near-dedup", "benchmark decontamination"]
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    stages = {}
    for name, function in corpus_pipeline.STAGES:
        rows = docs.collect()
        out = corpus_pipeline.stage(function(spark, docs, sf_dir), "test_stage")
        kept = {r.doc_id for r in out.collect()}
        stages[name] = (len(rows), len(kept))
        assert out.columns == docs.columns and kept <= {r.doc_id for r in rows}
        if name == "SimHash near-dedup":
            assert kept == {d for d, (_, c) in simhash_groups({r.doc_id: r.text for r in rows}).items() if d == c}
        if name == "benchmark decontamination":
            assert kept == {d for d, v in contamination([(r.doc_id, r.text) for r in rows], items).items() if not v[4]}
        docs = out
    assert all(0 < kept < n for n, kept in stages.values()), stages
    assert stages["toxicity"][1] > 850 and stages["quality classifier"][1] > 0.8 * stages["quality classifier"][0]


def test_contradicting_targets_end_soon_and_say_so(spark):
    """Sources of one language each: source shares are met, the gap is told."""
    rows = [("a", 0, 0, 900), ("b", 0, 0, 50), ("c", 1, 0, 50)]
    with pytest.warns(UserWarning, match="not met"):
        got = mixing.rake(spark.createDataFrame(rows, COUNTED))
    assert not got.converged and got.sweeps <= 6 and 0 < got.gap < 0.2
    factor = {x.source: x.source_factor for x in got.sources.collect()}
    weight = {s: t * factor[s] * got.language[a] * got.topic[b] for s, a, b, t in rows}
    root = {s: t**0.5 for s, _, _, t in rows}
    assert weight == pytest.approx({s: v / sum(root.values()) for s, v in root.items()})
    assert mixing.rake(spark.createDataFrame(rows[:1], COUNTED)).converged


def test_rows_of_a_hot_id_are_drawn_one_by_one(spark):
    prepare(spark)
    rows = [(7 if i % 3 == 0 else i, f"words of text number {i}", "en", "s", 1, "", 0, "", 0, 0) for i in range(3000)]
    drawn = mixing.sample_mixture(spark.createDataFrame(rows, DOCS), budget_share=0.4)
    assert 0.36 < drawn.count() / len(rows) < 0.44 and 300 < drawn.where("doc_id = 7").count() < 500
