"""Toxicity, quality and licence classifiers: what they learn, and their odd rows."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from kerbside.llm import license_scan, quality, toxicity
from kerbside.llm.common import id_remainder, labelled_sample, prepare
from kerbside.llm.queries import op3_quality_classifier, op10_toxicity

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score string, predicted string, target int, features int"
LABELS = "doc_id long, quality int, toxic int, text string, target string"


def _docs(spark, rows):
    prepare(spark)
    return spark.createDataFrame([(i, t, "en", "s", 1, "", "", 0, 0) for i, t in rows], DOCS)


def _labels(spark, rows):
    return spark.createDataFrame([(i, q, t, "", "") for i, q, t in rows], LABELS)


@pytest.fixture(scope="module")
def corpus():
    """Plain and insulting, tidy and junk documents of invented words."""
    r = random.Random(6)
    parts = "an the on er in st re nd ou en ly ing".split()
    word = lambda: "".join(r.choice(parts) for _ in range(r.randint(1, 4)))
    insults = ["blockhead", "dimwit", "nitwit"]
    docs, labels = [], []
    for i in range(600):
        words = [word() for _ in range(r.randint(5, 120))]
        toxic, good = i % 5 == 0, i % 7 != 0
        if toxic:
            for _ in range(r.randint(1, 3)):
                words.insert(r.randrange(len(words) + 1), r.choice(insults) + r.choice(["", "s", "."]))
        if not good:
            words = [w + r.choice(["###", "$%$", "&&&"]) for w in words]
        docs.append((i, " ".join(words)))
        labels.append((i, int(good), int(toxic)))
    return docs, labels


@pytest.fixture(scope="module")
def restorer():
    text = "you are a blockhead and a dimwit nitwit the other people are good and kind to you all day and they look at the book " * 30
    counts = np.zeros(toxicity.SYMBOLS**3, dtype=np.int64)
    for _, block in toxicity._blocks([toxicity.plain(text)]):
        counts += np.bincount(toxicity._trigrams(block), minlength=toxicity.SYMBOLS**3)
    return toxicity.Restorer(toxicity.character_costs(counts))


@pytest.mark.parametrize(
    ("seen", "restored"),
    [
        ("bl0ckh3ad", "blockhead"), ("B-L-O-C-K-H-E-A-D", "blockhead"), ("d i m w i t", "dimwit"), ("diiimwiiiit", "dimwit"),
        ("n1tw1t!", "nitwit"), ("you are good", "you are good"), ("", ""), (None, ""), ("dímwït", "dimwit"),
        ("a book at 12:30, 2024", "a book at 12:30, 2024"), ("d​imwit", "dimwit"), ("b.l.0.c.k.h.e.a.d", "blockhead"),
    ],
)
def test_restoration(restorer, seen, restored):
    assert restorer.restore(seen).strip() == restored


def test_restoration_picks_the_likeliest_path(restorer):
    """The search against all paths of the lattice."""
    from itertools import product

    for word in ("d1mw1t", "b00k", "9ood", "k1nnnd", "+he", "l00k", "|ook"):
        slots = restorer._slots(word, False)
        costs = {}
        for path in product(*slots):
            text = "".join(p[0] for p in path)
            cost = restorer._price([text]) + sum(p[1] for p in path)
            costs[text] = min(cost, costs.get(text, 1e9))
        assert restorer.decode(word) == min((c, t) for t, c in costs.items())[1]


def test_long_texts_and_blocks(restorer, monkeypatch):
    texts = ["bl0ckhead " * 20, "", "plain words here " * 500, "d i m w i t", None] * 7
    model = toxicity.ToxicityModel(restorer.costs, {"blockhead.": 4.0, "dimw": 5.0}, -3.0)
    whole = model.score_texts(texts, restorer, model.heads())
    monkeypatch.setattr(toxicity, "BLOCK_BYTES", 100)
    assert model.score_texts(texts, restorer, model.heads()) == whole
    sure = lambda z: 1 / (1 + np.exp(-z))
    assert np.allclose(whole, [sure(1), sure(-3), sure(-3), sure(2), sure(-3)] * 7)


def test_toxicity_learns_and_keeps_held_out_rows_out(spark, corpus):
    docs, labels = corpus
    extra = [(9001, "such a n1tw1t"), (9002, "b l o c k h e a d"), (9003, ""), (9004, None), (None, "kind of ly"), (9005, "the and " * 50_000)]
    learn = id_remainder(F.col("doc_id"), 4) != 2
    got = toxicity.score_toxicity(_docs(spark, docs + extra + extra[:1]), _labels(spark, labels), learn).collect()
    assert len(got) == len(docs) + 7 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    by = {r.doc_id: r.predicted for r in got}
    held = [i for i, _, _ in labels if zlib.crc32(str(i).encode()) % 4 == 2]
    truth = {i: t for i, _, t in labels}
    assert np.mean([by[i] == truth[i] for i in held]) > 0.97
    assert (by[9001], by[9002], by[9003], by[9004], by[9005], by[None]) == (1, 1, 0, 0, 0, 0)
    kept = toxicity.drop_toxic(_docs(spark, docs + extra), _labels(spark, labels))
    assert kept.columns == _docs(spark, []).columns
    assert {r.doc_id for r in kept.collect()} == {i for i, p in by.items() if not p}


def test_quality_learns(spark, corpus):
    docs, labels = corpus
    extra = [(9003, ""), (9004, None), (None, "kind of ly"), (9005, "the and on ly " * 30_000)]
    learn = id_remainder(F.col("doc_id"), 5) != 0
    got = quality.score_quality(_docs(spark, docs + extra + extra[:1]), _labels(spark, labels), learn).collect()
    assert len(got) == len(docs) + 5 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    by = {r.doc_id: r.predicted for r in got}
    held = [i for i, _, _ in labels if zlib.crc32(str(i).encode()) % 5 == 0]
    truth = {i: q for i, q, _ in labels}
    assert np.mean([by[i] == truth[i] for i in held]) > 0.97
    kept = quality.drop_low_quality(_docs(spark, docs), _labels(spark, labels))
    assert kept.columns == _docs(spark, []).columns and 480 < kept.count() < 540


def test_temperature_calibrates():
    """Labels that are right nine times of ten: probabilities must not be surer than that."""
    rng = np.random.default_rng(0)
    x = rng.normal(size=(4000, 5))
    y = ((x[:, 0] > 0) ^ (rng.random(4000) < 0.1)).astype(float)
    net = quality.fit_net(x[:2000], y[:2000])
    p = net.probability(x[2000:])
    assert abs(p[x[2000:, 0] > 0.2].mean() - 0.9) < 0.04 and ((p >= 0.5) == (x[2000:, 0] > 0)).mean() > 0.93


def test_pooled_vectors_do_not_depend_on_the_batch():
    vectors = np.random.default_rng(1).normal(size=(quality.BUCKETS, quality.DIMENSIONS)).astype(np.float32)
    texts = ["a bb ccc", "", None, "x " * 5000, "a bb ccc", "!!! ???"]
    together = quality.document_features(texts, vectors)
    assert np.allclose(together, np.concatenate([quality.document_features([t], vectors) for t in texts]), atol=1e-5)
    assert not together[1:3].any()


def test_no_labels_and_empty_tables(spark):
    docs, none = _docs(spark, [(1, "a b"), (2, None)]), _labels(spark, [])
    assert {r.score for r in quality.score_quality(docs, none).collect()} == {0.5}
    assert {r.predicted for r in toxicity.score_toxicity(docs, none).collect()} == {0}
    assert quality.score_quality(docs.limit(0), none).count() == 0
    assert toxicity.score_toxicity(docs.limit(0), none).count() == 0
    one_sided = _labels(spark, [(1, None, None), (None, 1, 1), (2, 7, 0)])
    assert {r.predicted for r in toxicity.score_toxicity(docs, one_sided).collect()} == {0}


def test_sample_is_bounded_and_clear_of_contradictions(spark):
    docs = _docs(spark, [(i, "t") for i in range(2000)])
    labels = _labels(spark, [(i, i % 2, 0) for i in range(2000)] + [(1, 0, 0)])
    got = labelled_sample(docs, labels, "quality", F.col("doc_id") % 10 != 3, 200).collect()
    assert 100 < len(got) < 320 and all(r.doc_id % 10 != 3 for r in got)
    assert [r.target for r in labelled_sample(docs, labels, "quality", F.col("doc_id") == 1, 10**6).collect()] == [0]


@pytest.mark.parametrize(("query", "target", "modulus", "rest"), [(op3_quality_classifier, "quality", 5, 0), (op10_toxicity, "toxic", 4, 2)])
def test_held_out_rows_of_the_tables(spark, query, target, modulus, rest):
    sf_dir = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in query(spark, sf_dir).collect()}
    assert len(got) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % modulus == rest) for i, r in got.items())
    truth = {r.doc_id: r[target] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    assert np.mean([got[i].predicted == y for i, y in truth.items() if got[i].held_out]) > 0.9


def test_licences(spark):
    r = random.Random(3)
    words = "river stone public use green work under version source all terms free right market license".split()
    prose = lambda n: " ".join(r.choice(words) for _ in range(n))
    rows = [(i, "\n".join(prose(r.randint(1, 30)) for _ in range(r.randint(1, 5)))) for i in range(150)]
    rows += [
        (1000, "some text\nReleased under the MIT License.\nmore"),
        (1001, "ALL RIGHTS RESERVED."),
        (1002, "x\nThis work is licensed under the GNU General Public License, version 3.\nLicensed under CC BY-NC 4.0."),
        (1003, "Licensed under the Apache License, Version 2.0. " + prose(10)),
        (1004, None), (1005, ""), (None, "Released under the MIT License."), (1006, "a b\n" * 30_000), (1000, "Released under the MIT License."),
    ]
    docs = _docs(spark, rows).withColumn("family", F.lit(1)).withColumn("row", F.lit(1)).withColumn("words", F.lit(1))
    got = license_scan.scan_licences(docs).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert {r.family for r in got if r.doc_id is not None and r.doc_id < 150} == {None}
    assert (by[1000].family, by[1001].family, by[1003].family, by[None].family) == ("mit", "all-rights-reserved", "apache-2.0", "mit")
    assert (by[1002].families, by[1002].n_confirmed) == ("cc-by-nc-4.0,gpl-3.0", 2)
    assert by[1004].family is None and by[1005].n_paragraphs == 0 and by[1006].family is None
    assert license_scan.scan_licences(docs.limit(0)).count() == 0


def test_samples_stay_bounded_where_ids_are_null_or_repeated(spark, monkeypatch):
    from kerbside.llm import common

    rows = [(None, f"unnamed {i}") for i in range(900)] + [(7, f"namesake {i}") for i in range(900)] + [(i, f"text {i}") for i in range(900)]
    docs = _docs(spark, rows + [(None, "copy")] * 300)
    drawn = common.bounded_draw(docs, 200).collect()
    assert 120 < len(drawn) <= 200 and len({r.text for r in drawn}) == len(drawn)
    assert 20 < sum(r.doc_id is None for r in drawn) < 110 and sum(r.doc_id == 7 for r in drawn) < 110
    sizes, fit = [], license_scan.fit_licences
    monkeypatch.setattr(license_scan, "fit_licences", lambda background: (sizes.append(len(background)), fit(background, epochs=2))[1])
    license_scan.scan_licences(docs, sample_rows=200)
    assert sizes and sizes[0] <= 200


@pytest.mark.parametrize(
    ("seen", "word"),
    [
        ("you are a d i m w i t", "dimwit"), ("y o u a r e a d i m w i t", "dimwit"), ("b - l - o - c - k - h - e - a - d", "blockhead"),
        ("d i m w i t  n i t w i t", "nitwit"), ("d.i.m.w.i.t. .n.i.t.w.i.t", "dimwit"), ("a d i i i i m w i t", "dimwit"),
    ],
)
def test_spaced_words_beside_others(restorer, seen, word):
    assert word in restorer.restore(seen).split()


def test_letters_of_two_texts_stay_apart(restorer):
    model = toxicity.ToxicityModel(restorer.costs, {"dimwit.": 9.0}, -3.0)
    assert max(model.score_texts(["d i m", "w i t"], restorer, model.heads())) < 0.1


def test_another_version_is_not_confirmed(spark):
    gpl = [t for f, t in license_scan.TEMPLATES if f == "gpl-3.0" and "version 3" in t]
    rows = [(i, t) for i, t in enumerate(gpl)] + [(10 + i, t.replace("version 3", "version 2")) for i, t in enumerate(gpl)]
    words = license_scan.word_array(F.col("text"))
    got = _docs(spark, rows).select("doc_id", license_scan._confirmed(words, F.lit("gpl-3.0"), 0.8).alias("c")).collect()
    assert {r.doc_id: r.c for r in got} == {0: True, 1: True, 10: False, 11: False}
