"""The toxicity decoder under the character and word counts of the given documents."""

import math
import time
from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from kerbside.llm import toxicity
from kerbside.llm.common import id_remainder, labelled_sample, read_table

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def model(spark):
    docs, labels = read_table(spark, SF, "documents"), read_table(spark, SF, "labels")
    return toxicity.fit_toxicity(docs, labels, id_remainder(F.col("doc_id"), 4) != 2)


def _score(model, texts):
    return model.score_texts(texts, model.restorer(), model.heads())


def _spelled(word):
    yield " ".join(word)
    yield "-".join(word)
    yield "\n".join(word)
    yield "/".join(word)
    yield ", ".join(word)
    yield "  ".join(word)
    yield " ".join("you are a" + word).replace("  ", " ")
    yield "you are a " + " ".join(word)
    yield " ".join("youarea" + word)


def test_spelled_out_words_are_found(model, spark):
    """Every weighed word that is toxic by itself is so spelled out, in whichever way, alone or after others."""
    words = [f[:-1] for f in model.weights if f.endswith(".") and len(f) > 4]
    words = [w for w in words if _score(model, [w])[0] >= 0.3]
    assert len(words) >= 8
    missed = [(w, t) for w in words for t in _spelled(w) if _score(model, [f"the text before. {t}. and after"])[0] < 0.3]
    assert not missed


def test_other_scripts_and_look_alikes(model):
    word = max((f[:-1] for f in model.weights if f.endswith(".") and set("aeo") & set(f) and len(f) > 5), key=lambda w: model.weights[f"{w}."])
    plain = _score(model, [word])[0]
    assert plain >= 0.3
    borrowed = word.translate(str.maketrans("aeo", "аео"))
    assert borrowed != word and _score(model, [borrowed])[0] == plain
    assert toxicity.plain("привет").strip(b"? ") == b""  # words wholly of another script stay what they are


def test_clean_spelled_words_stay_clean(model, spark):
    docs = read_table(spark, SF, "documents").join(read_table(spark, SF, "labels").where("toxic = 0"), "doc_id")
    texts = [r.text for r in docs.select("text").limit(150).collect()]
    spelled = [" ".join(t[:400].replace(" ", "")) for t in texts]
    plain = np.array(_score(model, texts)) >= 0.3
    assert (np.array(_score(model, spelled)) >= 0.3).sum() <= plain.sum() + 3


def test_long_spaced_runs_take_linear_time(model):
    rng = np.random.default_rng(3)
    restorer = model.restorer()
    seconds = []
    for n in (20_000, 200_000):
        text = " ".join(rng.choice(list("etaoinshr1@dlu"), n))
        start = time.perf_counter()
        restorer.restore(text)
        seconds.append(time.perf_counter() - start)
    assert seconds[1] < 20 * seconds[0] and seconds[1] < 15
    assert restorer.restore("a1" * 100_000)
    assert all(len(k) <= toxicity.REMEMBERED for k in restorer.memory)


def test_spaced_lattice_against_all_paths():
    """The best path through spaced-out letters against every path, with known words and without."""
    text = "you are a dimwit and the dim lot sat at a table " * 20
    counts = np.bincount(toxicity._trigrams(b"   " + text.encode() + b"   "), minlength=toxicity.SYMBOLS**3)
    costs = toxicity.character_costs(counts)
    words = {w: -math.log(n / 12) for w, n in {"a": 3, "dim": 2, "dimwit": 2, "are": 2, "sat": 1, "at": 2}.items()}
    for known in ({}, words):
        restorer = toxicity.Restorer(costs, known)
        for letters, wide in (("adim", ()), ("areadim", (2,)), ("d1mm", ()), ("sat@t", (2,)), ("aaat", ()), ("dimwit", (2,))):
            join = [toxicity.JOIN_COST * (1 + (k in wide)) for k in range(len(letters) - 1)]
            part = [0.0 if k in wide else toxicity.BREAK_COST for k in range(len(letters) - 1)]
            slots = restorer._spaced_slots(letters, join, part)
            best = min(
                restorer._price("".join(c for c, _ in path).split(" ")) + sum(p for _, p in path) for path in product(*slots)
            )
            assert restorer._likeliest(slots)[0] == pytest.approx(best)


def test_word_counts_are_exact(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "HELD_WORDS", 3)
    rows = [(i, f"Alpha béta x{i % 2} gamma alpha", "") for i in range(40)] + [(None, None, ""), (1, "q" * 50, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, word string").repartition(3)
    got = {r.word: r.n for r in toxicity.corpus_counts(docs).where("word is not null").collect()}
    assert got == {"alpha": 80, "beta": 40, "gamma": 40, "x": 40}
    assert set(toxicity.word_costs(toxicity.corpus_counts(docs), 2)) == {"alpha", "beta"}


def test_sample_holds_one_row_of_a_hot_id(spark):
    rows = [(7, f"namesake {i}") for i in range(3000)] + [(i, f"text {i}") for i in range(1000, 3000)] + [(None, "x")] * 50
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(i, i % 2) for i in range(3000)] + [(None, 1)], "doc_id long, toxic int")
    for limit in (200, 10_000):
        got = labelled_sample(docs, labels, "toxic", F.lit(True), limit).collect()
        assert len(got) <= limit and len({r.doc_id for r in got}) == len(got) and all(r.text for r in got)
    assert 7 in {r.doc_id for r in got}
