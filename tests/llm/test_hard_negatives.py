"""Hard negatives against all pairs, with an index small enough to be searched in both rounds."""

import random

import numpy as np
import pytest
from compare import connect, difference
from pyspark.sql import functions as F

from __spark_entry__ import oracle_sql, queries
from kerbside.llm import hard_negatives as hn


def all_pairs(rows, every=50, positives=5, negatives=3):
    """rows: (vec_id, label, vector); identical rows once."""
    good, seen = [], set()
    for i, label, v in rows:
        if i is None or label is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        whole = tuple(int(np.floor(256.0 * x)) for x in v)
        whole = (*whole, *(0,) * (max(len(r[2] or []) for r in rows) - len(whole)))
        if (i, label, whole) not in seen:
            seen.add((i, label, whole))
            good.append((i, label, whole))
    out = []
    for i, label, v in good:
        if i % every:
            continue
        scored = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), j, other) for j, other, w in good if (j, other, w) != (i, label, v))
        for p, pos, _ in [x for x in scored if x[2] == label][:positives]:
            fits = [x for x in scored if x[2] != label and 50 * -p <= 100 * -x[0] <= 95 * -p]
            out += [(i, pos, k + 1, neg, -p, -n) for k, (n, neg, _) in enumerate(fits[:negatives])]
    return sorted(out)


def mined(frame, **options):
    found = hn.mine_hard_negatives(frame, F.col("vec_id") % options.pop("every", 50) == 0, **options)
    assert found.dtypes == [(n, t) for n, t in (x.rsplit(" ", 1) for x in hn.RESULT.split(", "))]
    return sorted(tuple(r) for r in found.collect())


def clustered(n, dim, labels, seed):
    r = np.random.default_rng(seed)
    middles = r.normal(size=(6, dim))
    x = middles[r.integers(0, 6, n)] + 0.5 * r.normal(size=(n, dim))
    x /= np.linalg.norm(x, axis=1)[:, None]
    return [(i, int(r.integers(0, labels)), v.astype(np.float32).tolist()) for i, v in enumerate(x)]


SCHEMA = "vec_id bigint, label int, embedding array<float>"


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_all_pairs_over_small_lots(spark, monkeypatch, seed):
    for name, value in (("CELL_ROWS", 12), ("LOT_ROWS", 20), ("CHUNK_ROWS", 30), ("BLOCK_ANCHORS", 16), ("SAMPLE", 200)):
        monkeypatch.setattr(hn, name, value)
    rows = clustered(900, 8, 4, seed)
    rows += [(1000 + i, 1, rows[7][2]) for i in range(70)] + [(1100 + i, 2, rows[7][2]) for i in range(70)]  # copies
    assert mined(spark.createDataFrame(rows, SCHEMA), every=10, first_rows=60) == all_pairs(rows, 10)


def test_odd_rows(spark):
    r = random.Random(5)
    rows = [(i, r.choice([0, 1, 2]), [r.choice([-1.0, -0.5, 0.0, 0.25, 0.5, 1.0]) for _ in range(r.choice([3, 4]))]) for i in range(120)]
    rows += [
        (None, 1, [1.0, 1.0]), (200, None, [1.0]), (250, 1, None), (300, 1, [1.0, None]), (350, 1, [float("nan")]),
        (400, 1, [float("inf"), 0.0]), (450, 2, []), (50, 1, [1.0, 1.0, 1.0]), (0, 0, [1.0]), rows[3], rows[3], rows[0],
    ]
    schema = "vec_id bigint, label int, embedding array<double>, lot int, score string"
    frame = spark.createDataFrame([(*x, 1, "x") for x in rows], schema)
    assert mined(frame, every=10) == all_pairs(rows, 10)


def test_large_components(spark):
    rows = [(i, i % 2, [float((i * 37 % 11 - 3) * 10**6), 3e5 * (i % 5)]) for i in range(40)]
    frame = spark.createDataFrame(rows, "vec_id bigint, label int, embedding array<double>")
    assert mined(frame, every=4) == all_pairs(rows, 4)


def test_no_rows(spark):
    assert mined(spark.createDataFrame([], SCHEMA)) == []
    assert mined(spark.createDataFrame([(50, 1, [1.0])], SCHEMA)) == []


def test_heap_order_and_bounds():
    r = np.random.default_rng(3)
    words, radii = (r.normal(size=(5, 3)), r.normal(size=(7, 4))), (r.random(5), r.random(7))
    index = hn.Index(words, radii, np.arange(35), [1] * 35)
    for _ in range(20):
        anchor = r.normal(size=7)
        cells = list(index.cells(anchor))
        assert sorted(c for c, _, _ in cells) == list(range(35))
        assert [h for _, _, h in cells] == sorted((h for _, _, h in cells), reverse=True)
        for cell, low, high in cells:
            a, b = divmod(cell, 7)
            for _ in range(5):
                step1, step2 = r.normal(size=3), r.normal(size=4)
                x = np.concatenate([
                    words[0][a] + step1 / np.linalg.norm(step1) * radii[0][a], words[1][b] + step2 / np.linalg.norm(step2) * radii[1][b],
                ])
                assert low <= anchor @ x <= high


def test_registered_query_equals_sql(spark):
    sf = "/root/testdata/sf0.01"
    assert difference(queries()["op11_hard_negatives"](spark, sf), connect(sf), oracle_sql()["op11_hard_negatives"]) is None
