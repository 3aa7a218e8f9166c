"""Winnowed decontamination against a window-by-window search."""

import hashlib
import random

import numpy as np
from plain import contamination as plain_contamination
from pyspark.sql import functions as F

from kerbside.llm import decontaminate
from kerbside.llm.common import prepare

DOCS = "doc_id long, text string, lang string, source string, n_chars long, hash long, item_id string, part int, row int"
ITEMS = "item_id long, text string, doc_id int, pos int"


def _tables(spark, docs, items):
    prepare(spark)
    return (
        spark.createDataFrame([(d, t, "en", "s", 1, 0, "", 0, 0) for d, t in docs], DOCS),
        spark.createDataFrame([(i, t, 0, 0) for i, t in items], ITEMS),
    )


def _got(spark, docs, items):
    rows = decontaminate.contamination(*_tables(spark, docs, items)).collect()
    digest = lambda ids: hashlib.sha256(",".join(ids).encode()).hexdigest()
    return sorted((r.doc_id, r.n_words, r.n_hit, r.n_items, digest(r.item_ids), r.n_hit > 0) for r in rows)


def test_equals_plain_search(spark):
    r = random.Random(2)
    word = lambda: r.choice("ab cd ef gh é1 Über 9 kl mn op qr".split())  # noqa: E731  few words: many ties and chance hits
    rare = lambda: f"w{r.randrange(10**6)}"
    items = [(i, " ".join((word if i % 2 else rare)() for _ in range(r.randint(1, 40)))) for i in range(40)]
    items += [(100, items[4][1]), (101, ""), (102, None), (103, "?! -"), (9, "The End")]
    docs = []
    for d in range(60):
        parts = []
        for _ in range(r.randint(0, 6)):
            parts.append(" ".join((word if r.random() < 0.5 else rare)() for _ in range(r.randint(0, 30))))
            own = items[r.randrange(40)][1].split()
            at = r.randrange(len(own))
            parts.append(", ".join(own[at : at + r.randint(1, 30)]).upper())
        docs.append((d, " \n".join(parts)))
    docs += [(200, None), (201, ""), (202, "THE-END"), (203, " ".join(rare() for _ in range(30_000)) + " " + items[6][1])]
    assert _got(spark, docs, items) == sorted((d, *v) for d, v in plain_contamination(docs, items).items())


def test_odd_tables(spark):
    ten = "a1 b2 c3 d4 e5 f6 g7 h8 i9 j10"
    assert _got(spark, [(1, ten)], []) == [(1, 10, 0, 0, hashlib.sha256(b"").hexdigest(), False)]
    assert _got(spark, [], [(1, ten)]) == []
    docs, items = _tables(spark, [(1, ten), (1, ten), (None, ten), (2, "a1 b2 c3 d4 e5 f6 g7 h8 i9")], [(5, ten), (None, "x")])
    got = decontaminate.contamination(docs, items).select("doc_id", "n_hit", "item_ids").collect()
    assert sorted(map(str, map(tuple, got))) == ["(1, 10, ['5'])", "(1, 10, ['5'])", "(2, 0, [])", "(None, 10, ['5'])"]
    kept = decontaminate.drop_contaminated(docs, items)
    assert [r.doc_id for r in kept.collect()] == [2] and kept.columns == docs.columns
    assert decontaminate.drop_contaminated(docs.limit(0), items).count() == 0
    assert decontaminate.drop_contaminated(docs, items.limit(0)).count() == 4


def test_every_shared_window_shares_a_fingerprint():
    rng = np.random.default_rng(1)
    for _ in range(200):
        shared = rng.integers(0, 4, decontaminate.WINDOW).astype(np.uint64)
        sides = [
            np.concatenate([rng.integers(0, 4, rng.integers(0, 9)).astype(np.uint64), shared, rng.integers(0, 4, 5).astype(np.uint64)])
            for _ in range(2)
        ]
        prints = [set(decontaminate.fingerprint_places(s, np.zeros(len(s), dtype=int))[1].tolist()) for s in sides]
        assert prints[0] & prints[1]


def test_query_digest_is_sorted_as_strings(spark):
    ten = "a1 b2 c3 d4 e5 f6 g7 h8 i9 j10"
    docs, items = _tables(spark, [(1, ten)], [(10, ten), (9, ten)])
    row = decontaminate.contamination(docs, items).select(F.sha2(F.concat_ws(",", "item_ids"), 256)).first()
    assert row[0] == hashlib.sha256(b"10,9").hexdigest()


def test_clean_rows_stay_beside_contaminated_namesakes(spark):
    ten = "a1 b2 c3 d4 e5 f6 g7 h8 i9 j10"
    docs, items = _tables(spark, [(None, ten), (None, "clean one"), (None, None), (7, "clean two"), (7, ten)], [(5, ten)])
    kept = decontaminate.drop_contaminated(docs, items)
    assert sorted(str((r.doc_id, r.text)) for r in kept.collect()) == ["(7, 'clean two')", "(None, 'clean one')", "(None, None)"]
