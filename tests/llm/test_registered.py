"""The registered queries over whole small tables, against SQL or brute force."""

import re

from compare import connect, difference
from plain import near_vectors, simhash_groups

from __spark_entry__ import oracle_sql, queries

SF = "/root/testdata/sf0.001"


def test_names():
    names = [n for n in queries() if n.startswith("op")]
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in names) == list(range(1, 14))
    assert "pipeline" in queries() and set(oracle_sql()) <= set(queries())


def test_decontamination_equals_sql(spark):
    assert difference(queries()["op4_decontamination"](spark, SF), connect(SF), oracle_sql()["op4_decontamination"]) is None


def test_simhash_equals_all_pairs(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = queries()["op8_simhash_dedup"](spark, SF).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in got} == simhash_groups(docs)


def test_embeddings_equal_all_pairs(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "label", "embedding").collect()]
    got = queries()["op1_embedding_dedup"](spark, SF).collect()
    assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got} == near_vectors(rows)


def test_one_row_per_row(spark):
    for name, table in (
        ("op2_url_filter", "pages"), ("op5_mixing", "documents"), ("op6_lm_scoring", "documents"), ("op7_html_extraction", "pages"),
        ("op9_license_scan", "documents"),
    ):
        assert queries()[name](spark, SF).count() == spark.read.parquet(f"{SF}/{table}.parquet").count()


def test_licences_of_the_tables(spark):
    """Documents with a line that is one of the notices, and no others, have its family."""
    from kerbside.llm.license_scan import TEMPLATES

    family = {text: name for name, text in TEMPLATES}
    docs = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    want = {i: ",".join(sorted({family[x] for x in t.split("\n") if x in family})) for i, t in docs.items()}
    got = {r.doc_id: r.families for r in queries()["op9_license_scan"](spark, "/root/testdata/sf0.01").collect()}
    assert got == want and sum(map(bool, want.values())) > 20
