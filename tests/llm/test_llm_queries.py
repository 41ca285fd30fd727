"""Registered queries against their SQL, and the pipeline."""

import hashlib

import pytest
from llm_data import documents, none, odd, prose
from oracle_check import connection, spark_rows, sql_rows

import corpus_pipeline
from tidegauge.llm import registry

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(registry.SQL))
def test_query_matches_sql(spark, name):
    got = spark_rows(registry.QUERIES[name](spark, SF))
    assert got == sql_rows(connection(SF), registry.SQL[name])
    assert got[1]


@pytest.mark.parametrize("number", range(1, 14))
def test_one_query_for_each_operator(number):
    assert len([n for n in registry.QUERIES if n.startswith(f"op{number}_")]) == 1


def test_digests_of_secrets(spark):
    for r in registry.QUERIES["op6_blob_ledger"](spark, SF).collect():
        base = [x for x in r.spans.split(",") if x.split(":")[0] in ("assign", "access", "hex")]
        assert r.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert r.n_assign + r.n_access + r.n_hex == len(base)


def test_pieces_are_lossless(spark):
    rows = registry.QUERIES["op4_piece_sampling"](spark, SF)
    assert rows.count() == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert rows.where("not lossless or n_pieces = 0").count() == 0


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = docs.count()
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, docs, SF)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert after.schema.simpleString() == docs.schema.simpleString()
        after = after.cache()
        assert 0 < after.count() <= kept
        docs, kept = after, after.count()
    assert docs.where("lossless").count() == kept
    assert kept > 100


def test_stages_bear_odd_tables(spark):
    for docs in (odd(spark), none(spark)):
        for _, stage in corpus_pipeline.STAGES:
            assert stage(spark, docs, SF).count() <= docs.count()


def test_planted_documents_go_and_clean_ones_stay(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    item = spark.read.parquet(f"{SF}/benchmark.parquet").where("length(text) > 200").orderBy("item_id").first().text
    clean = [prose(700 + k, 120, 5000) for k in range(4)]
    near = clean[0].split()
    near[60] = "changed"
    planted = [(900_000 + i, t) for i, t in enumerate([*clean, clean[1], " ".join(near), f"before {item} after", f"{clean[3]} password=hunter2hunter2 end"])]
    table = docs.where("false").unionByName(documents(spark, planted).select(docs.columns))
    once = corpus_pipeline.near_duplicates(spark, table, SF)
    assert sorted(r.doc_id for r in once.collect()) == [900_000, 900_001, 900_002, 900_003, 900_006]
    left = corpus_pipeline.benchmark_free(spark, table, SF)
    assert sorted(r.doc_id for r in left.collect()) == [900_000 + k for k in range(8) if k != 6]
    kept = {r.doc_id: r for r in corpus_pipeline.secrets(spark, table, SF).collect()}
    assert len(kept) == 8 and "hunter2" not in kept[900_007].text and kept[900_007].n_chars == len(kept[900_007].text)
    assert all(kept[i].text == t for i, t in planted[:7])


def test_rows_without_id_are_judged(spark):
    a, b, c = (prose(k, 50) for k in (1, 2, 3))
    item = spark.read.parquet(f"{SF}/benchmark.parquet").orderBy("item_id").first().text
    rows = [(None, a), (None, a), (None, f"{a} more"), (4, b), (None, b), (None, c), (None, c), (None, None), (None, None), (None, item), (5, "x " + item)]
    kept = corpus_pipeline.near_duplicates(spark, documents(spark, rows), SF).collect()
    assert sorted(((r.doc_id, r.text) for r in kept if r.text not in (a, f"{a} more")), key=str) == sorted([(4, b), (None, c), (None, None), (None, None), (5, "x " + item)], key=str)
    assert len(kept) == 6
    left = corpus_pipeline.benchmark_free(spark, documents(spark, rows), SF).collect()
    assert sorted(((r.doc_id, r.text) for r in left), key=str) == sorted(rows[:-2], key=str)
