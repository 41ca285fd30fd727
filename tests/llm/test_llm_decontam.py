"""Phrase and proximity matches against brute force."""

import random
import re

import duckdb
from llm_data import LONG, documents, none, odd, prose

from oracle_check import spark_rows, sql_rows

from tidegauge.llm import decontam

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(docs, items, window=13):
    phrases = []
    for i, t in items:
        w = words(t)
        phrases += [(i, w[k : k + window]) for k in range(max(1, len(w) - window + 1))] if w else []
    out = []
    for i, t in docs:
        w, hit, got = words(t), set(), set()
        for item, p in phrases:
            for s in range(len(w) - len(p) + 1):
                if w[s : s + len(p)] == p:
                    hit.update(range(s, s + len(p)))
                    got.add(str(item)) if item is not None else None
        out.append((i, len(w), len(hit), sorted(got), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


def found(docs, items):
    rows = decontam.contamination(docs, items).collect()
    return sorted(((r.doc, r.n_words, r.n_hit, r["items"], r.contaminated) for r in rows), key=str)


def benchmark(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], "item_id long, text string, term string, doc string")


def test_contamination_equals_brute_force(spark):
    rng = random.Random(4)
    items = [(k, prose(500 + k, rng.choice([5, 13, 14, 40]), 6)) for k in range(12)]
    items += [(3, prose(503, 30, 6)), (20, items[0][1]), (None, prose(600, 20)), (21, ""), (22, None), (23, "K9 É"), (24, "the the the")]
    docs = [(1, None), (2, ""), (None, items[1][1]), (3, items[3][1]), (3, items[3][1]), (3, "other text"), (4, LONG + " " + items[2][1].upper())]
    for k in range(40):
        picked = [t for _, t in rng.sample(items, 3) if t]
        docs.append((100 + k, " ".join([prose(k, rng.choice([0, 10, 300]), 6), picked[0][: rng.randrange(5, 400)], "- The THE, the", *picked[1:]])))
    docs.append((200, "k9 é x"))
    assert found(documents(spark, docs), benchmark(spark, items)) == brute(docs, items)


def test_odd_and_empty_tables(spark):
    items = [(1, prose(1, 40)), (2, "word")]
    from llm_data import ODD

    assert found(odd(spark), benchmark(spark, items)) == brute(ODD, items)
    assert found(none(spark), benchmark(spark, items)) == []
    assert all(not r[2] for r in found(odd(spark), benchmark(spark, [])))
    left = decontam.uncontaminated(odd(spark), benchmark(spark, items))
    assert left.columns == odd(spark).columns
    assert sorted((r.doc_id for r in left.collect()), key=str) == sorted([1, 2, 3, None, 7, 8, 9], key=str)


def test_proximity_equals_brute_force(spark):
    rng = random.Random(8)
    docs = [(k, " ".join(rng.choice("abcdefgh") for _ in range(60))) for k in range(20)]
    queries = [(1, ["a", "b"]), (2, ["c", "d", "e", "f"]), (3, ["h"]), (4, ["a", "zz"]), (5, ["b", "b", "g"])]
    within = 5
    want = set()
    for k, t in docs:
        w = t.split()
        for q, terms in queries:
            for s in range(len(w)):
                if w[s] not in terms:
                    continue
                seen = set()
                for e in range(s, min(len(w), s + within)):
                    if w[e] in terms:
                        seen.add(w[e])
                    if seen == set(terms):
                        want.add((q, k, s, e))
                        break
    asked = spark.createDataFrame(queries, "query_id long, terms array<string>")
    texts = decontam._texts(documents(spark, docs), "doc_id", "text")
    got = decontam.proximity_matches(texts, asked, within).collect()
    assert {(r.query_id, r.doc, r.start, r.end) for r in got} == want and len(got) == len(want)


def test_query_and_sql_judge_rows_without_id(spark, tmp_path):
    item = prose(1, 20)
    rows = [(None, item), (None, "other " + item + " words"), (None, None), (1, item), (1, "clean"), (2, item[:20])]
    documents(spark, rows).select("doc_id", "text").write.parquet(f"{tmp_path}/t/documents.parquet")
    spark.createDataFrame([(5, item), (None, "clean")], "item_id long, text string").write.parquet(f"{tmp_path}/t/benchmark.parquet")
    names, got = spark_rows(decontam.op5_positional_index(spark, f"{tmp_path}/t"))
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{tmp_path}/t/{name}.parquet/*.parquet')")
    assert (names, got) == sql_rows(con, decontam.OP5_SQL)
    assert sorted((str(r[1]), r[3]) for r in got) == [("1", 1), ("1", 20), ("2", 0), ("None", 0), ("None", 20), ("None", 20)]
