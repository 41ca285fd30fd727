"""The Merkle manifest against a plain recursion."""

from hashlib import sha256

import pytest
from llm_data import documents, none, odd
from pyspark.sql import functions as F

from tidegauge.llm import manifest as m

COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]


def digest(text):
    return sha256(text.encode()).hexdigest()


def leaf_of(values):
    return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(leaves):
    """The root, and the proof of each leaf as (before, after) from the leaf's level up."""
    level, proofs, under = list(leaves), [[] for _ in leaves], [[i] for i in range(len(leaves))]
    while len(level) > 1:
        above, above_under = [], []
        for a in range(0, len(level), 2):
            run = level[a : a + 2]
            for k, nodes in enumerate(under[a : a + 2]):
                for i in nodes:
                    proofs[i].append((run[0] if k else None, run[1] if not k and len(run) > 1 else None))
            above.append(digest("".join(run)))
            above_under.append(sum(under[a : a + 2], []))
        level, under = above, above_under
    return level[0], proofs


def brute(rows):
    """(doc_id, leaf, subroot, root, proof) of rows (doc_id, source, lang, n_chars, text)."""
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append((r[0], leaf_of(r)))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    made = {g: tree([leaf for _, leaf in sorted(groups[g], key=lambda x: (x[0] is not None, x))]) for g in names}
    if not names:
        return []
    root, above = tree([made[g][0] for g in names])
    out = []
    for g, more in zip(names, above, strict=True):
        for (key, leaf), proof in zip(sorted(groups[g], key=lambda x: (x[0] is not None, x)), made[g][1], strict=True):
            out.append((key, leaf, made[g][0], root, proof + more))
    return sorted(out, key=str)


def found(df, **options):
    got = m.manifest(df, COLUMNS, "lang", "doc_id", **options)
    return sorted(((r.key, r.leaf, r.subroot, r.root, [tuple(x) for x in r.proof]) for r in got.collect()), key=str)


def table(spark, sizes):
    rows, key = [], 0
    for lang, n in sizes.items():
        for k in range(n):
            key += 1
            rows.append((key * 7 % 1009, f"s{k % 3}", lang, k, f"text é {k}"))
    return spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string"), rows


@pytest.mark.parametrize("levels", [1, 2, 3, 12])
def test_equals_plain_recursion(spark, levels):
    df, rows = table(spark, {None: 5, "": 1, "de": 33, "en": 64, "é": 17, "z": 2})
    assert found(df, levels=levels) == brute(rows)


@pytest.mark.parametrize("sizes", [{"en": 1}, {None: 1}, {"a": 1, "b": 1, "c": 1}, {"en": 9}])
def test_small_trees(spark, sizes):
    df, rows = table(spark, sizes)
    assert found(df, levels=2) == brute(rows)


def test_odd_rows(spark):
    for df in (odd(spark), none(spark), documents(spark, [(3, "x")] * 40 + [(None, "y")] * 9)):
        rows = [tuple(r) for r in df.select(*COLUMNS).collect()]
        assert found(df, levels=3) == brute(rows)


def test_proofs_tell_changed_rows(spark):
    df, rows = table(spark, {"a": 20, "b": 7})
    claim = m.leaf_digest("doc_id", "source", "lang", F.col("n_chars") + F.when(F.col("doc_id") % 5 == 0, 1).otherwise(0), "text")
    got = m.manifest(df, COLUMNS, "lang", "doc_id", {"claim": claim}).withColumn("right", m.folded("claim", "proof") == F.col("root")).collect()
    assert len(got) == len(rows) and all(r.right == (r.key % 5 != 0) for r in got)


def test_siblings_are_those_of_the_proof(spark):
    df, _ = table(spark, {"a": 6, "b": 3})
    for r in m.manifest(df, COLUMNS, "lang", "doc_id").withColumn("joined", m.siblings("proof")).collect():
        assert r.joined == "".join((x.before or "") + (x.after or "") for x in r.proof)


def test_carried_names_are_checked(spark):
    with pytest.raises(ValueError):
        m.manifest(none(spark), COLUMNS, "lang", "doc_id", {"proof": F.lit(1)})
