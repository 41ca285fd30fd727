"""Classes of similar texts against brute force."""

import random
import re

import pytest
from llm_data import ODD, documents, none, odd, prose

from tidegauge.llm import shingle_join
from tidegauge.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, n):
    words = WORD.findall((text or "").translate(LOWER))
    return {tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))} if words else set()


def brute(rows, n, percent):
    sets = [(i, shingles(t, n)) for i, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, (i, x) in enumerate(sets):
        for b, (j, y) in enumerate(sets[:a]):
            both = len(x & y)
            if x and i is not None and j is not None and 100 * both >= percent * len(x | y):
                root[find(a)] = find(b)
    low = {}
    for a, (i, x) in enumerate(sets):
        if i is not None:
            low[find(a)] = min(low.get(find(a), i), i)
    return sorted(((i, len(x), None if i is None else low[find(a)]) for a, (i, x) in enumerate(sets)), key=str)


def found(df, n, percent):
    return sorted(((r[0], r[2], r[3]) for r in shingle_join.classes(df, n, percent).collect()), key=str)


def edited(text, rng, edits):
    words = text.split()
    for _ in range(edits):
        kind, at = rng.randrange(3), rng.randrange(len(words))
        if kind == 0:
            words[at] = f"z{rng.randrange(10**6)}"
        elif kind == 1:
            del words[at]
        else:
            words.insert(at, words[rng.randrange(len(words))])
    return " ".join(words)


def corpus(seed):
    rng = random.Random(seed)
    rows = []
    for group in range(6):
        origin = prose(seed * 100 + group, rng.choice([8, 30, 120]))
        rows += [edited(origin, rng, rng.randrange(0, max(2, len(origin.split()) // 12))) for _ in range(rng.choice([3, 12, 25]))]
    line = prose(77, 12)
    rows += [f"{line} {prose(seed * 1000 + k, 30)}" for k in range(15)]
    rng.shuffle(rows)
    return [(i * 3 + 1, t) for i, t in enumerate(rows)]


@pytest.mark.parametrize("n, percent", [(3, 90), (5, 80), (1, 50), (3, 100)])
def test_classes_equal_brute_force(spark, n, percent):
    rows = corpus(n)
    assert found(documents(spark, rows), n, percent) == brute(rows, n, percent)


@pytest.mark.parametrize("n, percent", [(3, 90), (2, 60)])
def test_representative_pairs_make_the_classes(spark, n, percent):
    rows = corpus(n + 20) + [(9001, "a b c"), (9002, "A b  c"), (9003, None)]
    sets = {i: shingles(t, n) for i, t in rows}
    pairs = shingle_join.representative_pairs(documents(spark, rows), n, percent).collect()
    root = {i: i for i, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    first = {}
    for i in sorted(root):  # equal sets are one from the start, by their smallest id
        root[i] = first.setdefault(frozenset(sets[i]), i) if sets[i] else i
    assert len(pairs) == len({(r.a, r.b) for r in pairs}) > 0
    for r in pairs:
        both = len(sets[r.a] & sets[r.b])
        assert r.a < r.b and 100 * both >= percent * len(sets[r.a] | sets[r.b])
        assert (r.n_a, r.n_b) == (len(sets[r.a]), len(sets[r.b])) and root[r.a] in first.values()
        low, high = sorted((find(r.a), find(r.b)))
        root[high] = low
    assert {i: find(i) for i in root} == {i: c for i, _, c in brute(rows, n, percent)}


def test_odd_rows(spark):
    assert found(odd(spark), 3, 90) == brute(ODD, 3, 90)


def test_empty_table(spark):
    assert found(none(spark), 3, 90) == []
    assert shingle_join.one_of_each(none(spark)).collect() == []


def test_one_of_each_keeps_one_row_of_a_class(spark):
    df = odd(spark)
    kept = shingle_join.one_of_each(df)
    assert kept.columns == df.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted([1, 2, 3, 4, None, 5, 7, 8, 9], key=str)


def test_texts_of_one_id_are_judged_each(spark):
    rows = [(1, prose(1, 50)), (2, prose(2, 50)), (2, prose(1, 50)), (3, prose(2, 50))]
    assert found(documents(spark, rows), 3, 90) == brute(rows, 3, 90)
    assert [(r.doc_id, r.text == prose(1, 50)) for r in shingle_join.one_of_each(documents(spark, rows)).orderBy("doc_id").collect()] == [(1, True), (2, False)]


def test_unlinked_texts_of_one_id_all_stay(spark):
    a, b, c = (prose(k, 50) for k in (1, 2, 3))
    rows = [(7, a), (7, b), (7, ""), (7, " "), (9, b), (8, a), (5, c), (5, b), (5, c), (5, b), (6, c)]
    kept = sorted((r.doc_id, r.text) for r in shingle_join.one_of_each(documents(spark, rows)).collect())
    assert kept == sorted([(7, a), (7, ""), (7, " "), (5, b), (5, c)])


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, 90), (90, 95), (95, 100), (7, 7), (200, 200), (None, 3)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 1 for i in range(1, 41)}, 100: 90, 90: 90, 95: 90, 200: 200}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_percent_is_checked(spark):
    with pytest.raises(ValueError):
        shingle_join.classes(none(spark), percent=0)


def brute_links(rows, n, percent):
    sets = [(i, shingles(t, n)) for i, t in rows]
    linked = lambda x, y: bool(x) and 100 * len(x & y) >= percent * len(x | y)
    return sorted(((i, None if i is None else sum(1 for b, (j, y) in enumerate(sets) if b != a and j is not None and linked(x, y))) for a, (i, x) in enumerate(sets)), key=str)


@pytest.mark.parametrize("n, percent", [(3, 90), (5, 80)])
def test_every_link_is_counted(spark, n, percent):
    # Near copies of one text: links inside the group are not all with its typical members.
    rows = corpus(n + 40) + [(9001, "a b c"), (9002, "A b  c"), (9003, None), (9004, ""), (None, prose(1, 40)), (9005, prose(1, 40))]
    found = shingle_join.classes_and_links(documents(spark, rows), n, percent).collect()
    assert sorted(((r.id, r.n_links) for r in found), key=str) == brute_links(rows, n, percent)
    assert sorted(((r.id, r.n_shingles, r["class"]) for r in found), key=str) == brute(rows, n, percent)


def test_op1_pairs_no_group_of_near_copies(spark, tmp_path, monkeypatch):
    """Membership as brute force says; the members of a group of near copies are not all paired as candidates."""
    base = prose(3, 200).split()
    group = [(5000 + i, " ".join(base[:i + 10] + [f"edit{i}"] + base[i + 11 :])) for i in range(30)]
    rows = corpus(43) + group + [(9001, "a b c"), (9002, "A b  c"), (9004, "")]
    documents(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    made = []
    candidates = shingle_join._candidates
    monkeypatch.setattr(shingle_join, "_candidates", lambda *a: made.append(candidates(*a)) or made[-1])
    got = shingle_join.op1_adaptive_prefix_join(spark, str(tmp_path)).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == brute(rows, 3, 90)
    assert len({r.component_id for r in got if r.doc_id in dict(group)}) == 1
    assert sum(df.count() for df in made) < len(group) * (len(group) - 1) // 4
