"""The two classifiers: what they can learn, held-out accuracy, odd rows."""

import zlib

import numpy as np
import pytest
from llm_data import documents, none, odd, prose

from tidegauge.llm import quality, toxicity
from tidegauge.llm.features import Rows, byte_trigrams, hashed_terms

SF = "/root/testdata/sf0.1"


def rows_of(sets, value=1.0):
    first = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
    index = np.array([x for s in sets for x in sorted(s)], np.int32)
    return Rows(index, np.full(len(index), value, np.float32), first)


def test_pairs_are_learned():
    """Toxic only where an insult (1) and a group (2) meet: no sum of weights over balanced data can tell that."""
    rng = np.random.default_rng(1)
    sets, labels = [], []
    for _ in range(3000):
        a, b = rng.random(2) < 0.5
        sets.append({*([1] if a else []), *([2] if b else []), int(rng.integers(10, 60))})
        labels.append(float(a == b))  # both or none: neither term alone says anything
    rows, labels = rows_of(sets), np.array(labels)
    model = toxicity.fit(rows, labels, bits=6, factors=4, steps=1500)
    assert ((model.score(rows) > 0.5) == labels).mean() > 0.95


def test_machine_equals_a_loop_over_pairs():
    rng = np.random.default_rng(3)
    model = toxicity.FactorizationMachine(0.3, rng.normal(size=16).astype(np.float32), rng.normal(size=(16, 3)).astype(np.float32))
    sets = [{1, 4, 9}, set(), {0}, {2, 3, 5, 7, 11, 13}]
    rows = rows_of(sets, 0.7)
    for got, own in zip(model.margin(rows), (sorted(s) for s in sets), strict=True):
        want = model.bias + sum(0.7 * model.weights[i] for i in own)
        want += sum(0.49 * float(model.vectors[i] @ model.vectors[j]) for a, i in enumerate(own) for j in own[a + 1 :])
        assert abs(got - want) < 1e-5


def test_risk_gradients_equal_differences():
    """The descent direction is that of the risk, and turns on its second part once that is negative."""
    rng = np.random.default_rng(4)
    positive, unlabelled = (rows_of([{int(x) for x in rng.integers(0, 16, 5)} for _ in range(40)], 0.4) for _ in range(2))
    for prior, scale in ((0.4, 0.5), (0.95, 3.0)):
        model = quality.LinearModel(0.1, scale * rng.normal(size=16), prior)

        def parts(weights, bias):
            p, u = (rows.total(weights[rows.index] * rows.value) + bias for rows in (positive, unlabelled))
            return prior * np.logaddexp(0, -p).mean(), np.logaddexp(0, u).mean() - prior * np.logaddexp(0, p).mean()

        good, bad = parts(model.weights, model.bias)
        risk = (lambda w, b: -parts(w, b)[1]) if bad < 0 else (lambda w, b: sum(parts(w, b)))  # noqa: B023
        g, gb = quality.risk_gradient(model, positive, unlabelled, prior, 4)
        for k in range(16):
            step = np.zeros(16)
            step[k] = 1e-5
            assert abs((risk(model.weights + step, model.bias) - risk(model.weights - step, model.bias)) / 2e-5 - g[k]) < 1e-6
        assert abs((risk(model.weights, model.bias + 1e-5) - risk(model.weights, model.bias - 1e-5)) / 2e-5 - gb) < 1e-6


def test_errors_of_both_kinds_are_bounded(spark):
    documents_, labels_ = (spark.read.parquet(f"{SF}/{name}.parquet") for name in ("documents", "labels"))
    model = quality.fit_on(documents_, labels_)
    scores = quality.score_quality(documents_.select("doc_id", "text"), model).join(labels_, "doc_id").toPandas()
    held = scores[[zlib.crc32(str(i).encode()) % 4 == 2 for i in scores["doc_id"]]].dropna(subset=["quality"])
    good, bad = held[held["quality"] == 1]["score"], held[held["quality"] == 0]["score"]
    assert (good < 0.7).mean() < 0.02 and (bad >= 0.7).mean() < 0.3
    assert abs(model.prior - (held["quality"] == 1).mean()) < 0.08


def test_one_kind_of_label_only():
    rows = rows_of([{1}, {2}])
    assert (toxicity.fit(rows, np.zeros(2), bits=4).score(rows) < 1e-6).all()
    assert (toxicity.fit(rows, np.ones(2), bits=4).score(rows) > 1 - 1e-6).all()
    assert (quality.fit(rows_of([]), rows, bits=4).score(rows) < 1e-6).all()


def test_prior_and_non_negative_risk():
    rng = np.random.default_rng(2)
    good = lambda: {int(x) for x in rng.integers(0, 30, 8)}
    bad = lambda: {int(x) for x in rng.integers(25, 60, 8)}
    positive = rows_of([good() for _ in range(2000)], 0.35)
    kinds = rng.random(3000) < 0.7
    unlabelled = rows_of([good() if k else bad() for k in kinds], 0.35)
    model = quality.fit(positive, unlabelled, bits=6)
    assert abs(model.prior - 0.7) < 0.08
    assert ((model.score(unlabelled) > 0.5) == kinds).mean() > 0.95


def test_features_of_odd_texts():
    data, bounds = np.zeros(0, np.uint8), np.zeros(4, np.int64)
    for extract in (hashed_terms, byte_trigrams):
        assert len(extract(data, bounds, 8)) == 3
        assert not len(extract(data, bounds, 8).index)


@pytest.mark.parametrize("module, query, label", [(toxicity, "op2_factorization_machine", "toxic"), (quality, "op9_positive_unlabelled", "quality")])
def test_held_out_accuracy(spark, module, query, label):
    scores = getattr(module, query)(spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id", "left").toPandas()
    assert len(scores) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert scores["score"].between(0, 1).all()
    got = scores[scores["held_out"] & scores[label].notna()]
    y, s = got[label].to_numpy(), got["score"].to_numpy()
    auc = (s[y == 1][:, None] > s[y == 0][None]).mean()
    assert len(got) > 600 and auc > 0.95


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_odd_rows(spark):
    marks = labels(spark, [(5, 1, 1), (5, 0, 0), (7, 1, 0), (8, 0, None), (None, 1, 1), (9, None, 1)])
    for df in (odd(spark), none(spark)):
        for module, fit, score in ((toxicity, "fit_on", "score_toxicity"), (quality, "fit_on", "score_quality")):
            model = getattr(module, fit)(df, marks)
            out = getattr(module, score)(df, model).collect()
            assert len(out) == df.count()
            assert all(0 <= r.score <= 1 for r in out)
    unlabelled = toxicity.fit_on(odd(spark), labels(spark, []))
    out = toxicity.score_toxicity(odd(spark), unlabelled, to="p")
    assert "p" in out.columns and all(r.p < 1e-6 for r in out.collect())


def test_a_hot_id_does_not_fill_the_sample(spark, monkeypatch):
    pairs = [(1, prose(1, 30))] * 40 + [(2, prose(k, 30)) for k in range(100, 140)] + [(k, prose(k, 30)) for k in range(3, 9)]
    pairs += [(11, prose(1, 30))] * 40 + [(12, prose(k, 30)) for k in range(200, 240)] + [(None, prose(k, 30)) for k in (300, 301, 301)]
    marks = labels(spark, [(k, 1, k % 2) for k in range(1, 10)])
    seen = {}
    for module in (toxicity, quality):
        def watched(texts, extract, bits, module=module, collected=module.collected):
            seen[module] = [(r.id, r.text, r.label) for r in texts.collect()]
            return collected(texts, extract, bits)

        monkeypatch.setattr(module, "collected", watched)
    for most in (5, 500):
        toxicity.fit_on(documents(spark, pairs), marks, most)
        quality.fit_on(documents(spark, pairs), marks, most)
        trusted, rest = ([x for x in seen[quality] if x[2] == mark] for mark in (1, 0))
        for rows in (seen[toxicity], trusted, rest):
            assert len(rows) == len(set(rows)) <= most
        if most == 5:
            assert len({i for i, _, _ in trusted}) == 5 and len(rest) == 5
            assert len({(i, t if i is None else "") for i, t, _ in rest}) >= 4
        else:
            fit_ids = {i for i, _ in pairs if i in range(1, 10) and zlib.crc32(str(i).encode()) % 4 != 2}
            assert {(i, t) for i, t, _ in trusted} == {(i, t) for i, t in pairs if i in fit_ids}
            assert {(i, t) for i, t, _ in rest} >= {(i, t) for i, t in pairs if i in (11, 12, None)}


def test_labels_may_cover_every_document(spark):
    pairs = [(k, prose(k, 30) if k % 2 else " ".join(["buy now !!!"] * 15) + f" {k}") for k in range(400)]
    df = documents(spark, pairs)
    model = quality.fit_on(df, labels(spark, [(k, k % 2, 0) for k in range(400)]))
    scores = {r.doc_id: r.p for r in quality.score_quality(df, model, to="p").collect()}
    assert all((p > 0.5) == (k % 2 == 1) for k, p in scores.items())
