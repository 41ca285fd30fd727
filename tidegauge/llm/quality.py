"""Quality classifier: positive-unlabelled learning with the non-negative risk.

Trusted positives are the texts labelled good; the unlabelled ones are web text of both
kinds: all documents that may be fit on, whatever their label. With the share ``prior`` of good texts among all, the risk of a classifier is

    prior * R_p(+1) + max(0, R_u(-1) - prior * R_p(-1)),

which needs no negatives; without the maximum a flexible model would push the second part
below zero by overfitting (Kiryo et al., 2017). When it is below zero, a step goes the other
way. The prior is estimated from scores on rows that the scorer hasn't seen: the smallest
ratio of the shares of unlabelled and of positive texts above a threshold (Garg et al.,
2021, best bin). Labels of bad texts are never used.

The model is linear over hashed runs of three bytes and over marks for how often words
repeat close by. The fit runs on the driver, on at most
``max_rows`` different texts of each kind chosen by the hash of their id (a documented bound: one
text of each id first, others where there is room); features are made by Spark tasks, and scoring is one narrow pass over all texts.

Defined cases: null and empty texts have no features and get the score of the bias alone;
every row is scored by itself, rows that repeat id and text are fit on once; an id is a trusted positive if any of its labels is 1; null
labels and ids count as unlabelled; a document with a label in the held-out fold is in neither
set; without positives the score is 0, without unlabelled texts it is 1; very long texts
are scored whole; equal hashes of ids are ordered by the ids when a sample is chosen; an empty
table has no scores; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.features import Part, Rows, byte_trigrams, collected, held_out, sampled_texts, scored, sigmoid, versions, with_texts
from tidegauge.session import stored

BITS = 14
MAX_ROWS = 8_000


@dataclass
class LinearModel:
    bias: float
    weights: np.ndarray
    prior: float

    def margin(self, rows: Rows) -> np.ndarray:
        return self.bias + rows.total(self.weights[rows.index] * rows.value)

    def score(self, rows: Rows) -> np.ndarray:
        return sigmoid(self.margin(rows))


def _gradient(rows: Rows, error: np.ndarray, bits: int) -> tuple[np.ndarray, float]:
    return np.bincount(rows.index, error[rows.row()] * rows.value, 1 << bits), float(error.sum())


def _descend(model: LinearModel, gradients, steps: int, rate: float, l2: float) -> LinearModel:
    """Adam over ``gradients(model, step)``."""
    m, v = np.zeros(len(model.weights) + 1), np.zeros(len(model.weights) + 1)
    for t in range(1, steps + 1):
        g, gb = gradients(model, t)
        g = np.append(g + l2 * model.weights, gb)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        step = rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        model.weights = model.weights - step[:-1]
        model.bias -= step[-1]
    return model


def _batches(n: int, size: int, rng: np.random.Generator):
    while True:
        order = rng.permutation(n)
        for a in range(0, n, size):
            yield order[a : a + size]


def _margins(model: LinearModel, rows: Rows | Part) -> np.ndarray:
    """The margins of all rows, some at a time."""
    chunks = [model.margin(rows.take(np.arange(a, min(a + 1000, len(rows))))) for a in range(0, len(rows), 1000)]
    return np.concatenate([np.zeros(0), *chunks])


def estimated_prior(positive: Rows | Part, unlabelled: Rows | Part, bits: int = BITS, steps: int = 200, seed: int = 11) -> float:
    """The share of positives among the unlabelled, by the best bin of a scorer fit on the other half."""
    rng = np.random.default_rng(seed)
    half_p, half_u = rng.permutation(len(positive)), rng.permutation(len(unlabelled))
    seen_p, seen_u = half_p[: len(half_p) // 2], half_u[: len(half_u) // 2]
    if not len(seen_p) or not len(seen_u):
        return 0.5
    batches_p, batches_u = _batches(len(seen_p), 512, rng), _batches(len(seen_u), 512, rng)

    def gradients(model, _):
        p, u = positive.take(seen_p[next(batches_p)]), unlabelled.take(seen_u[next(batches_u)])
        gp, bp = _gradient(p, (sigmoid(model.margin(p)) - 1) / len(p), bits)
        gu, bu = _gradient(u, sigmoid(model.margin(u)) / len(u), bits)
        return gp + gu, bp + bu

    scorer = _descend(LinearModel(0.0, np.zeros(1 << bits), 0.5), gradients, steps, 0.05, 1e-4)
    p = np.sort(_margins(scorer, positive.part(half_p[len(half_p) // 2 :])))
    u = np.sort(_margins(scorer, unlabelled.part(half_u[len(half_u) // 2 :])))
    cuts = np.quantile(p, np.linspace(0, 0.9, 91))
    above_p = 1 - np.searchsorted(p, cuts) / len(p)
    above_u = 1 - np.searchsorted(u, cuts) / len(u)
    slack = np.sqrt(np.log(100) / (2 * len(p))) + np.sqrt(np.log(100) / (2 * len(u)))
    best = np.argmin((above_u + slack) / above_p)  # the bin that is best with a margin for chance
    return float(np.clip(above_u[best] / above_p[best], 0.02, 0.98))


def risk_gradient(model: LinearModel, p: Rows, u: Rows, prior: float, bits: int) -> tuple[np.ndarray, float]:
    """The direction of the non-negative risk, by weights and by bias; where its second part is negative, against that part."""
    margin_p, margin_u = model.margin(p), model.margin(u)
    as_bad = np.logaddexp(0, margin_u).mean() - prior * np.logaddexp(0, margin_p).mean()
    bad_p, bad_u = -prior * sigmoid(margin_p) / len(p), sigmoid(margin_u) / len(u)
    if as_bad < 0:  # overfit: climb on this part alone
        gp, bp = _gradient(p, -bad_p, bits)
        gu, bu = _gradient(u, -bad_u, bits)
    else:
        gp, bp = _gradient(p, prior * (sigmoid(margin_p) - 1) / len(p) + bad_p, bits)
        gu, bu = _gradient(u, bad_u, bits)
    return gp + gu, bp + bu


def fit(positive: Rows | Part, unlabelled: Rows | Part, bits: int = BITS, steps: int = 500, rate: float = 0.05, l2: float = 1e-5, seed: int = 5) -> LinearModel:
    """Minimise the non-negative risk with the logistic loss."""
    if not len(positive) or not len(unlabelled):
        return LinearModel(-60.0 if len(unlabelled) or not len(positive) else 60.0, np.zeros(1 << bits), 0.5)
    prior = estimated_prior(positive, unlabelled, bits)
    rng = np.random.default_rng(seed)
    batches_p, batches_u = _batches(len(positive), 512, rng), _batches(len(unlabelled), 512, rng)

    def gradients(model, _):
        return risk_gradient(model, positive.take(next(batches_p)), unlabelled.take(next(batches_u)), prior, bits)

    return _descend(LinearModel(float(np.log(prior / (1 - prior))), np.zeros(1 << bits), prior), gradients, steps, rate, l2)


def fit_on(documents: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, key: str = "doc_id", text: str = "text", label: str = "quality") -> LinearModel:
    """Fit on at most ``max_rows`` trusted positives outside the held-out fold and as many documents regardless of their label."""
    known = labels.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("id")).agg(F.max(label).alias("quality"))
    texts = versions(documents, key, text)
    trusted = sampled_texts(texts.join(known.where((F.col("quality") == 1) & ~held_out("id")), "id", "left_semi"), max_rows)
    unlabelled = sampled_texts(texts.join(known.where(F.col("quality").isNotNull() & held_out("id")), "id", "left_anti"), max_rows)
    sample = stored(trusted.withColumn("label", F.lit(1)).union(unlabelled.withColumn("label", F.lit(0))), "sample")
    rows, marks = collected(with_texts(texts, sample), byte_trigrams, BITS)
    return fit(Part(rows, np.flatnonzero(marks == 1)), Part(rows, np.flatnonzero(marks == 0)))


def score_quality(documents: DataFrame, model: LinearModel, text: str = "text", to: str = "score") -> DataFrame:
    """``documents`` and the score (0 to 1) of every row, in the column ``to``."""
    shared = documents.sparkSession.sparkContext.broadcast(model)
    return scored(documents, text, byte_trigrams, BITS, lambda rows: shared.value.score(rows), to)


def op9_positive_unlabelled(spark, sf_dir: str) -> DataFrame:
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = fit_on(documents, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score_quality(documents.select("doc_id", "text"), model).select(
        "doc_id",
        held_out("doc_id").alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
    )
