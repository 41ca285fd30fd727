"""Toxicity: a factorisation machine over hashed terms.

Besides a weight for each term, every term has a short vector, and each pair of terms in a
text adds the product of their vectors: an insult next to the mention of a group counts for
more than both alone, which a sum of weights can't express (Rendle, Factorization Machines,
2010). The sum over all pairs costs no more than the sum over the terms.

The fit runs on the driver, on at most ``max_rows`` different labelled texts chosen by the hash of
their id (a documented bound: one text of each id first, others where there is room); features are made by Spark tasks. Scoring is one narrow pass
over all texts, with a model of fixed size broadcast to the tasks.

Defined cases: null and empty texts have no terms and get the score of the bias alone;
every row is scored by itself, rows that repeat id and text are fit on once; of several labels of
an id the largest counts, null labels and ids don't; without any label of either kind the
score is 0; very long texts are scored whole; equal hashes of ids are ordered by the ids when a
sample is chosen; an empty table has no scores and makes the model without labels; other
columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.features import Rows, collected, hashed_terms, held_out, sampled_texts, scored, sigmoid, versions, with_texts
from tidegauge.session import stored

BITS = 18
FACTORS = 6
MAX_ROWS = 16_000


@dataclass
class FactorizationMachine:
    bias: float
    weights: np.ndarray
    vectors: np.ndarray

    def margin(self, rows: Rows) -> np.ndarray:
        scaled = self.vectors[rows.index] * rows.value[:, None]
        sums = rows.total(scaled)
        pairs = 0.5 * ((sums * sums).sum(1) - rows.total((scaled * scaled).sum(1)))
        return self.bias + rows.total(self.weights[rows.index] * rows.value) + pairs

    def score(self, rows: Rows) -> np.ndarray:
        return sigmoid(self.margin(rows))


def fit(rows: Rows, labels: np.ndarray, bits: int = BITS, factors: int = FACTORS, steps: int = 900, rate: float = 0.4, l2: float = 1e-6, seed: int = 7) -> FactorizationMachine:
    """Logistic loss, minibatches of 256 rows, step sizes by the sum of squared gradients (Adagrad)."""
    rng = np.random.default_rng(seed)
    share = labels.mean() if len(labels) else 0.0
    if not 0 < share < 1:
        return FactorizationMachine(60.0 if share else -60.0, np.zeros(1 << bits, np.float32), np.zeros((1 << bits, 1), np.float32))
    model = FactorizationMachine(
        float(np.log(share / (1 - share))), np.zeros(1 << bits, np.float32), rng.normal(0, 0.05, (1 << bits, factors)).astype(np.float32)
    )
    grown = np.full((1 << bits, factors + 1), 1e-6, np.float32)
    bias_grown = 1e-6
    order = np.zeros(0, np.int64)
    for _ in range(steps):
        if not len(order):
            order = rng.permutation(len(rows))
        chosen, order = order[:256], order[256:]
        batch = rows.take(chosen)
        row = batch.row()
        scaled = model.vectors[batch.index] * batch.value[:, None]
        sums = batch.total(scaled)
        pairs = 0.5 * ((sums * sums).sum(1) - batch.total((scaled * scaled).sum(1)))
        margin = model.bias + batch.total(model.weights[batch.index] * batch.value) + pairs
        error = (sigmoid(margin) - labels[chosen]) / len(batch)
        each = (error[row] * batch.value).astype(np.float32)
        gradient = np.concatenate([each[:, None], each[:, None] * (sums[row].astype(np.float32) - scaled)], axis=1)
        by_term = np.argsort(batch.index, kind="stable")
        index = batch.index[by_term]
        edge = np.flatnonzero(np.concatenate([[True], index[1:] != index[:-1]]))
        term = index[edge]
        gradient = np.add.reduceat(gradient[by_term], edge, axis=0)
        gradient[:, 0] += l2 * model.weights[term]
        gradient[:, 1:] += l2 * model.vectors[term]
        grown[term] += gradient * gradient
        step = rate * gradient / np.sqrt(grown[term])
        model.weights[term] -= step[:, 0]
        model.vectors[term] -= 0.1 * step[:, 1:]
        bias_grown += float(error.sum()) ** 2
        model.bias -= 0.1 * rate * float(error.sum()) / bias_grown**0.5
    return model


def fit_on(documents: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, key: str = "doc_id", text: str = "text", label: str = "toxic") -> FactorizationMachine:
    """Fit on at most ``max_rows`` labelled documents outside the held-out fold."""
    known = labels.where(F.col(key).isNotNull() & ~held_out(key)).groupBy(F.col(key).alias("id")).agg(F.max(label).alias("label"))
    known = known.where("label is not null")
    texts = versions(documents, key, text)
    sample = sampled_texts(texts.join(known, "id", "left_semi"), max_rows).join(known, "id")
    rows, marks = collected(with_texts(texts, stored(sample, "sample")), hashed_terms, BITS)
    return fit(rows, marks.astype(np.float64))


def score_toxicity(documents: DataFrame, model: FactorizationMachine, text: str = "text", to: str = "score") -> DataFrame:
    """``documents`` and the score (0 to 1) of every row, in the column ``to``."""
    shared = documents.sparkSession.sparkContext.broadcast(model)
    return scored(documents, text, hashed_terms, BITS, lambda rows: shared.value.score(rows), to)


def op2_factorization_machine(spark, sf_dir: str) -> DataFrame:
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = fit_on(documents, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score_toxicity(documents.select("doc_id", "text"), model).select(
        "doc_id",
        held_out("doc_id").alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )
