"""Small tables with the odd cases that every operator must bear."""

import random

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "id string, doc string, version string, node string, key string, spans string, score string, ids string, path string, phrase string"
)
EXTRA = ("x",) * 10


def prose(seed, n, vocabulary=400):
    rng = random.Random(seed)
    return " ".join(f"{rng.choice('abcdefgh')}{rng.randrange(vocabulary)}" for _ in range(n))


def documents(spark, pairs):
    """A table of (doc_id, text) with columns whose names clash with those the operators use."""
    rows = [(i, t, "en", "s", None if t is None else len(t), *EXTRA) for i, t in pairs]
    return spark.createDataFrame(rows, SCHEMA)


LONG = prose(9, 60_000, 5_000)
ODD = [
    (1, None),
    (2, ""),
    (3, " \n\t "),
    (4, "word"),
    (None, prose(1, 40)),
    (5, prose(1, 40)),
    (5, prose(1, 40)),
    (6, prose(1, 40)),
    (7, LONG),
    (8, "é▁İ \x00 K😀 " * 30),
    (9, "!!! ... ---"),
]


def odd(spark):
    return documents(spark, ODD)


def none(spark):
    return documents(spark, [])
