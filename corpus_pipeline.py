"""The corpus pipeline: five stages over `documents`, each on what the one before kept.

Repeated rows: stages judge rows by id and text; only near duplicates folds rows that repeat
both. Rows without id are judged like all others, by their text. Null texts count as empty: they have no class to share, no windows and no secrets, and
are kept if the classifier keeps the empty text. Very long texts are judged whole. Of equally good documents of a class
the smallest id stays. Columns beside those of documents pass the stages, also with names that stages use. An empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.llm import decontam, ledger, piecewise, quality, shingle_join
from tidegauge.session import scratch

#: Scores below this are rejected. Lower than the 0.7 of `predicted`, as a good text that is lost is worse than junk that stays.
KEEP = 0.5


def good_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    model = quality.fit_on(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.score_quality(docs, model, to="__quality").where(F.col("__quality") >= KEEP).drop("__quality")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class stays: similarity 0.8 on shingles of five words."""
    return shingle_join.one_of_each(docs, n=5, percent=80, nameless=True)


def benchmark_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which a twentieth of the words or more stand in passages of the benchmark go."""
    return decontam.uncontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), nameless=True)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are blacked out; every document stays, with its new length."""
    clean = ledger.redacted(docs, scratch(spark, "ledger"), path="doc_id", content="text")
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sampled piece ids of every text, and whether decoding gives the text back."""
    coded = piecewise.encode(docs, check="lossless")
    return coded.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_pieces"), "ids", "lossless")


STAGES = [
    ("quality classifier", good_texts),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", benchmark_free),
    ("secret scans", secrets),
    ("SentencePiece encoding and decoding", pieces),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to `documents`; every stage's result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs


#: The stages hold trained models, regular expressions and sampling: SQL can't express them.
ORACLE_SQL = None
