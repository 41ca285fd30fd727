"""Benchmark decontamination with a distributed positional inverted index.

Only DataFrame functions are used. The index holds the positions of terms in the training
texts, a row for each term and document. To find a phrase, its terms are ranked by how
often they occur in training; the list of the rarest gives the places where the phrase may
start (position less offset), the lists of the next rarest are intersected with them, and
what is left is compared with the words of the document. Phrases that hold a term which
never occurs drop out at once. So the long lists of common words are never read, and need
not be stored: the index for a benchmark has the terms that rank first in some phrase.

Proximity matches are found by the same lists: all terms of a query within a stretch of
words, in any order.

Words are the runs of 0-9, a-z and characters beyond ASCII, after A-Z became a-z.

Defined cases: null and empty texts have no words; very long texts are matched whole, a list
of positions for each of their terms; documents without id are judged by their text like
all others; rows that repeat id and text give a result each; rows of one id with different
texts are different documents; of a phrase's terms that are equally rare the first ranks
first; benchmark items without id mark words as hit,
but aren't counted; items with the same id are one item; an empty benchmark or table gives
documents without hits, or none; columns other than the named ones are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tidegauge.session import stored

WINDOW = 13
#: How many of a phrase's lists are intersected before its words are compared.
LISTS = 2
#: Rows of a table that may be broadcast; beyond it the join is shuffled.
SMALL = 200_000

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """The words of a text, in order. Only A-Z is lowered, so `lower` serves where all characters are ASCII."""
    text = F.coalesce(text, F.lit(""))
    low = F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))
    return F.array_remove(F.split(low, _GAP), "")


def small(df: DataFrame) -> DataFrame:
    """``df`` to be broadcast if a count shows that it has few rows."""
    return F.broadcast(df) if df.limit(SMALL + 1).count() <= SMALL else df


def version_of(text: Column) -> Column:
    """A hash that tells texts of one id apart."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def _texts(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(F.col(key).alias("doc"), version_of(F.col(text)).alias("version"), F.col(text).alias("text"))


def _tokens(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """``doc``, ``version``, ``pos`` and ``term`` of all words that are among ``terms`` (distinct)."""
    exploded = docs.where("doc is not null").select("doc", "version", F.posexplode(words_of(F.col("text"))).alias("pos", "term"))
    return exploded.join(small(terms), "term", "left_semi")


def build_index(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """The stored index of ``docs`` (doc, version, text): ``term``, ``doc``, ``version`` and the ascending ``positions`` (from 0)."""
    lists = _tokens(docs, terms).groupBy("term", "doc", "version").agg(F.array_sort(F.collect_set("pos")).alias("positions"))
    return stored(lists, "postings")


def term_counts(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """``term`` and ``n``: how often each of ``terms`` occurs in the texts, where it does."""
    return _tokens(docs, terms).groupBy("term").agg(F.count(F.lit(1)).alias("n"))


def phrase_matches(docs: DataFrame, phrases: DataFrame, lists: int = LISTS) -> DataFrame:
    """Where phrases occur. ``docs``: doc, version, text. ``phrases``: phrase (distinct arrays of words, none empty).

    Returns ``phrase_id`` (a hash), ``phrase``, ``doc``, ``version`` and ``start`` (words from 0).
    """
    phrases = stored(phrases.select(F.xxhash64("phrase").alias("phrase_id"), "phrase"), "phrases")
    placed = phrases.select("phrase_id", F.posexplode("phrase").alias("offset", "term"))
    counts = stored(term_counts(docs, placed.select("term").distinct()), "term-counts")
    known = placed.join(counts, "term", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    by_phrase = W.partitionBy("phrase_id")
    ranked = (
        known.withColumn("least", F.min("n").over(by_phrase))
        .where("least > 0")
        .withColumn("rank", F.row_number().over(by_phrase.orderBy("n", "offset")))
        .where(F.col("rank") <= lists)
    )
    ranked = stored(ranked.select("phrase_id", "term", "offset", "rank"), "rarest-terms")
    index = build_index(docs, ranked.select("term").distinct())
    rank = lambda k: ranked.where(F.col("rank") == k).select("phrase_id", "term", "offset")
    found = (
        index.join(small(rank(1)), "term")
        .select("phrase_id", "doc", "version", F.explode(F.transform("positions", lambda p: p - F.col("offset"))).alias("start"))
        .where("start >= 0")
    )
    for k in range(2, lists + 1):
        # Phrases of fewer terms pass on as they are.
        here = found.join(small(rank(k)), "phrase_id", "left")
        found = here.join(index, ["term", "doc", "version"], "left").where("offset is null or array_contains(positions, start + offset)")
        found = found.select("phrase_id", "doc", "version", "start")
    found = stored(found, "phrase-candidates")
    wanted = found.select("doc", "version").distinct()
    texts = docs.where("doc is not null").join(small(wanted), ["doc", "version"], "left_semi").dropDuplicates(["doc", "version"])
    worded = texts.select("doc", "version", words_of(F.col("text")).alias("words"))
    same = F.slice(F.col("words"), F.col("start") + 1, F.size("phrase")) == F.col("phrase")
    return found.join(small(phrases), "phrase_id").join(worded, ["doc", "version"]).where(same).select("phrase_id", "phrase", "doc", "version", "start")


def proximity_matches(docs: DataFrame, queries: DataFrame, within: int) -> DataFrame:
    """Stretches of at most ``within`` words that hold all terms of a query, in any order.

    ``docs``: doc, version, text; ``queries``: query_id (distinct), terms (array of words). Returns
    ``query_id``, ``doc``, ``version``, ``start`` and ``end`` (first and last of the words that match)
    for every shortest stretch that starts with a query's term.
    """
    terms = queries.select("query_id", F.explode(F.array_distinct("terms")).alias("term"))
    sizes = terms.groupBy("query_id").agg(F.count(F.lit(1)).alias("size"))
    index = build_index(docs, terms.select("term").distinct())
    rare = index.groupBy("term").agg(F.sum(F.size("positions")).alias("n"))
    rarest = terms.join(rare, "term").groupBy("query_id").agg(F.min_by("term", F.struct("n", "term")).alias("term"))
    # Only places within reach of the rarest term can belong to a match.
    near = (
        index.join(rarest, "term")
        .select("query_id", "doc", "version", F.explode("positions").alias("at"))
        .select("query_id", "doc", "version", F.explode(F.array(*[F.floor(F.col("at") / within) + d for d in (-1, 0, 1)])).alias("block"))
        .distinct()
    )
    places = index.join(terms, "term").select("query_id", "doc", "version", "term", F.explode("positions").alias("pos"))
    places = places.withColumn("block", F.floor(F.col("pos") / within)).join(near, ["query_id", "doc", "version", "block"], "left_semi")
    first = places.select("query_id", "doc", "version", F.col("pos").alias("start"), F.explode(F.array("block", F.col("block") + 1)).alias("block"))
    pairs = first.join(places, ["query_id", "doc", "version", "block"]).where((F.col("pos") >= F.col("start")) & (F.col("pos") < F.col("start") + within))
    nearest = pairs.groupBy("query_id", "doc", "version", "start", "term").agg(F.min("pos").alias("pos"))
    whole = nearest.groupBy("query_id", "doc", "version", "start").agg(F.max("pos").alias("end"), F.count(F.lit(1)).alias("n"))
    return whole.join(sizes, "query_id").where("n = size").select("query_id", "doc", "version", "start", "end")


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW, key: str = "item_id", text: str = "text") -> DataFrame:
    """``item`` and ``phrase``: each run of ``window`` words of an item; all its words if there are fewer."""
    worded = benchmark.select(F.col(key).alias("item"), words_of(F.col(text)).alias("words")).where(F.size("words") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("words") - window + 1, F.lit(1)))
    return worded.select("item", "words", F.explode(starts).alias("at")).select("item", F.slice("words", F.col("at"), window).alias("phrase")).distinct()


def contamination(
    documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """Per row of ``documents``: ``doc`` (the key), ``version``, ``n_words``, ``n_hit``, ``items`` (ascending, as strings) and ``contaminated``."""
    docs = _texts(documents.withColumns({key: F.struct(F.col(key).alias("id"))}), key, text)  # a struct of null equals another
    windows = stored(benchmark_windows(benchmark, window, item, item_text), "windows")
    found = stored(phrase_matches(docs, windows.select("phrase").distinct()), "matches")
    by_doc = ["doc", "version"]
    hit = (
        found.select(*by_doc, F.explode(F.sequence("start", F.col("start") + F.size("phrase") - 1)).alias("pos"))
        .distinct()
        .groupBy(*by_doc)
        .agg(F.count(F.lit(1)).alias("n_hit"))
    )
    pairs = found.select(*by_doc, "phrase_id").distinct().join(small(windows.select(F.xxhash64("phrase").alias("phrase_id"), "item").distinct()), "phrase_id")
    items = pairs.groupBy(*by_doc).agg(F.array_sort(F.collect_set(F.col("item").cast("string"))).alias("items"))
    marked = stored(hit.join(items, by_doc, "left"), "hits")
    rows = docs.select(*by_doc, F.size(words_of(F.col("text"))).cast("long").alias("n_words")).join(small(marked), by_doc, "left")
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return rows.select(
        F.col("doc.id").alias("doc"),
        "version",
        "n_words",
        n_hit.alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        ((n_hit > 0) & (20 * n_hit >= F.col("n_words"))).alias("contaminated"),
    )


def uncontaminated(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, key: str = "doc_id", text: str = "text", nameless: bool = False) -> DataFrame:
    """``documents`` without the contaminated ones. Rows without id all stay unless ``nameless`` has them judged by their text."""
    docs = documents.select(F.col(key).alias("doc"), F.col(text).alias("text"))
    found = contamination(docs, benchmark, window, "doc", "text").where("contaminated")
    found = found.select(F.col("doc").alias("__doc"), F.col("version").alias("__version")).distinct()
    same_id = F.col(key).eqNullSafe(F.col("__doc")) if nameless else F.col(key) == F.col("__doc")
    same = same_id & (version_of(F.col(text)) == F.col("__version"))
    return documents.join(small(stored(found, "contaminated")), same, "left_anti")


def op5_positional_index(spark, sf_dir: str) -> DataFrame:
    found = contamination(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select(
        F.col("doc").alias("doc_id"),
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


OP5_SQL = r"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[0-9a-z\x{80}-\x{10FFFF}]+') AS w FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[0-9a-z\x{80}-\x{10FFFF}]+') AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS n, array_to_string(w[s:s + least(len(w), 13) - 1], ' ') AS p
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS s FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM win),
place AS (
  SELECT r, s, n, array_to_string(w[s:s + n - 1], ' ') AS p
  FROM (SELECT r, w, n, unnest(range(1, greatest(len(w) - n + 1, 0) + 1)) AS s FROM d, sizes)),
hit AS (SELECT r, s, place.n, item_id FROM place JOIN win ON place.p = win.p AND place.n = win.n),
pos AS (SELECT DISTINCT r, unnest(range(s, s + n)) AS i FROM hit),
n_pos AS (SELECT r, count(*) AS n_hit FROM pos GROUP BY r),
item AS (SELECT r, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS items
         FROM (SELECT DISTINCT r, CAST(item_id AS varchar) AS i FROM hit WHERE item_id IS NOT NULL) GROUP BY r)
SELECT d.doc_id, CAST(len(w) AS bigint) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN n_pos USING (r) LEFT JOIN item USING (r)
"""
