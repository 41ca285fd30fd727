"""N-gram Jaccard join with adaptive multi-match prefixes, and the classes it makes.

A text's set are its distinct shingles of ``n`` words. Two texts are linked when their sets
have a Jaccard similarity of ``percent`` / 100 or more; a class is what links connect.

How links are found without comparing all pairs (every step is exact):

1. Equal sets are one node from the start, named by a hash of the set.
2. A token that stands in one node only can't be shared. A node with more of those than the
   similarity leaves room for is linked with nothing. This is tested first on the tokens with
   the lowest hashes, then, for the nodes that are left, on all tokens.
3. Tokens are ordered by their number of nodes, rarest first. Two linked nodes share at least
   k tokens among the first (size - least overlap + k) of each, for every k (Wang, Li and
   Feng, Can we beat the prefix filtering?, 2012). Each node chooses its k by the estimated
   cost of its candidates: a longer prefix reads more lists, but asks for more shared tokens
   before a pair is compared.
4. Near copies come in groups in which all pairs would be candidates. So each node is first
   compared with the most typical nodes among its lists; these links make first classes.
   Afterwards only pairs of different classes are candidates: lists within one class are
   dropped, and in each other list the nodes of its largest class aren't paired with each
   other. A pair is also left out if its cores (the tokens that a node shares with any
   other) can't have enough in common: tokens fall into `BINS` by their hash, and the
   overlap is at most the sum of the smaller counts of each bin.
5. Candidates are verified on their whole sets.

Defined cases: null and empty texts, and texts without words, have the empty set and are a
class each; rows without id get no class; rows that repeat an id and text give a result each;
rows of one id with different texts are judged each by its text; a class is named by its
smallest id; very long texts have one set like all others, in one row; tokens that are equally
frequent are ordered by their hash; an empty table gives no rows; columns other than the two named ones are ignored.
"""

from __future__ import annotations

import functools
import operator
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tidegauge.llm.batches import LOWER, NOT_BLANK, Rolling, arrow_map, distinct_per_text, pieces, shingles, utf8, words
from tidegauge.llm.components import components
from tidegauge.llm.decontam import small, version_of
from tidegauge.session import stored

MOST_MATCHES = 4
#: Cost of comparing two sets, per token, as a share of the cost of reading an entry of a list.
COMPARE = 0.1
ANCHORS = 2
BINS = 16


def _sets(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    for batch in batches:
        for piece in pieces(batch):
            data, bounds = utf8(piece.column("text"))
            data = LOWER[data]
            starts, ends, first = words(data, bounds, NOT_BLANK)
            yield piece, distinct_per_text(*shingles(Rolling(data).of(starts, ends), first, n))


def _names(sets: list[np.ndarray]) -> tuple[pa.Array, pa.Array]:
    """A 64-bit name and another 64 bits of the digest of each set."""
    raw = b"".join(blake2b(s.tobytes(), digest_size=16).digest() for s in sets)
    both = np.frombuffer(raw, np.int64).reshape(-1, 2)
    return pa.array(both[:, 0].copy()), pa.array(both[:, 1].copy())


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(a) for a in arrays])])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate([np.zeros(0, np.uint64), *arrays]).view(np.int64)))


def _described(n: int, share: float):
    """A task: id, version, node, check, n and the tokens among the lowest ``share`` of all hashes."""
    most = np.uint64(min(share, 1.0) * (2**64 - 1025))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece, sets in _sets(batches, n):
            node, check = _names(sets)
            low = [s[: np.searchsorted(s, most)] for s in sets]
            sizes = pa.array([len(s) for s in sets], pa.int64())
            yield pa.RecordBatch.from_arrays([piece.column("id"), piece.column("version"), node, check, sizes, _lists(low)], names=["id", "version", "node", "check", "n", "low"])

    return task


def _whole(n: int):
    """A task: node, n and all tokens."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, sets in _sets(batches, n):
            sizes = pa.array([len(s) for s in sets], pa.int64())
            yield pa.RecordBatch.from_arrays([_names(sets)[0], sizes, _lists(sets)], names=["node", "n", "tokens"])

    return task


def _ceil(a: Column, b: int) -> Column:
    return F.floor((a + (b - 1)) / b)


def _room(percent: int, n: str = "n") -> Column:
    """How many tokens of a set no similar set needs to have."""
    return F.col(n) - _ceil(F.col(n) * percent, 100)


def _without_partners(tokens: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """``nodes`` less those with more tokens of their own (by ``tokens``: token, node) than there is room for."""
    own = tokens.groupBy("token").agg(F.min("node").alias("node"), F.max("node").alias("last")).where("node = last")
    counts = own.groupBy("node").agg(F.count(F.lit(1)).alias("own"))
    return nodes.join(counts, "node", "left").where(F.coalesce("own", F.lit(0)) <= _room(percent)).drop("own")


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that are similar, judged on their whole sets."""
    sides = [sets.select(F.col("node").alias(c), F.col("n").alias(f"n_{c}"), F.col("tokens").alias(f"t_{c}")) for c in "ab"]
    both = pairs.join(sides[0], "a").join(sides[1], "b").withColumn("shared", F.size(F.array_intersect("t_a", "t_b")))
    return both.where(100 * F.col("shared") >= percent * (F.col("n_a") + F.col("n_b") - F.col("shared"))).select("a", "b")


def _postings(sets: DataFrame, percent: int) -> DataFrame:
    """Entries of the lists: token, node, n, core (and by bin), k, and the level of the token as a reader and as a list's entry.

    A token is in the prefix for k shared tokens if its level is at most k.
    """
    tokens = sets.select("node", "n", F.explode("tokens").alias("token"))
    counts = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    shared = tokens.join(counts, "token")
    by_node = W.partitionBy("node")
    bins = {f"bin{b}": F.count(F.when(F.col("token").bitwiseAND(BINS - 1) == b, 1)).over(by_node) for b in range(BINS)}
    placed = shared.withColumns({"core": F.count(F.lit(1)).over(by_node), **bins})
    placed = placed.withColumn("rank", F.row_number().over(by_node.orderBy("df", "token")))
    place = F.col("n") - F.col("core") + F.col("rank")  # the tokens that no other node has come first
    least_read = _ceil(F.col("n") * percent, 100)
    least_kept = _ceil(F.col("n") * (2 * percent), 100 + percent)
    levels = placed.where(F.col("core") >= least_read).select(
        "token",
        "node",
        "n",
        "core",
        "df",
        *bins,
        least_read.alias("least_read"),
        F.greatest(F.lit(1), place - F.col("n") + least_read).alias("read_level"),
        F.greatest(F.lit(1), place - F.col("n") + least_kept).alias("kept_level"),
    )
    entries = levels.where(F.col("read_level") <= MOST_MATCHES)
    cost = {}
    for k in range(1, MOST_MATCHES + 1):
        read = F.sum(F.when(F.col("read_level") <= k, F.col("df") - 1).otherwise(0)).over(by_node)
        cost[k] = F.when(F.col("least_read") >= k, read * (1 + COMPARE * F.col("n") / k))
    chosen = F.coalesce(*[F.when(c == F.col("best"), F.lit(k)) for k, c in ((k, F.col(f"cost_{k}")) for k in cost)], F.lit(1))
    priced = entries.select("*", *[c.alias(f"cost_{k}") for k, c in cost.items()])
    priced = priced.withColumn("best", F.least(*[F.col(f"cost_{k}") for k in cost]))
    return priced.select("token", "node", "n", "core", chosen.alias("k"), "read_level", "kept_level", *bins)


def _typical_links(postings: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links of nodes with the most typical nodes of their lists: those with the smallest share of tokens of their own."""
    lists = postings.where("read_level = 1")
    typical = lists.groupBy("token").agg(F.min(F.struct(((F.col("n") - F.col("core")) / F.col("n")).alias("own"), "node")).alias("low"))
    met = lists.join(typical.select("token", F.col("low.node").alias("anchor")), "token").where("node <> anchor")
    counts = met.groupBy("node", "anchor").agg(F.count(F.lit(1)).alias("met"))
    first = W.partitionBy("node").orderBy(F.desc("met"), "anchor")
    chosen = counts.withColumn("turn", F.row_number().over(first)).where(F.col("turn") <= ANCHORS)
    return _linked(chosen.select(F.col("node").alias("a"), F.col("anchor").alias("b")), sets, percent)


def _candidates(postings: DataFrame, percent: int) -> DataFrame:
    """Pairs of nodes of different classes that share enough tokens of their prefixes. ``postings`` has ``class``."""
    sizes = postings.groupBy("token", "class").agg(F.count(F.lit(1)).alias("size"))
    mixed = sizes.groupBy("token").agg(F.max_by("class", F.struct("size", "class")).alias("largest"), F.count(F.lit(1)).alias("classes")).where("classes > 1")
    entries = postings.join(mixed.select("token", "largest"), "token").withColumn("minor", F.col("class") != F.col("largest"))
    x, y = entries.where("minor").alias("x"), entries.alias("y")
    c = F.col
    first_reads = F.struct("x.n", "x.node") > F.struct("y.n", "y.node")  # the larger one reads the other's lists
    in_prefixes = F.when(first_reads, (c("x.read_level") <= c("x.k")) & (c("y.kept_level") <= c("x.k"))).otherwise(
        (c("y.read_level") <= c("y.k")) & (c("x.kept_level") <= c("y.k"))
    )
    overlap = _ceil((c("x.n") + c("y.n")) * percent, 100 + percent)
    meets = x.join(
        y,
        (c("x.token") == c("y.token"))
        & (c("x.class") != c("y.class"))
        & (~c("y.minor") | first_reads)
        & (100 * F.least("x.n", "y.n") >= percent * F.greatest("x.n", "y.n"))
        & (overlap <= F.least("x.core", "y.core"))
        & in_prefixes
        & (overlap <= functools.reduce(operator.add, [F.least(f"x.bin{b}", f"y.bin{b}") for b in range(BINS)])),
    )
    reader = lambda name: F.when(first_reads, c(f"x.{name}")).otherwise(c(f"y.{name}"))
    kept = lambda name: F.when(first_reads, c(f"y.{name}")).otherwise(c(f"x.{name}"))
    pairs = meets.select(reader("node").alias("a"), kept("node").alias("b"), reader("n").alias("n_a"), kept("n").alias("n_b"), reader("k").alias("k"))
    met = pairs.groupBy("a", "b", "n_a", "n_b", "k").agg(F.count(F.lit(1)).alias("met"))
    # What both have behind their prefixes bounds the rest of the overlap.
    behind = F.greatest(_ceil(c("n_a") * percent, 100), _ceil(c("n_b") * (2 * percent), 100 + percent)) - c("k")
    needed = F.greatest(c("k").cast("long"), _ceil((c("n_a") + c("n_b")) * percent, 100 + percent) - behind)
    return met.where(c("met") >= needed).select("a", "b")


@dataclass
class Join:
    """What a join has found: the rows with their sets' names, the different sets, links between them and what these connect.

    ``rows``: id, version, node, n; ``nodes``: node, n, low_id; ``links``: a, b; ``roots``: node, root (of linked nodes).
    """

    rows: DataFrame
    nodes: DataFrame
    links: DataFrame
    roots: DataFrame


def similar_sets(docs: DataFrame, n: int = 5, percent: int = 80, key: str = "doc_id", text: str = "text", every_link: bool = False) -> Join:
    """Join the shingle sets of ``docs``.

    ``links`` are verified pairs of different sets, enough of them to connect all that any
    links connect: those with the typical sets that make the first classes, and all
    candidates between these classes. With ``every_link``, each node is its own class, so
    ``links`` are all pairs of different sets that are similar, each once.
    """
    if not 0 < percent <= 100:
        raise ValueError("percent must be from 1 to 100")
    texts = docs.select(F.col(key).alias("id"), version_of(F.col(text)).alias("version"), F.col(text).alias("text"))
    kind = texts.schema["id"].dataType.simpleString()
    share = 1.75 * (1 - percent / 100) if percent < 100 else 0.01
    rows = stored(arrow_map(texts, _described(n, share), f"id {kind}, version long, node long, check long, n long, low array<long>"), "sets")
    named = rows.where("id is not null and n > 0")
    nodes = named.groupBy("node").agg(F.min("id").alias("low_id"), F.max("n").alias("n"), F.min("check").alias("check"), F.max("check").alias("other"))
    clash = F.when(F.col("check") != F.col("other"), F.raise_error(F.lit("two sets have one name"))).otherwise(F.col("low_id"))
    nodes = nodes.select("node", "n", clash.alias("low_id"))
    some = stored(_without_partners(named.select(F.explode("low").alias("token"), "node"), nodes, percent), "nodes")
    # Sets of one row of each node that is left, made anew from its text.
    chosen = small(some.select(F.col("low_id").alias("id")).distinct())
    sets = arrow_map(texts.join(chosen, "id", "left_semi"), _whole(n), "node long, n long, tokens array<long>")
    sets = stored(sets.join(small(some.select("node")), "node", "left_semi").dropDuplicates(["node"]), "whole-sets")
    sets = stored(_without_partners(sets.select(F.explode("tokens").alias("token"), "node"), sets, percent), "whole-sets")
    postings = stored(_postings(sets, percent), "postings")
    if every_link:
        links = stored(_linked(_candidates(postings.withColumn("class", F.col("node")), percent), sets, percent), "links")
        return Join(rows, nodes, links, components(links))
    typical = stored(_typical_links(postings, sets, percent), "typical-links")
    early = components(typical).select("node", F.col("root").alias("class"))
    in_class = postings.join(early, "node", "left").withColumn("class", F.coalesce("class", "node"))
    late = stored(_linked(_candidates(in_class, percent), sets, percent), "links")
    between = late
    for c in "ab":
        between = between.join(early.select(F.col("node").alias(c), F.col("class").alias(f"class_{c}")), c, "left").withColumn(c, F.coalesce(f"class_{c}", c)).drop(f"class_{c}")
    roots = components(between.unionByName(early.select(F.col("node").alias("a"), F.col("class").alias("b"))))
    return Join(rows, nodes, typical.unionByName(late), roots)


def representative_pairs(docs: DataFrame, n: int = 5, percent: int = 80, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``a``, ``b``, ``n_a`` and ``n_b`` (set sizes): similar sets that make the classes, each by the smallest id that has it.

    With `classes`, which says who belongs where, no link between different texts is lost:
    sets that are linked are in one class, and the pairs connect each class.
    """
    found = similar_sets(docs, n, percent, key, text)
    pairs = found.links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    for c in "ab":
        pairs = pairs.join(found.nodes.select(F.col("node").alias(c), F.col("low_id").alias(f"id_{c}"), F.col("n").alias(f"n_{c}")), c)
    in_order = F.col("id_a") <= F.col("id_b")
    pick = lambda name, x, y: F.when(in_order, F.col(f"{name}_{x}")).otherwise(F.col(f"{name}_{y}"))
    return pairs.select(pick("id", "a", "b").alias("a"), pick("id", "b", "a").alias("b"), pick("n", "a", "b").alias("n_a"), pick("n", "b", "a").alias("n_b"))


def classes(docs: DataFrame, n: int = 5, percent: int = 80, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: ``id``, ``version`` (a hash of the text), ``n_shingles``, ``class`` (the smallest id that links reach) and ``root``.

    The root tells classes apart that have the same smallest id; it is null for empty sets and rows without id.
    """
    return _classes(similar_sets(docs, n, percent, key, text)).drop("node")


def classes_and_links(docs: DataFrame, n: int = 5, percent: int = 80, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``classes`` and ``n_links``: how many other rows with an id have a set similar to the row's, equal sets included.

    All links between different sets are found and verified; rows of one set are counted, not paired.
    Empty sets have 0, rows without id null.
    """
    found = similar_sets(docs, n, percent, key, text, every_link=True)
    named = found.rows.where("id is not null and n > 0").groupBy("node").agg(F.count(F.lit(1)).alias("rows"))
    pairs = found.links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    ends = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    others = ends.join(named.select(F.col("node").alias("b"), "rows"), "b").groupBy(F.col("a").alias("node")).agg(F.sum("rows").alias("linked_rows"))
    counts = named.join(others, "node", "left").select("node", (F.col("rows") - 1 + F.coalesce("linked_rows", F.lit(0))).alias("links"))
    n_links = F.when(F.col("id").isNotNull(), F.coalesce("links", F.lit(0)))
    return _classes(found).join(counts, "node", "left").select("id", "version", "n_shingles", "class", "root", n_links.alias("n_links"))


def _classes(found: Join) -> DataFrame:
    rows, nodes, roots = found.rows, found.nodes, found.roots
    named_roots = nodes.join(roots, "node", "left").select("node", "low_id", F.coalesce("root", "node").alias("root"))
    lowest = named_roots.groupBy("root").agg(F.min("low_id").alias("class"))
    by_node = named_roots.join(lowest, "root").select("node", "class", "root")
    own = F.when(F.col("n") == 0, F.col("id")).otherwise(F.when(F.col("id").isNotNull(), F.col("class")))
    root = F.when(F.col("id").isNotNull(), F.col("root"))
    return rows.select("id", "version", "node", "n").join(by_node, "node", "left").select("id", "version", "node", F.col("n").alias("n_shingles"), own.alias("class"), root.alias("root"))


def one_of_each(docs: DataFrame, n: int = 5, percent: int = 80, key: str = "doc_id", text: str = "text", nameless: bool = False) -> DataFrame:
    """``docs`` with one document of each class: the smallest id, of its texts that with the smallest hash, once.

    Rows without id all stay unless ``nameless`` has them judged by their text; they come after all
    ids then, and those without words, which have nothing to be judged by, stay.
    """
    name = F.struct(F.col(key).isNull().alias("nameless"), F.col(key).alias("id")) if nameless else F.col(key)
    named_docs = docs.select(name.alias("id"), F.col(text).alias("text"))
    found = stored(classes(named_docs, n, percent, "id", "text"), "classes").where("class is not null")
    if nameless:
        found = found.where("n_shingles > 0 or not id.nameless")
    # Classes of one name may be different ones; a text without words has no root and is judged by itself.
    linked = found.where("root is not null")
    one = linked.groupBy("root").agg(F.min(F.struct("id", "version")).alias("one"))
    named = [F.col("id").alias("__id"), F.col("version").alias("__version")]
    drop = linked.join(one, "root").where(F.struct("id", "version") != F.col("one")).select(*named).distinct()
    same = (name == F.col("__id")) & (version_of(F.col(text)) == F.col("__version"))
    kept = docs.join(small(stored(drop, "dropped")), same, "left_anti")
    rows = found.groupBy("id", "version").agg(F.count(F.lit(1)).alias("rows"))
    twice = small(stored(rows.where("rows > 1").select(*named), "repeated"))
    folded = kept.join(twice, same, "left_semi").withColumn("__version", version_of(F.col(text))).dropDuplicates([key, "__version"]).drop("__version")
    return kept.join(twice, same, "left_anti").unionByName(folded)


def op1_adaptive_prefix_join(spark, sf_dir: str) -> DataFrame:
    """Membership of every document; `representative_pairs` gives the links between the classes.

    Counting every link would pair all members of a group of near copies, which grows with
    the square of the group; within a first class no pair is made.
    """
    found = classes(spark.read.parquet(f"{sf_dir}/documents.parquet"), n=3, percent=90)
    return found.select(F.col("id").alias("doc_id"), "n_shingles", F.col("class").alias("component_id"))


OP1_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS t
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.t = b.t AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * c >= 90 * (a.n + b.n - c)),
e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
r AS (SELECT doc_id AS x, doc_id AS root FROM d UNION SELECT e.y, r.root FROM r JOIN e ON e.x = r.x)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, m.component_id
FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT x AS doc_id, min(root) AS component_id FROM r GROUP BY x) m USING (doc_id)
"""
