"""A Merkle manifest of a dataset, by time-forward processing.

Every row is a leaf; the rows of a group make a tree, in the order of a key, and the groups'
roots make a tree of their own. In a tree every two consecutive nodes become their digest,
level by level, until one is left (the last may be alone; it is hashed all the same).

The nodes are labelled by level and place, so that children come before their parents. Time
goes forward by label: a node takes the digests that its children sent it from a priority
queue ordered by label, and sends its own to its parent's label. Then a second sweep takes
the labels in reverse: a node takes its proof suffix (the siblings on the way from it to the
root) and sends each child that suffix behind the child's sibling.

A group may have any number of rows. So a sweep goes in passes of `LEVELS` levels: a pass
deals nodes out by the label of their ancestor at its top, at most 2 ** `LEVELS` to a block,
and the sorted shuffle is the external part of the queue: it holds the messages to later
blocks and hands each block its own in the order of labels. Within a block the queue is a
heap. Places are made without a window over a group: rows are laid out in ranges of equal
size, and the places are the position within a range plus the sizes of the ranges before.

Defined cases: a null is written as `-` in a leaf, so it differs from an empty text; a null
group or key comes first; long texts are hashed by the JVM where they lie, only digests
travel; rows that repeat a key are ordered by their digest, equal rows are a leaf each; an
empty table has no root and gives no rows; other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

from tidegauge.llm.batches import arrow_map
from tidegauge.session import stored

LEVELS = 12
#: The siblings of a run on both sides, from the leaf's level up; an empty pair where a node is alone.
PROOF = "array<struct<before: string, after: string>>"
_ROWS = 1000


def leaf_digest(*columns: Column | str) -> Column:
    """The digest of a row: of each value its size in bytes, a colon and the value; `-` for null."""

    def part(column):
        text = (F.col(column) if isinstance(column, str) else column).cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.sha2(F.concat(*[part(c) for c in columns]), 256)


def folded(leaf: Column | str, proof: Column | str) -> Column:
    """The root that a leaf and its proof make."""

    def step(node, run):
        return F.sha2(F.concat(F.coalesce(run["before"], F.lit("")), node, F.coalesce(run["after"], F.lit(""))), 256)

    return F.aggregate(proof, F.col(leaf) if isinstance(leaf, str) else leaf, step)


def siblings(proof: Column | str) -> Column:
    """The siblings of a proof as one text, from the leaf's level up."""
    return F.array_join(F.transform(proof, lambda run: F.concat(F.coalesce(run["before"], F.lit("")), F.coalesce(run["after"], F.lit("")))), "")


def placed(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """``rows`` with ``place`` (from 0, by ``order``) and ``size`` within their group, stored.

    Rows that tie are cut apart by their position in the input, so ties of any number are
    spread over tasks like other rows.
    """
    keys = [group, *order, "__at"]
    laid = rows.withColumn("__at", F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys).drop("__at")
    laid = stored(laid.withColumn("__at", F.monotonically_increasing_id()), "laid")  # range and position in it
    laid = laid.withColumn("__range", F.shiftright("__at", 33)).withColumn("__row", F.col("__at").bitwiseAND((1 << 33) - 1))
    runs = laid.groupBy("__range", F.col(group).alias("__group")).agg(F.min("__row").alias("__first"), F.count(F.lit(1)).alias("__n"))
    of_group = W.partitionBy("__group")
    before = F.coalesce(F.sum("__n").over(of_group.orderBy("__range").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    runs = runs.select(F.col("__range").alias("__r"), "__group", (before - F.col("__first")).alias("__shift"), F.sum("__n").over(of_group).alias("size"))
    joined = laid.join(runs, (F.col("__range") == F.col("__r")) & F.col(group).eqNullSafe(F.col("__group")))
    return joined.withColumn("place", F.col("__row") + F.col("__shift")).drop("__at", "__range", "__row", "__r", "__group", "__shift")


def _hash(children: list[str]) -> str:
    return sha256("".join(children).encode()).hexdigest()


def forward(leaves: list[str], levels: int) -> dict[tuple[int, int], str]:
    """The digests of all nodes of a block by label (level, place); the top is at ``levels``."""
    queue = [(0, place, 0, digest) for place, digest in enumerate(leaves)]  # in order, so a heap
    nodes = {}
    while queue:
        level, place = queue[0][:2]
        sent = []
        while queue and queue[0][:2] == (level, place):
            sent.append(heapq.heappop(queue)[3])
        nodes[level, place] = digest = _hash(sent) if level else sent[0]
        if level < levels:
            heapq.heappush(queue, (level + 1, place // 2, place % 2, digest))
    return nodes


def backward(nodes: dict[tuple[int, int], str], levels: int, suffix) -> list:
    """The proof of each leaf, as a chain of (before, after, rest) that ends in ``suffix``."""
    queue, proofs = [(-levels, 0, suffix)], {}
    while queue:
        level, place, proof = heapq.heappop(queue)
        level, place = -level, -place
        if not level:
            proofs[place] = proof
            continue
        left, right = nodes[level - 1, 2 * place], nodes.get((level - 1, 2 * place + 1))
        heapq.heappush(queue, (1 - level, -2 * place, (None, right, proof)))
        if right is not None:
            heapq.heappush(queue, (1 - level, -2 * place - 1, (left, None, proof)))
    return [proofs[place] for place in range(len(proofs))]


def _blocks(batches: Iterator[pa.RecordBatch], *names: str) -> Iterator[tuple[tuple, list[tuple]]]:
    """Consecutive rows with equal ``group`` and ``block``."""
    own, rows = None, []
    for batch in batches:
        for name, *row in zip(zip(batch.column("group").to_pylist(), batch.column("block").to_pylist(), strict=True), *[batch.column(n).to_pylist() for n in names], strict=True):
            if name != own:
                if rows:
                    yield own, rows
                own, rows = name, []
            rows.append(row)
    if rows:
        yield own, rows


def _dealt(nodes: DataFrame, levels: int, *names: str) -> DataFrame:
    """Nodes by blocks, in the order of their labels. ``height``: the levels of the block's tree."""
    height = F.least(F.lit(levels), F.when(F.col("size") > 1, F.length(F.bin(F.col("size") - 1))).otherwise(0))
    return nodes.select("group", F.shiftright("place", levels).alias("block"), "place", "size", height.alias("height"), "digest", *names)


def _sorted(nodes: DataFrame) -> DataFrame:
    return nodes.repartition("group", "block").sortWithinPartitions("group", "block", "place")


def _up(nodes: DataFrame, levels: int) -> DataFrame:
    """The tops of all blocks, as nodes of the next pass."""
    schema = T.StructType([nodes.schema["group"], *T._parse_datatype_string("place long, size long, digest string").fields])
    kind = pa.schema([("place", pa.int64()), ("size", pa.int64()), ("digest", pa.string())])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []
        group_type = None

        def flush():
            columns = list(zip(*out, strict=True))
            made = [pa.array(columns[0], group_type), *[pa.array(c, f.type) for c, f in zip(columns[1:], kind, strict=True)]]
            return pa.RecordBatch.from_arrays(made, names=["group", *kind.names])

        def typed(source):
            nonlocal group_type
            for batch in source:
                group_type = batch.schema.field("group").type
                yield batch

        for (group, block), rows in _blocks(typed(batches), "size", "height", "digest"):
            size, height, _ = rows[0]
            top = forward([digest for _, _, digest in rows], height)[height, 0]
            out.append((group, block, -(-size // (1 << levels)), top))
            if len(out) >= _ROWS:
                yield flush()
                out = []
        if out:
            yield flush()

    return arrow_map(_sorted(_dealt(nodes, levels)), task, schema)


def _chain(proof: list[dict]):
    rest = None
    for run in reversed(proof):
        rest = (run["before"], run["after"], rest)
    return rest


def _down(nodes: DataFrame, suffixes: DataFrame, levels: int, carried: list[str]) -> DataFrame:
    """``nodes`` (group, place, digest, carried columns) with ``subroot`` and ``proof``, given those of their blocks' tops (group, block)."""
    rows = _dealt(nodes, levels, *carried).select("*", F.lit(None).cast("string").alias("subroot"), F.lit(None).cast(PROOF).alias("proof"))
    tops = suffixes.select("group", F.col("place").alias("block"), F.lit(-1).cast("long").alias("place"), "subroot", "proof")
    both = _sorted(rows.unionByName(tops, allowMissingColumns=True))  # a block's suffix comes before its nodes
    kept = ["group", "place", "digest", *carried]
    schema = T.StructType([nodes.schema[c] for c in kept] + T._parse_datatype_string(f"subroot string, proof {PROOF}").fields)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types: list[pa.DataType] = []

        def typed(source):
            for batch in source:
                types[:] = [batch.schema.field(c).type for c in kept]
                yield batch

        names = ["height", "subroot", "proof", "place", "digest", *carried]
        for (group, _), block in _blocks(typed(batches), *names):
            (_, subroot, suffix, *_), rows = block[0], block[1:]
            height = rows[0][0]
            nodes = forward([row[4] for row in rows], height)
            proofs = backward(nodes, height, _chain(suffix))
            for first in range(0, len(rows), _ROWS):
                part = rows[first : first + _ROWS]
                bounds, before, after = [0], [], []
                for proof in proofs[first : first + _ROWS]:
                    while proof is not None:
                        left, right, proof = proof
                        before.append(left)
                        after.append(right)
                    bounds.append(len(before))
                runs = pa.StructArray.from_arrays([pa.array(before, pa.string()), pa.array(after, pa.string())], names=["before", "after"])
                columns = [pa.array([group] * len(part), types[0])]
                columns += [pa.array([row[3 + i] for row in part], t) for i, t in enumerate(types[1:])]
                columns += [pa.array([subroot] * len(part), pa.string()), pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), runs)]
                yield pa.RecordBatch.from_arrays(columns, names=[*kept, "subroot", "proof"])

    return arrow_map(both, task, schema)


def _tree(leaves: DataFrame, levels: int) -> list[DataFrame]:
    """The nodes (group, place, size, digest) at the start of each pass; the last are the groups' roots."""
    passes = [leaves]
    while not passes[-1].where("size > 1").isEmpty():
        passes.append(stored(_up(passes[-1].select("group", "place", "size", "digest"), levels), "nodes"))
    return passes


def _proofs(passes: list[DataFrame], tops: DataFrame, levels: int, carried: list[str]) -> DataFrame:
    """The leaves with their proofs. ``tops``: group, place (0), subroot and proof of the groups' roots."""
    suffixes = tops
    for i in range(len(passes) - 2, 0, -1):
        suffixes = stored(_down(passes[i], suffixes, levels, []), "suffixes")
    if len(passes) == 1:  # every group is one leaf
        return passes[0].join(tops.drop("place").withColumnRenamed("group", "__group"), F.col("group").eqNullSafe(F.col("__group"))).drop("__group", "size")
    return _down(passes[0], suffixes, levels, carried)


def manifest(rows: DataFrame, columns: list[str], group: str, order: str, carried: dict[str, Column] | None = None, levels: int = LEVELS) -> DataFrame:
    """The manifest of ``rows``: ``group``, ``key`` (``order``), ``leaf``, ``subroot``, ``root`` and ``proof``, a row for each.

    ``columns`` make the leaves. ``carried`` names columns to take along from ``rows``, as
    the leaf of what a copy holds, to be folded with the proof.
    """
    carried = carried or {}
    clash = {"group", "place", "size", "digest", "key", "block", "height", "subroot", "root", "proof", "leaf"} & set(carried)
    if clash:
        raise ValueError(f"names of the manifest's own: {sorted(clash)}")
    leaves = rows.select(F.col(group).alias("group"), F.col(order).alias("key"), leaf_digest(*columns).alias("digest"), *[c.alias(n) for n, c in carried.items()])
    passes = _tree(placed(stored(leaves, "leaves"), "group", ["key", "digest"]), levels)
    kind = passes[0].schema["group"].dataType
    roots = passes[-1].select(F.lit(0).alias("group"), F.col("group").alias("name"), "digest")
    tops = _tree(placed(roots, "group", ["name"]), levels)
    top = tops[-1].select("digest").first()
    root = None if top is None else top.digest
    start = tops[-1].select("group", "place", F.col("digest").alias("subroot"), F.array().cast(PROOF).alias("proof"))
    named = _proofs(tops, start, levels, ["name"])
    starts = stored(named.select(F.col("name").cast(kind).alias("group"), F.lit(0).cast("long").alias("place"), F.col("digest").alias("subroot"), "proof"), "subroots")
    made = _proofs(passes, starts, levels, ["key", *carried])
    return made.select("group", "key", F.col("digest").alias("leaf"), "subroot", F.lit(root).cast("string").alias("root"), "proof", *carried)


COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]


def op13_merkle_manifest(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    changed = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    one_more = F.coalesce(F.try_add("n_chars", F.lit(1)), F.col("n_chars"))
    tampered = leaf_digest(*[one_more if c == "n_chars" else c for c in COLUMNS])
    made = manifest(docs, COLUMNS, "lang", "doc_id", {"tampered": F.when(changed, tampered)})
    folded_root = folded(F.coalesce("tampered", "leaf"), F.col("proof"))
    out = made.select(F.col("key").alias("doc_id"), "leaf", "subroot", "root", F.sha2(siblings("proof"), 256).alias("proof_sha256"), folded_root.alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


OP13_SQL = """
WITH RECURSIVE byte AS (
  SELECT doc_id, list_reduce(list_prepend(4294967295::BIGINT, [ascii(c)::BIGINT FOR c IN string_split(doc_id::VARCHAR, '')]),
    lambda s, b: list_reduce(list_prepend(xor(s, b), range(8)), lambda x, k: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)) AS s
  FROM (SELECT DISTINCT doc_id FROM documents WHERE doc_id IS NOT NULL)),
t AS (SELECT doc_id, lang, coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
             || coalesce(strlen(lang) || ':' || lang, '-') AS head, n_chars,
             CASE WHEN coalesce(xor(s, 4294967295) % 7 = 0, false) THEN n_chars + 1 ELSE n_chars END AS more,
             coalesce(strlen(text) || ':' || text, '-') AS tail
      FROM documents LEFT JOIN byte USING (doc_id)),
u AS (SELECT doc_id, lang, sha256(head || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') || tail) AS leaf,
             sha256(head || coalesce(strlen(more::VARCHAR) || ':' || more, '-') || tail) AS claim FROM t),
f AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY lang) AS n FROM u),
v AS (
  SELECT lang, 0 AS l, i, n, leaf AS d FROM f
  UNION ALL
  SELECT lang, l + 1, i // 2, (n + 1) // 2, sha256(string_agg(d, '' ORDER BY i)) FROM v WHERE n > 1 GROUP BY lang, l, i // 2, n),
g AS (SELECT lang, d, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS i, count(*) OVER () AS n FROM v WHERE n = 1),
z AS (
  SELECT 0 AS l, i, n, d FROM g
  UNION ALL
  SELECT l + 1, i // 2, (n + 1) // 2, sha256(string_agg(d, '' ORDER BY i)) FROM z WHERE n > 1 GROUP BY l, i // 2, n),
p AS (
  SELECT lang, i AS at, 0 AS l, i, n, claim AS acc, '' AS proof FROM f
  UNION ALL
  SELECT p.lang, p.at, p.l + 1, p.i // 2, (p.n + 1) // 2,
         sha256(CASE WHEN p.i % 2 = 1 THEN s.d || acc ELSE acc || coalesce(s.d, '') END), proof || coalesce(s.d, '')
  FROM p LEFT JOIN v s ON s.lang IS NOT DISTINCT FROM p.lang AND s.l = p.l AND s.i = xor(p.i, 1) WHERE p.n > 1),
q AS (
  SELECT p.lang, p.at, 0 AS l, g.i, g.n, p.acc, p.proof FROM p JOIN g ON g.lang IS NOT DISTINCT FROM p.lang WHERE p.n = 1
  UNION ALL
  SELECT q.lang, q.at, q.l + 1, q.i // 2, (q.n + 1) // 2,
         sha256(CASE WHEN q.i % 2 = 1 THEN s.d || acc ELSE acc || coalesce(s.d, '') END), proof || coalesce(s.d, '')
  FROM q LEFT JOIN z s ON s.l = q.l AND s.i = xor(q.i, 1) WHERE q.n > 1)
SELECT f.doc_id, f.leaf, g.d AS subroot, r.d AS root, sha256(q.proof) AS proof_sha256, q.acc AS folded_root, q.acc = r.d AS verified
FROM f JOIN g ON g.lang IS NOT DISTINCT FROM f.lang JOIN q ON q.lang IS NOT DISTINCT FROM f.lang AND q.at = f.i AND q.n = 1
CROSS JOIN (SELECT d FROM z WHERE n = 1) r
"""
