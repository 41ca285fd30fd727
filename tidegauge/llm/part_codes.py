"""Vector codes of a few bytes: each part of a vector becomes the index of its nearest codebook entry.

Vectors are integers (components times `SCALE`, rounded down), cut into `PARTS` parts. All
search goes through a trie over the distinct parts of a position: parts are ordered as
words are, and those that begin with the same components share the distances of these to
all entries. A node's distances are its parent's plus the squares of one component, for all
entries at once; a leaf takes the nearest entry, and gives its weight (the number of vectors
with this part) to that entry's sums. The traversal is depth-first over runs of at most
`NODES` sibling nodes, so that it holds a run's distances for each level, however many parts there are.

The codebooks are learned over all vectors: equal parts are folded before the shuffle and
stored in order, so the parts of a task begin alike; a round is one pass over them. Only sums
by entry and component go to the driver, a number that the codebooks' size fixes.

Defined cases: vectors that are null or hold null or non-finite components take no part, nor
do those of another length than the commonest (the longer of two as common ones); a length
that `PARTS` doesn't divide is filled up with zeros; vectors without components have parts
that are all alike and error 0; integers end at +-`LIMIT`, so that no sum overflows; rows
without id come after all others when the first entries are chosen, and rows of one id by
their vectors; fewer rows than entries make fewer entries; rows that repeat count once each;
an empty table gives no rows; columns other than the named ones are ignored or carried.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegauge.llm.batches import arrow_map
from tidegauge.llm.skew import attach
from tidegauge.session import stored

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
LIMIT = 1 << 25
#: Nodes whose distances are held for one level at a time.
NODES = 4096
#: Bytes of parts that a task walks together.
WALK_BYTES = 1 << 22


@dataclass
class Codebooks:
    """``entries``: parts x entries x components, as integers. ``dims``: the components of a vector."""

    entries: np.ndarray
    dims: int

    def sha256(self) -> str:
        return sha256(",".join(map(str, self.entries.reshape(-1).tolist())).encode()).hexdigest()


def walk(parts: np.ndarray, entries: np.ndarray, nodes: int = NODES) -> tuple[np.ndarray, np.ndarray]:
    """The nearest entry (the first of equally near ones) of each of ``parts``, and its squared distance.

    ``parts`` are distinct rows in ascending order.
    """
    n, width = parts.shape
    found, far = np.zeros(n, np.int64), np.zeros(n, np.int64)
    if not n:
        return found, far
    # From this component on a row shares no node with the row before.
    own = np.zeros(n, np.int64)
    if n > 1:
        own[1:] = np.argmax(parts[1:] != parts[:-1], axis=1)
    stack = [(0, np.zeros(1, np.int64), n, np.zeros((1, len(entries)), np.int64))]
    while stack:
        depth, heads, end, distance = stack.pop()  # nodes of one depth: their first rows, the end of the last, their distances
        if depth == width:
            found[heads] = np.argmin(distance, axis=1)
            far[heads] = distance[np.arange(len(heads)), found[heads]]
            continue
        first = heads[0]
        child = own[first:end] <= depth
        child[0] = True
        children = first + np.flatnonzero(child)
        parent = np.searchsorted(heads, children, side="right") - 1
        for a in range((len(children) - 1) // nodes * nodes, -1, -nodes):  # the first run ends on top of the stack
            run = children[a : a + nodes]
            step = parts[run, depth, None] - entries[None, :, depth]
            stop = children[a + nodes] if a + nodes < len(children) else end
            stack.append((depth + 1, run, stop, distance[parent[a : a + nodes]] + step * step))
    return found, far


def _distinct(parts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct rows in ascending order, the row among them of each of ``parts``, and how often each occurs."""
    order = np.lexsort(parts.T[::-1]) if parts.shape[1] else np.arange(len(parts))
    ordered = parts[order]
    new = np.ones(len(parts), bool)
    new[1:] = (ordered[1:] != ordered[:-1]).any(axis=1)
    number = np.cumsum(new) - 1
    at = np.empty(len(parts), np.int64)
    at[order] = number
    return ordered[new], at, np.bincount(number, minlength=int(new.sum()))


def _whole(vectors: pa.Array, dims: int) -> np.ndarray:
    """Integers, rows x parts x components of a part."""
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(vectors), dims)
    with np.errstate(over="ignore"):
        whole = np.clip(np.floor(flat * SCALE), -LIMIT, LIMIT).astype(np.int64)
    return np.pad(whole, ((0, 0), (0, -dims % PARTS))).reshape(len(whole), PARTS, -(-dims // PARTS))


def _lists(rows: np.ndarray) -> pa.Array:
    bounds = np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]
    return pa.ListArray.from_arrays(pa.array(bounds), pa.array(rows.reshape(-1)))


def _usable(vector: str) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.col(vector).isNotNull() & finite


def kept(vectors: DataFrame, vector: str = "embedding") -> tuple[DataFrame, int | None]:
    """The rows that take part, and the length of their vectors; None if there are none."""
    rows = vectors.where(_usable(vector))
    size = F.size(vector).alias("dims")
    commonest = rows.groupBy(size).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("dims")).first()
    return (rows.limit(0), None) if commonest is None else (rows.where(F.size(vector) == commonest.dims), commonest.dims)


def _distinct_parts(rows: DataFrame, dims: int) -> DataFrame:
    """``pos``, ``part`` and ``n``: the distinct parts of each position and how many vectors have them, in order."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                whole = _whole(batch.column("vector"), dims)
                for pos in range(PARTS):
                    parts, _, n = _distinct(whole[:, pos])
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(parts), pos, np.int32)), _lists(parts), pa.array(n)], names=["pos", "part", "n"])

    parts = arrow_map(rows, task, "pos int, part array<long>, n long").groupBy("pos", "part").agg(F.sum("n").alias("n"))
    parts = stored(parts, "parts")
    return stored(parts.repartitionByRange("pos", "part").sortWithinPartitions("pos", "part"), "ordered-parts")


def _summed(codebooks: Codebooks):
    """A task: weighted sums and counts of the parts that are nearest to each entry, by component."""
    entries = codebooks.entries
    width = entries.shape[2]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros(entries.shape, np.int64), np.zeros(entries.shape[:2], np.int64)

        def add(held: list[pa.RecordBatch]) -> None:
            table = pa.Table.from_batches(held).combine_chunks()
            pos, weight = table.column("pos").to_numpy(), table.column("n").to_numpy()
            column = table.column("part").chunk(0)
            parts = column.flatten().to_numpy().reshape(len(column), width)
            for p in np.unique(pos):
                own, weights = parts[pos == p], weight[pos == p]
                order = np.lexsort(own.T[::-1]) if width else np.arange(len(own))  # a task may read several ranges
                nearest, _ = walk(own[order], entries[p])
                np.add.at(sums[p], nearest, own[order] * weights[order, None])
                np.add.at(counts[p], nearest, weights[order])

        held, size = [], 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                size += batch.num_rows * (width + 1) * 8
            if size > WALK_BYTES:
                add(held)
                held, size = [], 0
        if held:
            add(held)
        p, e = np.nonzero(counts)
        if len(p):
            yield pa.RecordBatch.from_arrays(
                [pa.array(p.astype(np.int32)), pa.array(e.astype(np.int32)), pa.array(counts[p, e]), _lists(sums[p, e])], names=["pos", "entry", "n", "sums"]
            )

    return task


def fit_codebooks(rows: DataFrame, dims: int, key: str = "vec_id", vector: str = "embedding", entries: int = ENTRIES, rounds: int = ROUNDS) -> Codebooks:
    """Codebooks over all ``rows`` (see `kept`): they start with the rows of the smallest keys."""
    ordered = rows.select(F.col(key).alias("key"), F.col(vector).alias("vector"))
    first = ordered.orderBy(F.asc_nulls_last("key"), "vector").limit(entries).select("vector").toArrow().combine_chunks()
    books = Codebooks(np.ascontiguousarray(_whole(first.column("vector").chunk(0), dims).transpose(1, 0, 2)), dims)
    parts = _distinct_parts(ordered.select("vector"), dims)
    for _ in range(rounds):
        found = arrow_map(parts, _summed(books), "pos int, entry int, n long, sums array<long>").select("pos", "entry", "n", F.posexplode_outer("sums").alias("at", "sum"))
        totals = found.groupBy("pos", "entry", "at").agg(F.sum("n").alias("n"), F.sum("sum").alias("sum"))
        moved = books.entries.copy()
        for r in totals.collect():  # at most one row for each number of the codebooks
            if r["at"] is not None:
                moved[r["pos"], r["entry"], r["at"]] = r["sum"] // r["n"]
        books = Codebooks(moved, dims)
    return books


def encode(rows: DataFrame, books: Codebooks, vector: str = "embedding") -> DataFrame:
    """``rows`` (see `kept`) without ``vector``, with ``codes`` (an index for each part) and ``error`` (the squared distances, summed), in place of columns of these names."""
    carried = [c for c in rows.columns if c not in (vector, "codes", "error")]
    names = [f"c{i}" for i in range(len(carried))]
    inner = rows.select(*[F.col(c).alias(n) for c, n in zip(carried, names, strict=True)], F.col(vector).alias("vector"))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            whole = _whole(batch.column("vector"), books.dims)
            codes, error = np.empty((len(whole), PARTS), np.int32), np.zeros(len(whole), np.int64)
            for pos in range(PARTS):
                parts, at, _ = _distinct(whole[:, pos])
                nearest, far = walk(parts, books.entries[pos])
                codes[:, pos] = nearest[at]
                error += far[at]
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in names], _lists(codes), pa.array(error)], names=[*names, "codes", "error"])

    schema = T.StructType([*[T.StructField(n, inner.schema[n].dataType) for n in names], *T._parse_datatype_string("codes array<int>, error long").fields])
    out = arrow_map(inner, task, schema)
    return out.select(*[F.col(n).alias(c) for n, c in zip(names, carried, strict=True)], "codes", "error")


def decode(codes: np.ndarray, books: Codebooks) -> np.ndarray:
    """The vectors that ``codes`` (rows x parts) stand for."""
    parts = books.entries[np.arange(PARTS), codes]
    return parts.reshape(len(codes), -1)[:, : books.dims] / SCALE


def op12_trie_codes(spark, sf_dir: str) -> DataFrame:
    rows, dims = kept(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", "label"))
    if dims is None:
        return rows.select("vec_id", *[F.lit(None).cast(t).alias(c) for c, t in (("code", "string"), ("error", "long"), ("label_error", "long"), ("codebooks_sha256", "string"))])
    books = fit_codebooks(rows, dims)
    coded = stored(encode(rows, books), "codes")
    exact = F.sum(F.col("error").cast("decimal(19,0)"))
    by_label = stored(coded.groupBy("label").agg(exact.try_cast("long").alias("label_error"), F.count(F.lit(1)).alias("rows")), "label-errors")
    code = F.array_join(F.transform("codes", lambda c: F.lower(F.lpad(F.hex(c), 2, "0"))), "")
    return attach(coded, by_label, "label", "rows").select("vec_id", code.alias("code"), "error", "label_error", F.lit(books.sha256()).alias("codebooks_sha256"))


def _sql() -> str:
    """One step of a round after the other; `p` are the parts as lists, `c0` to `c6` the codebooks."""
    nearest = """
  SELECT p.id, p.pos, p.part, min(struct_pack(d := list_sum([(x[1] - x[2]) * (x[1] - x[2]) FOR x IN list_zip(p.part, c.part)])::BIGINT, e := c.e)) AS best
  FROM p JOIN c{k} c ON p.pos = c.pos GROUP BY p.id, p.pos, p.part"""
    steps = ""
    for k in range(ROUNDS):
        steps += f""",
a{k} AS ({nearest.format(k=k)}),
s{k} AS (
  SELECT pos, best.e AS e, i, (sum(part[i]) // count(*) - CASE WHEN sum(part[i]) % count(*) < 0 THEN 1 ELSE 0 END)::BIGINT AS x
  FROM a{k}, (SELECT unnest(range(1, (SELECT max(len(part)) FROM p) + 1)) AS i) GROUP BY ALL),
c{k + 1} AS MATERIALIZED (SELECT c.pos, c.e, coalesce(any_value(m.part), any_value(c.part)) AS part FROM c{k} c
       LEFT JOIN (SELECT pos, e, list(x ORDER BY i) AS part FROM s{k} GROUP BY pos, e) m ON m.pos = c.pos AND m.e = c.e GROUP BY c.pos, c.e)"""
    return f"""
WITH v AS MATERIALIZED (
  SELECT vec_id, label, [floor(4096 * x::DOUBLE)::BIGINT FOR x IN embedding] AS w, row_number() OVER (ORDER BY vec_id) AS id
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS MATERIALIZED (SELECT id, pos, w[pos * len(w) // {PARTS} + 1 : (pos + 1) * len(w) // {PARTS}] AS part FROM v, (SELECT unnest(range({PARTS})) AS pos)),
c0 AS (SELECT pos, id - 1 AS e, part FROM p WHERE id <= {ENTRIES}){steps},
z AS ({nearest.format(k=ROUNDS)}),
r AS (SELECT id, string_agg(printf('%02x', best.e), '' ORDER BY pos) AS code, sum(best.d)::BIGINT AS error FROM z GROUP BY id),
h AS (SELECT sha256(string_agg(array_to_string(part, ','), ',' ORDER BY pos, e)) AS codebooks_sha256 FROM c{ROUNDS})
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM v JOIN r USING (id) CROSS JOIN h
"""


OP12_SQL = _sql()
