"""Approximate nearest neighbours: a forest of random-projection trees, one queue for all trees.

A tree halves the vectors again and again by the median of their projections on a random
direction (the difference of two of them). A query walks all trees at once: the branches not
taken wait in one priority queue, by how far the query lies from the closest plane on their
wrong side, and the nearest branch of any tree goes on, until ``leaves`` leaves are reached.
The vectors in these leaves are compared exactly, in double precision.

The planes are fit on at most ``sample`` different vectors, chosen by hash, and on no more
than `SAMPLE_BYTES` of them (documented bounds, which also bound the broadcast forest: it has
``trees`` planes for every ``leaf`` vectors of the sample); every vector is indexed. Leaves hold about
``leaf`` vectors of the sample, so a larger table wants a larger sample, or fuller leaves.

Equal vectors are indexed once, with their ``k`` + 1 smallest ids: of more equal candidates a
query could not return any. Vectors with their leaves are dealt out to parts and queries with
theirs to chunks, both bounded in bytes (`MEET_BYTES`), and every part meets every chunk in one
group, which keeps only the ``k`` best of a query. So neither a vector nor a query is copied for
each leaf, and nothing but the forest is broadcast. A group looks up the vectors in a query's
leaves and leaves out, by cosines in single precision and a bound on their error, those that
can't be among its ``k`` best.

Defined cases: vectors that are null, empty, zero, or hold null or non-finite components
take no part, nor do those of another than the most common length (of equally common ones
the longest), or rows without id; rows that repeat id and vector are one row; a query never
returns its own id; ties go to the smaller id; with fewer than ``k`` others all are returned;
an empty table gives no rows; columns other than the two named ones are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tidegauge.llm.batches import arrow_map
from tidegauge.session import stored

TREES = 40
LEAF = 32
LEAVES = 640
SAMPLE = 60_000
#: Bytes of the sampled vectors, as the driver holds them in double precision.
SAMPLE_BYTES = 64 << 20
#: Bytes of the vectors, and of the queries, that meet in one group, each with its leaves.
MEET_BYTES = 32 << 20
#: Vectors of a part at least, where parts are made only to keep all cores busy.
PART = 512
K = 5


@dataclass
class Forest:
    """Complete trees of one depth. Node i of a tree has the children 2i + 1 and 2i + 2; its leaves follow the inner nodes."""

    normals: np.ndarray  # trees x inner nodes x dimensions
    offsets: np.ndarray
    counts: np.ndarray  # trees x leaves, of the sample

    @property
    def depth(self) -> int:
        return (self.counts.shape[1]).bit_length() - 1

    def leaf_of(self, vectors: np.ndarray) -> np.ndarray:
        """The leaf of each vector in each tree (vectors x trees). Vectors have length 1."""
        out = np.empty((len(vectors), len(self.normals)), np.int64)
        for t, (normals, offsets) in enumerate(zip(self.normals, self.offsets, strict=True)):
            node = np.zeros(len(vectors), np.int64)
            for _ in range(self.depth):
                side = np.einsum("ij,ij->i", vectors, normals[node]) > offsets[node]
                node = 2 * node + 1 + side
            out[:, t] = node - normals.shape[0]
        return out

    def search(self, vector: np.ndarray, leaves: int, least: int) -> list[tuple[int, int]]:
        """The first ``leaves`` leaves (tree, leaf) by the shared queue; more until one tree's have ``least`` vectors of the sample."""
        inner = self.normals.shape[1]
        margins = (self.normals @ vector - self.offsets).tolist()
        queue = [(-np.inf, t, 0) for t in range(len(self.normals))]
        found, seen, most = [], [0] * len(self.normals), 0
        while queue and (len(found) < leaves or most < least):
            far, t, node = heapq.heappop(queue)
            own = margins[t]
            while node < inner:
                margin = own[node]
                near = 2 * node + 1 + (margin > 0)
                heapq.heappush(queue, (max(far, abs(margin)), t, 4 * node + 3 - near))
                node = near
            found.append((t, node - inner))
            seen[t] += int(self.counts[t, node - inner])
            most = max(most, seen[t])
        return found


def fit(vectors: np.ndarray, trees: int = TREES, leaf: int = LEAF, seed: int = 17) -> Forest:
    """Trees over ``vectors`` (of length 1)."""
    rng = np.random.default_rng(seed)
    n, dims = vectors.shape
    depth = max(0, int(np.ceil(np.log2(max(n, 1) / leaf))))
    inner = (1 << depth) - 1
    normals, offsets = np.zeros((trees, inner, dims), np.float32), np.zeros((trees, inner), np.float32)
    counts = np.zeros((trees, inner + 1), np.int64)
    for t in range(trees):
        node = np.zeros(n, np.int64)
        for level in range(depth):
            first, size = (1 << level) - 1, 1 << level
            order = np.argsort(node, kind="stable")
            cuts = np.searchsorted(node[order], np.arange(first, first + size + 1))
            own = np.diff(cuts)
            pick = lambda: order[np.minimum(cuts[:-1] + (rng.random(size) * own).astype(np.int64), n - 1)]  # noqa: B023, E731
            direction = vectors[pick()] - vectors[pick()]
            length = np.linalg.norm(direction, axis=1, keepdims=True)
            random = rng.normal(size=direction.shape)
            direction = np.where(length > 1e-6, direction, random)
            direction /= np.linalg.norm(direction, axis=1, keepdims=True)
            normals[t, first : first + size] = direction
            along = np.einsum("ij,ij->i", vectors, normals[t][node])
            turn = order[np.lexsort((along[order], node[order]))]
            middle = turn[np.minimum((cuts[:-1] + cuts[1:]) // 2, n - 1)]
            offsets[t, first : first + size] = np.where(own > 0, along[middle], 0.0)
            node = 2 * node + 1 + (along > offsets[t][node])
        counts[t] = np.bincount(node - inner, minlength=inner + 1)
    return Forest(normals, offsets, counts)


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dims)


def _unit(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return (scaled / np.linalg.norm(scaled, axis=1, keepdims=True)).astype(np.float32)


def cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row, in double precision, always summed in one order.

    Vectors are first scaled by powers of two, which changes no digit, so that very large or
    small components neither overflow nor vanish when squared.
    """
    dot = lambda x, y: np.einsum("ij,ij->i", x, y)
    a, b = (np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, initial=0.0))[1][:, None]) for x in (a, b))
    return dot(a, b) / (np.sqrt(dot(a, a)) * np.sqrt(dot(b, b)))


def _top(query_id: int, query: np.ndarray, near: np.ndarray, met: np.ndarray, vectors: np.ndarray, cuts: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and scores of the ``k`` best of the vectors ``met``. ``near``: cosines with all vectors in single precision.

    ``slack`` is more than any error of ``near``. With ``need`` vectors at ``floor`` + ``slack`` or above by
    ``near``, those left out are below ``floor``; if they have ``k`` results at ``floor`` or above, none is missed.
    """
    slack, need = (vectors.shape[1] + 16) * 2.0**-23, k + 1
    rough = near[met].astype(np.float64)
    while True:
        floor = np.partition(rough, -need)[-need] - slack if need < len(met) else -np.inf
        taken = met[rough >= floor - slack]
        score = cosine(np.repeat(query[None], len(taken), axis=0), vectors[taken])
        own = np.repeat(np.arange(len(taken)), cuts[taken + 1] - cuts[taken])
        found, score = ids[_stretches(cuts[taken], cuts[taken + 1])], score[own]
        order = np.lexsort((found, -score))
        order = order[found[order] != query_id]
        found, score = found[order], score[order]
        new = np.concatenate([[True], (found[1:] != found[:-1]) | (score[1:] != score[:-1])])[: len(found)]
        found, score = found[new][:k], score[new][:k]
        if floor == -np.inf or (len(found) == k and score[-1] >= floor):
            return found, score
        need *= 4


def _stretches(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """All numbers from each start up to its end, one stretch after the other."""
    sizes = ends - starts
    return np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())


def _cuts(sizes: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])


def _meet(points: pa.Table, asked: pa.Table, dims: int, cells: int, k: int) -> pa.Table:
    """``query_id``, ``id`` and ``score`` of the ``k`` best that each query meets in its cells (leaves of all trees)."""
    whole = lambda table, name: table.column(name).combine_chunks()
    vectors, queries = _matrix(whole(points, "vector"), dims), _matrix(whole(asked, "query"), dims)
    units, asking = _unit(vectors), _unit(queries)
    in_cell = whole(points, "cells").flatten().to_numpy()
    member = (np.argsort(in_cell, kind="stable") // (len(in_cell) // len(units))).astype(np.int32)
    cuts = _cuts(np.bincount(in_cell, minlength=cells))
    ids, id_cuts = whole(points, "ids").flatten().to_numpy(), _cuts(whole(points, "ids").value_lengths().to_numpy())
    visited, visit_cuts = whole(asked, "cells").flatten().to_numpy(), _cuts(whole(asked, "cells").value_lengths().to_numpy())
    query_ids, best = whole(asked, "query_id").to_numpy(), []
    step = max(1, MEET_BYTES // (8 * len(units)))
    for first in range(0, len(asking), step):
        for q, near in enumerate(asking[first : first + step] @ units.T, first):
            at = visited[visit_cuts[q] : visit_cuts[q + 1]]
            seen = np.zeros(len(units), bool)
            seen[member[_stretches(cuts[at], cuts[at + 1])]] = True
            best.append(_top(query_ids[q], queries[q], near, np.flatnonzero(seen), vectors, id_cuts, ids, k))
    found = np.concatenate([ids for ids, _ in best])
    asker = np.repeat(query_ids, [len(ids) for ids, _ in best])
    return pa.table({"query_id": asker, "id": found, "score": np.concatenate([score for _, score in best])})


def _usable(vector: str) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.col(vector).isNotNull() & finite & F.exists(vector, lambda x: x != 0)


def nearest(
    vectors: DataFrame,
    queries: Column,
    k: int = K,
    key: str = "vec_id",
    vector: str = "embedding",
    trees: int = TREES,
    leaf: int = LEAF,
    leaves: int = LEAVES,
    sample: int = SAMPLE,
) -> DataFrame:
    """``query_id``, ``rank``, ``id`` and ``score`` (cosine) of the ``k`` nearest found; ``queries`` is a condition on the column ``id``."""
    spark = vectors.sparkSession
    rows = vectors.select(F.col(key).cast("long").alias("id"), F.col(vector).alias("vector")).where(F.col("id").isNotNull() & _usable("vector"))
    sizes = rows.groupBy(F.size("vector").alias("dims")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("dims")).first()
    schema = "query_id long, id long, score double"
    if sizes is None:
        return spark.createDataFrame([], schema).select("query_id", F.lit(1).alias("rank"), "id", "score")
    dims = sizes["dims"]
    rows = rows.where(F.size("vector") == dims).distinct()
    sample = max(1, min(sample, SAMPLE_BYTES // (8 * dims)))
    smallest = rows.withColumn("turn", F.dense_rank().over(W.partitionBy("vector").orderBy("id"))).where(F.col("turn") <= k + 1)
    points = stored(smallest.groupBy("vector").agg(F.array_sort(F.collect_set("id")).alias("ids")), "points")
    number = points.count()
    by_hash, share = F.xxhash64("vector"), min(1.0, (1.5 * sample + 100) / max(number, 1))
    # A bound on the hash leaves little more than the sample before anything is ordered.
    low = points.where(by_hash <= F.lit(int(share * (2**64 - 1025)) - 2**63)) if share < 1 else points
    low = points if low.count() < min(sample, number) else low
    fit_on = low.orderBy(by_hash, "vector").limit(sample).select("vector").toArrow().combine_chunks()
    matrix = np.concatenate([_matrix(c, dims) for c in fit_on.column("vector").chunks])
    forest = spark.sparkContext.broadcast(fit(_unit(matrix), trees, leaf))

    cells = forest.value.counts.size
    first_cell = np.arange(trees) * (cells // trees)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                cell = forest.value.leaf_of(_unit(_matrix(batch.column("vector"), dims))) + first_cell
                cell = pa.ListArray.from_arrays(pa.array(np.arange(len(cell) + 1) * trees, pa.int32()), pa.array(cell.ravel(), pa.int32()))
                yield pa.RecordBatch.from_arrays([cell, batch.column("ids"), batch.column("vector")], names=["cells", "ids", "vector"])

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                found = (forest.value.search(v, leaves, k + 1) for v in _unit(_matrix(batch.column("query"), dims)))
                cell = pa.array([np.array([first_cell[t] + leaf for t, leaf in f], np.int32) for f in found], pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([cell, batch.column("query_id"), batch.column("query")], names=["cells", "query_id", "query"])

    def meet(points: pa.Table, asked: pa.Table) -> pa.Table:
        if points.num_rows and asked.num_rows:
            return _meet(points, asked, dims, cells, k)
        return pa.table({"query_id": pa.array([], pa.int64()), "id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})

    element = points.schema["vector"].dataType.simpleString()
    indexed = arrow_map(points, index, f"cells array<int>, ids array<long>, vector {element}")
    asked = rows.where(queries).select(F.col("id").alias("query_id"), F.col("vector").alias("query"))
    asked = asked.repartition(2 * spark.sparkContext.defaultParallelism)  # a walk costs much more than its row weighs
    visits = stored(arrow_map(asked, walk, f"cells array<int>, query_id long, query {element}"), "visits")
    in_bytes = lambda n, each: max(1, -(-n * 4 * (dims + each) // MEET_BYTES))
    chunks = in_bytes(visits.count(), min(leaves, cells))
    parts = max(in_bytes(number, trees), min(-(-4 * spark.sparkContext.defaultParallelism // chunks), -(-number // PART)))
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    dealt = lambda n, *by: F.pmod(F.xxhash64(*by), F.lit(n)).cast("int")
    indexed = indexed.withColumn("part", dealt(parts, "vector")).withColumn("chunk", each(chunks))
    visits = visits.withColumn("chunk", dealt(chunks, "query_id", "query")).withColumn("part", each(parts))
    scored = indexed.groupBy("part", "chunk").cogroup(visits.groupBy("part", "chunk")).applyInArrow(meet, schema).distinct()
    best = W.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return scored.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "id", "score")


def op7_projection_forest(spark, sf_dir: str) -> DataFrame:
    found = nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("id") % 50 == 0)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")
