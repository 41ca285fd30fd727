"""SimHash near duplicates, with candidates by pigeonring chains.

A text's fingerprint has a bit set if more than half of its shingles' hashes have it.
Fingerprints are linked when at most `DISTANCE` = 3 of their 64 bits differ; a class is what
links connect.

Candidates follow the pigeonring principle (Qin and Xiao, Pigeonring, 2018): put the 4
segments of 16 bits in a ring. If two fingerprints differ in 3 bits or fewer, some segment
starts a chain in which the first l segments together differ in no more than l * 3 / 4 bits,
rounded down, for every l: in 0, 1, 2 and 3. (The pigeonhole principle asks for l = 1 only.)

1. Equal fingerprints are one node.
2. A node goes to one cell for each start of a chain and each bit of its second segment: the
   cell's name is the first two segments with that bit blanked. So nodes that meet in a cell
   agree in the first segment and differ in one bit of the second at most. A pair is tried in
   the cell whose blanked bit is the one that differs (in the first such cell if none does).
3. Cells in which no pair can be tried are dropped by a count, before any list is made.
4. Pairs must keep the budget of three segments, then that of all four, the full check. A
   search from node to node leaves a spanning tree of each class in the cell, not all pairs.
5. A cell of more than `CELL` nodes is cut further by the same chain: by the third segment
   with two of its bits blanked. Nodes that meet there differ in 19 given bits at most, so
   such a group is bounded, and is searched by looking up what a node's neighbours would be.

Every step is exact, and no group has to fit a task but those of a fixed bound.

Defined cases: null and empty texts, and texts without words, have fingerprint zero, which is
linked like any other; a text of fewer words than a shingle is one shingle; long texts are
hashed in parts; rows without id take part, and a class without any id has none; rows that
repeat id or text give a result each; a class is named by its smallest id; an empty table
gives no rows; columns other than the two named ones are ignored.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.batches import LOWER, NOT_BLANK, arrow_map, pieces, utf8, words
from tidegauge.llm.components import components
from tidegauge.llm.decontam import small
from tidegauge.llm.skew import attach
from tidegauge.session import stored

DISTANCE = 3
SEGMENTS, WIDTH = 4, 16
SEED = 42
#: Nodes of a cell that are searched in one group.
CELL = 1 << 15
#: Hashes whose bits are counted together.
_PART = 1 << 17

_SEGMENT = (1 << WIDTH) - 1
_THREE = np.uint64((1 << 3 * WIDTH) - 1)
#: Pairs of bits of the third segment.
_PAIRS = [(1 << b) | (1 << c) for b, c in itertools.combinations(range(WIDTH), 2)]


def fingerprints(data: np.ndarray, bounds: np.ndarray, n: int) -> np.ndarray:
    """The fingerprints of texts, given as bytes and their bounds."""
    data = LOWER[data]
    starts, ends, first = words(data, bounds, NOT_BLANK)
    # Words with one blank behind each, whatever stood between them.
    inside = NOT_BLANK[data]
    last = np.zeros(len(data) + 1, np.int64)
    spaced = np.zeros(int(inside.sum()) + len(starts), np.uint8)
    np.cumsum(inside, out=last[1:])
    number = np.arange(len(starts))
    spaced[:] = 32
    spaced[np.arange(last[-1]) + np.repeat(number, ends - starts)] = data[inside]
    begin, stop = last[starts] + number, last[ends] + number
    counts = np.diff(first)
    shingles = np.where(counts >= n, counts - n + 1, (counts > 0).astype(np.int64))
    text = np.repeat(np.arange(len(counts)), shingles)
    bound = np.concatenate([[0], np.cumsum(shingles)])
    at = np.arange(bound[-1]) - bound[text] + first[:-1][text]
    low, high = begin[at], stop[at + np.minimum(counts, n)[text] - 1]
    raw, of = spaced.tobytes(), xxhash.xxh64_intdigest
    totals = np.zeros((len(counts), 64), np.int64)
    for a in range(0, len(at), _PART):
        b = min(a + _PART, len(at))
        hashes = np.fromiter((of(raw[x:y], SEED) for x, y in zip(low[a:b].tolist(), high[a:b].tolist(), strict=True)), np.uint64, b - a)
        bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        own = np.flatnonzero(np.concatenate([[True], text[a + 1 : b] != text[a : b - 1]]))
        totals[text[a:b][own]] += np.add.reduceat(bits, own, axis=0, dtype=np.int64)
    most = (2 * totals > shingles[:, None]).astype(np.uint8)
    return np.packbits(most, axis=1, bitorder="little").view("<u8").astype(np.uint64).reshape(-1)


def _marked(n: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch):
                made = fingerprints(*utf8(piece.column("text")), n)
                yield pa.RecordBatch.from_arrays([piece.column("id"), pa.array(made.view(np.int64))], names=["id", "fp"])

    return task


def _entries(nodes: DataFrame) -> DataFrame:
    """``cell``, ``ring`` (the fingerprint turned so that the chain comes first) and ``side`` (the blanked bit), for all cells of all nodes."""
    starts = F.explode(F.array(*[F.lit(WIDTH * s) for s in range(SEGMENTS)]))
    turned = nodes.select("fp", starts.alias("turn")).select("turn", F.expr("shiftrightunsigned(fp, turn) | shiftleft(fp, 64 - turn)").alias("ring"))
    blanked = turned.select("turn", "ring", F.explode(F.array(*[F.lit(b) for b in range(WIDTH)])).alias("bit"))
    two = F.col("ring").bitwiseAND((1 << 2 * WIDTH) - 1)
    name = two.bitwiseAND(F.bitwise_not(F.expr(f"shiftleft(1L, {WIDTH} + bit)")))
    cell = name.bitwiseOR(F.shiftleft((F.col("turn") + F.col("bit")).cast("long"), 2 * WIDTH))
    return blanked.select(cell.alias("cell"), "ring", F.expr(f"cast(shiftright(ring, {WIDTH} + bit) & 1 as int)").alias("side"))


def _fits(x: np.ndarray) -> np.ndarray:
    """Whether differences keep the budgets of three and of four segments (those of one and two are the cell's)."""
    out = np.bitwise_count(x & _THREE) <= 2
    out[out] = np.bitwise_count(x[out]) <= DISTANCE
    return out


def _tree(ring: np.ndarray, must: np.uint64) -> list[tuple[int, int]]:
    """Edges (places in ``ring``, distinct) that connect what links connect. ``must``: a bit that linked nodes differ in, or 0."""
    if len(ring) == 2:
        x = int(ring[0] ^ ring[1])
        fits = (x & int(_THREE)).bit_count() <= 2 and x.bit_count() <= DISTANCE and (not must or x & int(must))
        return [(0, 1)] if fits else []
    differ = int(np.bitwise_or.reduce(ring ^ ring[0]))
    bits = [b for b in range(64) if differ >> b & 1]
    if len(bits) <= 20 and len(ring) > 64 and len(bits) ** 3 // 6 < len(ring):
        return _looked_up(ring, bits, must)
    left, edges, queue = np.arange(1, len(ring)), [], [0]
    while len(left):
        if not queue:
            queue, left = [int(left[0])], left[1:]
            continue
        node = queue.pop()
        x = ring[left] ^ ring[node]
        fits = _fits(x)
        if must:
            fits &= (x & must) != 0
        met = left[fits].tolist()
        edges += [(node, other) for other in met]
        queue += met
        left = left[~fits]
    return edges


def _looked_up(ring: np.ndarray, bits: list[int], must: np.uint64) -> list[tuple[int, int]]:
    """As `_tree`, for nodes that differ in ``bits`` only: a table says which of all values are there."""
    place = np.zeros(len(ring), np.int64)
    for i, b in enumerate(bits):
        place |= ((ring >> np.uint64(b)) & np.uint64(1)).astype(np.int64) << i
    there = np.full(1 << len(bits), -1, np.int64)
    there[place] = np.arange(len(ring))
    steps = []
    for k in range(1, DISTANCE + 1):
        for some in itertools.combinations(range(len(bits)), k):
            x = sum(1 << bits[i] for i in some)
            if (x & int(_THREE)).bit_count() <= 2 and (not must or x & int(must)):
                steps.append(sum(1 << i for i in some))
    steps = np.array(steps, np.int64)
    edges = []
    for start in range(len(ring)):
        if there[place[start]] < 0:
            continue
        there[place[start]] = -1
        queue = [start]
        while queue:
            node = queue.pop()
            near = place[node] ^ steps
            met = there[near]
            met = met[met >= 0]
            there[place[met]] = -1
            edges += [(node, other) for other in met.tolist()]
            queue += met.tolist()
    return edges


def _searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task: the edges of each group (cell, rings), as fingerprints."""
    for batch in batches:
        if not batch.num_rows:
            continue
        cell = batch.column("cell").to_numpy()
        lists = batch.column("rings")
        ring = lists.flatten().to_numpy().view(np.uint64)
        bound = np.concatenate([[0], np.cumsum(np.asarray(lists.value_lengths(), dtype=np.int64))])
        number = cell >> 2 * WIDTH  # the start of the chain and the blanked bit
        bit, turn = number % WIDTH, number // WIDTH * WIDTH
        must = np.where(bit > 0, np.uint64(1) << (WIDTH + bit).astype(np.uint64), np.uint64(0))
        a, b, turns = [], [], []
        for i in range(batch.num_rows):
            own = ring[bound[i] : bound[i + 1]]
            for x, y in _tree(own, must[i]):
                a.append(bound[i] + x)
                b.append(bound[i] + y)
                turns.append(turn[i])
        back = np.array(turns, np.uint64)
        # Turned back to where they were; a turn by 64 is none.
        ends = [(r << back) | np.where(back > 0, r >> ((np.uint64(64) - back) % np.uint64(64)), np.uint64(0)) for r in (ring[np.array(x, np.int64)] for x in (a, b))]
        yield pa.RecordBatch.from_arrays([pa.array(e.view(np.int64)) for e in ends], names=["a", "b"])


def links(nodes: DataFrame, cell: int = CELL) -> DataFrame:
    """Edges (a, b) between fingerprints (``fp``, distinct) that connect what links connect."""
    entries = _entries(nodes)
    counts = entries.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.min("side").alias("low"), F.max("side").alias("high"))
    first = F.shiftright("cell", 2 * WIDTH) % WIDTH == 0
    counts = stored(counts.where((F.col("n") > 1) & (first | (F.col("low") < F.col("high")))).select("cell", "n"), "cells")
    usual, crowded = counts.where(F.col("n") <= cell).select("cell"), counts.where(F.col("n") > cell).select("cell")
    groups = entries.join(small(usual), "cell").groupBy("cell").agg(F.collect_list("ring").alias("rings"))
    schema = "a long, b long"
    edges = arrow_map(groups, _searched, schema)
    if crowded.isEmpty():
        return edges
    kept = F.array(*[F.lit(((1 << 3 * WIDTH) - 1) & ~(p << 2 * WIDTH)) for p in _PAIRS])
    cut = entries.join(small(crowded), "cell").select("cell", "ring", F.posexplode(kept).alias("pair", "mask"))
    blank = F.expr(f"~shiftleft(1L, {WIDTH} + cast(shiftright(cell, {2 * WIDTH}) % {WIDTH} as int))")
    cut = cut.groupBy("cell", "pair", F.col("ring").bitwiseAND(F.col("mask")).bitwiseAND(blank).alias("name")).agg(F.collect_list("ring").alias("rings"))
    return edges.union(arrow_map(cut.where(F.size("rings") > 1).select("cell", "rings"), _searched, schema))


def near_duplicates(docs: DataFrame, n: int = 3, key: str = "doc_id", text: str = "text", cell: int = CELL) -> DataFrame:
    """Per row: ``id``, ``fp`` (the fingerprint, as a signed number) and ``class`` (the smallest id that links reach)."""
    texts = docs.select(F.col(key).alias("id"), F.col(text).alias("text"))
    rows = stored(arrow_map(texts, _marked(n), f"id {texts.schema['id'].dataType.simpleString()}, fp long"), "fingerprints")
    nodes = stored(rows.groupBy("fp").agg(F.min("id").alias("low"), F.count(F.lit(1)).alias("rows")), "nodes")
    roots = components(links(nodes, cell))
    rooted = stored(nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp")), "rooted")
    lowest = rooted.groupBy("root").agg(F.min("low").alias("class"), F.count(F.lit(1)).alias("nodes"))
    named = attach(rooted, stored(lowest, "classes"), "root", "nodes").select("fp", "class", "rows")
    return attach(rows, stored(named, "named"), "fp", "rows")


def hexadecimal(fp: Column) -> Column:
    """16 lowercase digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def op11_pigeonring_simhash(spark, sf_dir: str) -> DataFrame:
    found = near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select(F.col("id").alias("doc_id"), hexadecimal(F.col("fp")).alias("fingerprint"), F.col("class").alias("component_id"))
