"""SentencePiece encoding by sampling over the piece lattice, and lossless decoding.

A text may be cut into pieces in many ways. A segmentation has the probability that the
product of its pieces' weights gives it, to the power of ``alpha`` (Kudo, Subword
Regularization, 2018). It is sampled exactly: forward filtering sums the weights of all
ways from the start to every place, backward sampling walks from the end to the start and
picks each piece in proportion to the ways that lead through it.

The draws are a hash of the row's key, the number of the stretch in the text and the step,
so that a row gets the same segmentation in every run, whatever batch or task it meets.

All work is on arrays of bytes. A text falls into stretches at places that no piece spans;
each different stretch of a batch is filtered once, and all stretches step back together.

Model: the public vocabulary is a BPE one, whose scores are minus the rank of a piece; a
piece of rank r weighs 1 / (r + 10). Characters without a piece become byte pieces, and so
does a literal U+2581, which the vocabulary uses to mark blanks: decoding gives back every
text exactly.

Defined cases: the empty text has no pieces; null stays null, both ways; a null key draws
like any other key; every row stands by itself, so repeated rows need no rule (equal keys
and texts have equal pieces); ids that don't come from `encode` and make no valid UTF-8 are
decoded with replacement characters; of paths that weigh alike the draw decides; very long texts
are cut into stretches, as the module says, and coded whole; an empty table stays empty; other columns are passed through.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegauge.llm.batches import Rolling, arrow_map, mixed, pieces, utf8

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
ALPHA = 0.5
SEED = 20240501
SPACE = 0x20
BLANK = "▁"
#: Text bytes sampled at once. The arcs of a piece take some hundred times its size in a worker; pieces of 1 MB
#: took 100 MB more per worker and, with the workers of the stages before, an executor beyond its memory.
_PIECE_BYTES = 1 << 17
_SLOT_BITS = 21
_SLOT = np.uint64((1 << _SLOT_BITS) - 1)
_SHIFTS = (np.uint64(43), np.uint64(20))


@dataclass
class Vocabulary:
    """What sampling and decoding need of a model; a few megabytes, whatever the input."""

    hashes: np.ndarray  # of the usual pieces
    ids: np.ndarray
    weights: np.ndarray  # logarithms
    slots: np.ndarray  # two tables of pieces, by different bits of their hash; -1 where there is none
    lengths: np.ndarray  # that occur, in bytes
    byte_ids: np.ndarray
    byte_weight: float
    adjacent: np.ndarray  # byte pairs that stand inside some piece
    content: np.ndarray  # bytes of all ids, one after the other
    first: np.ndarray


def load(path: str = MODEL, alpha: float = ALPHA) -> Vocabulary:
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    known: dict[bytes, tuple[int, float]] = {}
    content: list[bytes] = []
    byte_ids = np.full(256, -1, np.int64)
    for i in range(model.vocab_size()):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            value = int(piece[3:-1], 16)
            byte_ids[value] = i
            content.append(bytes([value]))
        elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
            content.append(b"")
        else:
            own = piece.replace(BLANK, " ").encode()
            content.append(own)
            known[own] = (i, -alpha * float(np.log(10.0 - model.get_score(i))))
    if (byte_ids < 0).any():
        raise ValueError("the model must have a piece for every byte")
    adjacent = np.zeros((256, 256), bool)
    for own in known:
        for a, b in zip(own, own[1:]):
            adjacent[a, b] = True
    joined = np.frombuffer(b"".join(known), np.uint8)
    ends = np.cumsum([len(x) for x in known])
    starts = ends - [len(x) for x in known]
    hashes = Rolling(joined).of(starts, ends)
    ids, weights = (np.array(x) for x in zip(*known.values(), strict=True))
    slots = np.full((2, 1 << _SLOT_BITS), -1, np.int32)
    left = np.arange(len(hashes))
    for table, shift in zip(slots, _SHIFTS, strict=True):
        at = hashes[left] >> shift & _SLOT
        table[at] = left
        left = left[table[at] != left]
    if len(left):
        raise ValueError("the slots are too few for this many pieces")
    sizes = np.array([len(x) for x in content])
    return Vocabulary(
        hashes,
        ids,
        weights,
        slots,
        np.unique(ends - starts),
        byte_ids,
        -alpha * float(np.log(10.0 + len(known))),
        adjacent,
        np.frombuffer(b"".join(content), np.uint8),
        np.concatenate([[0], np.cumsum(sizes)]),
    )


def _arcs(data: np.ndarray, bounds: np.ndarray, v: Vocabulary) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Begin, end, id and weight of all pieces inside the stretches, by end."""
    rolling = Rolling(data)
    starts_char = np.append((data & 0xC0) != 0x80, True)
    chars = np.flatnonzero(starts_char)
    after = np.zeros(len(data), np.int64)  # where the character that starts here ends
    after[chars[:-1]] = chars[1:]
    places = chars[:-1]
    room = np.repeat(bounds[1:], np.diff(bounds))[places] - places
    begin, end, found = [], [], []
    for size in v.lengths.tolist():
        fit = room >= size
        places, room = places[fit], room[fit]
        at = places[starts_char[places + size]]
        h = rolling.of(at, at + size)
        for table, shift in zip(v.slots, _SHIFTS, strict=True):
            k = table[h >> shift & _SLOT]
            some = np.flatnonzero(k >= 0)
            some = some[v.hashes[k[some]] == h[some]]
            begin.append(at[some])
            end.append(at[some] + size)
            found.append(k[some])
    begin, end, found = (np.concatenate(x) for x in (begin, end, found))
    # Characters that are no piece themselves: their bytes.
    whole = np.zeros(len(data), bool)
    whole[begin[end == after[begin]]] = True
    at = np.flatnonzero(np.repeat(~whole[chars[:-1]], np.diff(chars)))
    begin, end = np.concatenate([begin, at]), np.concatenate([end, at + 1])
    ids = np.concatenate([v.ids[found], v.byte_ids[data[at]]])
    weights = np.concatenate([v.weights[found], np.full(len(at), v.byte_weight)])
    order = np.argsort((end << 8) - (end - begin))
    return begin[order], end[order], ids[order], weights[order]


def _filtered(bounds: np.ndarray, begin: np.ndarray, end: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first arc of every place that is an end, and for each arc the running probability among those with its end.

    The end of a stretch and the start of the next are one place, but the weight of the ways
    to a start is 0 (one way, no piece); so ``ways`` holds the place as an end. Every sum
    stays within one place: results don't hang on what else the batch holds.
    """
    ways = np.zeros(bounds[-1] + 1)
    stretch = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))[begin]
    inner = begin > bounds[stretch]
    node = np.flatnonzero(np.concatenate([[True], end[1:] != end[:-1]]))
    size = np.diff(np.append(node, len(end)))
    depth = (end - bounds[stretch])[node]
    turn = np.argsort(depth, kind="stable")
    steps = np.flatnonzero(np.concatenate([[True], np.diff(depth[turn]) != 0]))
    share = np.empty(len(end))
    for a, b in zip(steps, np.append(steps[1:], len(turn)), strict=True):
        nodes = turn[a:b]
        own = size[nodes]
        first = np.concatenate([[0], np.cumsum(own)])
        arcs = np.arange(first[-1]) + np.repeat(node[nodes] - first[:-1], own)
        x = weight[arcs] + np.where(inner[arcs], ways[begin[arcs]], 0.0)
        top = np.maximum.reduceat(x, first[:-1])
        x = np.exp(x - np.repeat(top, own))
        sums = np.add.reduceat(x, first[:-1])
        ways[end[node[nodes]]] = top + np.log(sums)
        share[arcs] = x / np.repeat(sums, own)
    more, k = node[size > 1], 1
    while len(more):
        share[more + k] += share[more + k - 1]
        k += 1
        more = node[size > k]
    share[np.append(node[1:], len(end)) - 1] = 1.0  # the last of each place takes what rounding leaves
    arc_of = np.zeros(bounds[-1] + 1, np.int64)
    arc_of[end[node]] = node
    return arc_of, share


def sample(data: np.ndarray, bounds: np.ndarray, seeds: np.ndarray, v: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Piece ids of all texts, and the bounds of the texts among them. Texts are given without the blank in front."""
    empty = np.diff(bounds) == 0
    at = bounds[:-1][~empty]
    data = np.insert(data, at, SPACE)
    bounds = bounds + np.concatenate([[0], np.cumsum(~empty)])
    if not len(data):
        return np.zeros(0, np.int32), np.zeros(len(bounds), np.int64)
    cut = np.ones(len(data) + 1, bool)
    cut[1:-1] = ~v.adjacent[data[:-1], data[1:]] & ((data[1:] & 0xC0) != 0x80)
    cut[bounds] = True
    starts = np.flatnonzero(cut)
    starts, ends = starts[:-1], starts[1:]
    which, distinct = pd.factorize(Rolling(data).of(starts, ends))
    where = np.empty(len(distinct), np.int64)
    where[which[::-1]] = np.arange(len(which))[::-1]
    size = (ends - starts)[where]
    base = np.concatenate([[0], np.cumsum(size)])
    distinct = data[np.arange(base[-1]) + np.repeat(starts[where] - base[:-1], size)]
    begin, end, ids, weight = _arcs(distinct, base, v)
    arc_of, running = _filtered(base, begin, end, weight)

    text = np.searchsorted(bounds, starts, side="right") - 1
    number = (np.arange(len(starts)) - np.searchsorted(starts, bounds[:-1])[text]).astype(np.uint64)
    state = mixed(seeds[text] + number * np.uint64(0x9E3779B97F4A7C15))
    stop, place = base[which], base[which + 1]
    alive, steps, chosen = np.arange(len(starts)), [], []
    count = np.zeros(len(starts), np.int64)
    while len(alive):
        turn = np.uint64(len(steps) * 0xD1B54A32D192ED03 & 0xFFFFFFFFFFFFFFFF)
        draw = (mixed(state[alive] + turn) >> np.uint64(11)) * 2.0**-53
        arc = arc_of[place[alive]]
        past = np.flatnonzero(draw >= running[arc])
        while len(past):
            arc[past] += 1
            past = past[draw[past] >= running[arc[past]]]
        steps.append(alive)
        chosen.append(ids[arc])
        place[alive] = begin[arc]
        count[alive] += 1
        alive = alive[place[alive] > stop[alive]]
    first = np.concatenate([[0], np.cumsum(count)])
    out = np.empty(first[-1], np.int32)
    for k, (who, what) in enumerate(zip(steps, chosen, strict=True)):
        out[first[1:][who] - 1 - k] = what
    return out, first[np.searchsorted(starts, bounds)]


def restore(ids: np.ndarray, first: np.ndarray, v: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, without the blank in front, and their bounds."""
    size = (v.first[1:] - v.first[:-1])[ids]
    at = np.concatenate([[0], np.cumsum(size)])
    data = v.content[np.arange(at[-1]) + np.repeat(v.first[:-1][ids] - at[:-1], size)]
    bounds = at[first]
    lead = np.zeros(len(bounds) - 1, bool)
    some = np.diff(bounds) > 0
    lead[some] = data[bounds[:-1][some]] == SPACE
    data = np.delete(data, bounds[:-1][lead])
    return data, bounds - np.concatenate([[0], np.cumsum(lead)])


def _same(data: np.ndarray, bounds: np.ndarray, other: np.ndarray, other_bounds: np.ndarray) -> np.ndarray:
    """Which texts are equal, byte for byte."""
    if len(data) == len(other) and (bounds == other_bounds).all() and (data == other).all():
        return np.ones(len(bounds) - 1, bool)
    pairs = zip(bounds[:-1], bounds[1:], other_bounds[:-1], other_bounds[1:], strict=True)
    return np.array([data[a:b].tobytes() == other[c:d].tobytes() for a, b, c, d in pairs], bool)


def _valid(column: pa.Array) -> pa.Array | None:
    return column.is_valid() if column.null_count else None


def _lists(first: np.ndarray, values: np.ndarray, valid: pa.Array | None) -> pa.Array:
    mask = None if valid is None else pa.array(~np.asarray(valid))
    return pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(values, pa.int32()), mask=mask)


def encode(
    rows: DataFrame, key: str = "doc_id", text: str = "text", to: str = "ids", model: str = MODEL, alpha: float = ALPHA, seed: int = SEED, check: str | None = None
) -> DataFrame:
    """``rows`` and the sampled piece ids of ``text``, in the column ``to`` (replaced if there is one).

    ``check`` names one more column: whether the ids, decoded at once, give back the text.
    """
    shared = rows.sparkSession.sparkContext.broadcast(load(model, alpha))
    columns = [c for c in rows.columns if c not in (to, check)]
    names = [f"c{i}" for i in range(len(columns))]
    inner = rows.select(*[rows[c].alias(n) for c, n in zip(columns, names, strict=True)], F.xxhash64(F.col(key).cast("string"), F.lit(seed)).alias("seed"))
    content = names[columns.index(text)]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, content, _PIECE_BYTES):
                data, bounds = utf8(piece.column(content))
                ids, first = sample(data, bounds, piece.column("seed").to_numpy().view(np.uint64), shared.value)
                made = [_lists(first, ids, _valid(piece.column(content)))]
                if check:
                    made.append(pa.array(_same(data, bounds, *restore(ids, first, shared.value))))
                yield pa.RecordBatch.from_arrays([*[piece.column(n) for n in names], *made], names=[*names, "made", "same"][: len(names) + len(made)])

    fields = [T.StructField(n, inner.schema[n].dataType) for n in names] + [T.StructField("made", T.ArrayType(T.IntegerType()))]
    schema = T.StructType(fields + [T.StructField("same", T.BooleanType())] * bool(check))
    out = arrow_map(inner, task, schema)
    named = [F.col(n).alias(c) for n, c in zip(names, columns, strict=True)]
    return out.select(*named, F.col("made").alias(to), *([F.col("same").alias(check)] if check else []))


def decode(rows: DataFrame, ids: str = "ids", to: str = "decoded", model: str = MODEL) -> DataFrame:
    """``rows`` and the text of the piece ids in ``ids``, in the column ``to`` (replaced if there is one)."""
    shared = rows.sparkSession.sparkContext.broadcast(load(model))
    columns = [c for c in rows.columns if c != to]
    names = [f"c{i}" for i in range(len(columns))]
    inner = rows.select(*[rows[c].alias(n) for c, n in zip(columns, names, strict=True)])
    source = names[columns.index(ids)]

    def texts(column: pa.Array) -> pa.Array:
        first = np.concatenate([[0], np.cumsum(np.asarray(column.value_lengths().fill_null(0), dtype=np.int64))])
        data, bounds = restore(column.flatten().to_numpy(), first, shared.value)
        buffers = [None, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))]
        raw = pa.Array.from_buffers(pa.binary(), len(column), buffers)
        try:
            out = raw.cast(pa.string())
        except pa.ArrowInvalid:
            out = pa.array([x.as_py().decode(errors="replace") for x in raw], pa.string())
        valid = _valid(column)
        return out if valid is None else pa.compute.if_else(valid, out, None)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.cumsum(np.asarray(batch.column(source).value_lengths().fill_null(0), dtype=np.int64))
            first = 0
            while first < batch.num_rows:
                before = sizes[first - 1] if first else 0
                last = max(first + 1, int(np.searchsorted(sizes, before + _PIECE_BYTES // 4, side="right")))
                piece = batch.slice(first, last - first)
                yield pa.RecordBatch.from_arrays([*[piece.column(n) for n in names], texts(piece.column(source))], names=[*names, "made"])
                first = last

    schema = T.StructType([T.StructField(n, inner.schema[n].dataType) for n in names] + [T.StructField("made", T.StringType())])
    out = arrow_map(inner, task, schema)
    return out.select(*[F.col(n).alias(c) for n, c in zip(names, columns, strict=True)], F.col("made").alias(to))


def op4_piece_sampling(spark, sf_dir: str) -> DataFrame:
    """The sampled pieces of every document, and whether decoding gives back its text."""
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    coded = decode(encode(documents))
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_pieces"), "ids", F.col("text").eqNullSafe(F.col("decoded")).alias("lossless"))
