"""Sparse hashed features of whole texts, as rows of (index, value), and their way to the driver for a fit."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegauge.llm.batches import ALNUM, LOWER, Rolling, arrow_map, pieces, utf8, words
from tidegauge.llm.decontam import version_of
from tidegauge.session import stored


@dataclass
class Rows:
    """Sparse rows: ``index`` and ``value`` of all entries, and the n + 1 bounds of the rows among them."""

    index: np.ndarray
    value: np.ndarray
    first: np.ndarray

    def __len__(self) -> int:
        return len(self.first) - 1

    def part(self, rows: np.ndarray) -> Part:
        return Part(self, rows)

    def row(self) -> np.ndarray:
        return np.repeat(np.arange(len(self)), np.diff(self.first))

    def total(self, per_entry: np.ndarray) -> np.ndarray:
        """Sums of ``per_entry`` (one or more columns) by row."""
        out = np.zeros((len(self), *per_entry.shape[1:]))
        some = np.flatnonzero(self.first[1:] > self.first[:-1])
        if len(some):
            out[some] = np.add.reduceat(per_entry, self.first[:-1][some], axis=0)
        return out

    def take(self, rows: np.ndarray) -> Rows:
        size = np.diff(self.first)[rows]
        first = np.concatenate([[0], np.cumsum(size)])
        at = np.arange(first[-1]) + np.repeat(self.first[:-1][rows] - first[:-1], size)
        return Rows(self.index[at], self.value[at], first)


@dataclass
class Part:
    """Some of the rows of a larger table, which stay where they are."""

    rows: Rows
    chosen: np.ndarray

    def __len__(self) -> int:
        return len(self.chosen)

    def take(self, rows: np.ndarray) -> Rows:
        return self.rows.take(self.chosen[rows])

    def part(self, rows: np.ndarray) -> Part:
        return Part(self.rows, self.chosen[rows])


def _counted(per_text: list[np.ndarray], marks: list[np.ndarray] | None = None) -> Rows:
    """Distinct indices with the logarithm of their counts, each row of length 1; ``marks`` are more indices, of value 0.5."""
    index, value, first = [], [], [0]
    for i, own in enumerate(per_text):
        u, n = np.unique(own, return_counts=True)
        v = np.log1p(n)
        v /= max(np.sqrt((v * v).sum()), 1e-9)
        if marks is not None:
            u, v = np.append(u, marks[i]), np.append(v, np.full(len(marks[i]), 0.5))
        index.append(u)
        value.append(v)
        first.append(first[-1] + len(u))
    empty = np.zeros(0)
    return Rows(np.concatenate([empty.astype(np.int32), *index]).astype(np.int32), np.concatenate([empty, *value]).astype(np.float32), np.array(first))


def hashed_terms(data: np.ndarray, bounds: np.ndarray, bits: int) -> Rows:
    """Words and the first four and five bytes of longer words, in lower case, hashed to ``bits`` bits."""
    data = LOWER[data]
    starts, ends, first = words(data, bounds, ALNUM)
    rolling, shift = Rolling(data), np.uint64(64 - bits)
    terms = [rolling.of(starts, ends) >> shift]
    for k in (4, 5):
        longer = ends - starts > k
        head = rolling.of(starts, np.minimum(starts + k, ends)) + np.uint64(k << 60)
        terms.append(np.where(longer, head >> shift, terms[0]))
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        longer = ends[a:b] - starts[a:b]
        out.append(np.concatenate([terms[0][a:b], terms[1][a:b][longer > 4], terms[2][a:b][longer > 5]]).astype(np.int32))
    return _counted(out)


#: Upper bounds of the classes of a share of words.
_SHARES = np.array([0.01, 0.03, 0.06, 0.1, 0.15, 0.2, 0.3, 0.5])
MARKS = 2 * (len(_SHARES) + 1)
#: In so many slices the driver takes the features of a sample.
SLICES = 8


def _repeats(data: np.ndarray, bounds: np.ndarray) -> list[np.ndarray]:
    """Two marks for each text with words: the classes of the share of words that equal the word before, and any of the four before."""
    starts, ends, first = words(LOWER[data], bounds, ALNUM)
    h = Rolling(LOWER[data]).of(starts, ends)
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(first))
    same = np.zeros((2, len(h)), bool)
    for k in range(1, 5):
        hit = (h[k:] == h[:-k]) & (text[k:] == text[:-k])
        same[1, k:] |= hit
        if k == 1:
            same[0, k:] = hit
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        kinds = np.searchsorted(_SHARES, same[:, a:b].mean(axis=1)) if b > a else np.zeros(0, np.int64)
        out.append((kinds + np.arange(len(kinds)) * (len(_SHARES) + 1)).astype(np.int32))
    return out


def byte_trigrams(data: np.ndarray, bounds: np.ndarray, bits: int) -> Rows:
    """Runs of three bytes as they stand (case, marks and blanks included), hashed to ``bits`` bits, and how often words repeat close by."""
    wide = data.astype(np.uint32)
    code = (wide[:-2] | wide[1:-1] << 8 | wide[2:] << 16) if len(data) > 2 else np.zeros(0, np.uint32)
    code = ((code * np.uint32(0x9E3779B1)) >> np.uint32(32 - bits)).astype(np.int32)
    code = np.maximum(code, MARKS)  # the first indices are the marks'
    return _counted([code[a : max(a, b - 2)] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)], _repeats(data, bounds))


Extractor = Callable[[np.ndarray, np.ndarray, int], Rows]


def _extracting(extract: Extractor, bits: int):
    """A task: features as pairs of 16-bit halves of the index and 32-bit values, to be small on their way."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch):
                rows = extract(*utf8(piece.column("text")), bits)
                offsets = pa.array(rows.first, pa.int32())
                index = rows.index.astype(np.uint16).view(np.int16) if bits <= 16 else rows.index
                yield pa.RecordBatch.from_arrays(
                    [piece.column("id"), piece.column("version"), piece.column("label"), pa.ListArray.from_arrays(offsets, pa.array(index)), pa.ListArray.from_arrays(offsets, pa.array(rows.value))],
                    names=["id", "version", "label", "index", "value"],
                )

    return task


def collected(texts: DataFrame, extract: Extractor, bits: int) -> tuple[Rows, np.ndarray]:
    """Features and labels of ``texts`` (id, version, text, label), on the driver, by id and version.

    Only for a sample with a fixed bound on its rows (see `sampled_texts`). The features are
    stored and ordered by Spark; the driver takes them in `SLICES` slices and holds one Arrow
    table at a time beside the two arrays they end up in.
    """
    kind = texts.schema["id"].dataType.simpleString()
    labelled = texts.select("id", "version", "text", F.col("label").cast("int").alias("label"))
    number = "smallint" if bits <= 16 else "int"
    features = arrow_map(labelled, _extracting(extract, bits), f"id {kind}, version long, label int, index array<{number}>, value array<float>")
    features = stored(features, "features")
    sizes = features.select("id", "version", F.col("label"), F.size("index").alias("n")).toArrow()
    order = pc.sort_indices(sizes, [(c, "ascending") for c in ("id", "version", "label")]) if sizes.num_rows else pa.array([], pa.uint64())
    sizes = sizes.take(order)
    first = np.concatenate([[0], np.cumsum(sizes.column("n").to_numpy(), dtype=np.int64)])
    kind_of_index = np.uint16 if bits <= 16 else np.int32
    rows = Rows(np.empty(first[-1], kind_of_index), np.empty(first[-1], np.float32), first)
    labels = sizes.column("label").to_numpy()
    place = {key: i for i, key in enumerate(zip(*(sizes.column(c).to_pylist() for c in ("id", "version", "label")), strict=True))}
    del sizes, order
    part = F.pmod(F.xxhash64("version"), F.lit(SLICES))
    for number in range(SLICES if len(labels) else 0):
        table = features.where(part == number).toArrow()
        for batch in table.to_batches():
            bounds = np.concatenate([[0], np.cumsum(np.asarray(batch.column("index").value_lengths(), dtype=np.int64))])
            index, value = (batch.column(c).flatten().to_numpy(zero_copy_only=False) for c in ("index", "value"))
            keys = zip(*(batch.column(c).to_pylist() for c in ("id", "version", "label")), strict=True)
            for i, key in enumerate(keys):
                at, a, b = first[place[key]], bounds[i], bounds[i + 1]
                rows.index[at : at + b - a] = index[a:b].view(kind_of_index) if bits <= 16 else index[a:b]
                rows.value[at : at + b - a] = value[a:b]
        del table
        pa.default_memory_pool().release_unused()
    return rows, labels


def scored(rows: DataFrame, text: str, extract: Extractor, bits: int, score: Callable[[Rows], np.ndarray], to: str = "score") -> DataFrame:
    """``rows`` and the score of ``text``, in the column ``to`` (replaced if there is one). ``score`` must pickle small or hold a broadcast."""
    columns = [c for c in rows.columns if c != to]
    names = [f"c{i}" for i in range(len(columns))]
    content = names[columns.index(text)]
    inner = rows.select(*[rows[c].alias(n) for c, n in zip(columns, names, strict=True)])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, content):
                made = np.clip(score(extract(*utf8(piece.column(content)), bits)), 0.0, 1.0).astype(np.float64)
                yield pa.RecordBatch.from_arrays([*[piece.column(n) for n in names], pa.array(made)], names=[*names, "made"])

    schema = T.StructType([T.StructField(n, inner.schema[n].dataType) for n in names] + [T.StructField("made", T.DoubleType())])
    out = arrow_map(inner, task, schema)
    return out.select(*[F.col(n).alias(c) for n, c in zip(names, columns, strict=True)], F.col("made").alias(to))


def held_out(key: str) -> Column:
    """The fold that no fit may see: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def versions(documents: DataFrame, key: str, text: str) -> DataFrame:
    """``id``, ``version`` (a hash of the text) and ``text`` of all rows."""
    return documents.select(F.col(key).alias("id"), version_of(F.col(text)).alias("version"), F.col(text).alias("text"))


def sampled_texts(rows: DataFrame, most: int) -> DataFrame:
    """At most ``most`` different pairs (id, version) of ``rows`` (id, version, more columns): the same ones in every run.

    First one text of each id (that with the smallest hash), by the hash of the id, so that no id
    fills the sample; what room they leave goes to other texts. Rows without id are told apart by their texts.
    """
    pairs = stored(rows.select("id", "version").distinct(), "versions")
    nameless = F.when(F.col("id").isNull(), F.col("version"))
    firsts = pairs.groupBy("id", nameless.alias("nameless")).agg(F.min("version").alias("version"))
    by_id = F.when(F.col("id").isNull(), F.xxhash64("version")).otherwise(F.xxhash64("id"))
    firsts = _lowest(firsts, by_id, most).select("id", "version", F.lit(0).alias("turn"))
    # As many of all pairs as fit are enough to fill up with.
    others = _lowest(pairs, F.xxhash64("id", "version"), most).withColumn("turn", F.lit(1))
    both = firsts.union(others).groupBy("id", "version").agg(F.min("turn").alias("turn"))
    return both.orderBy("turn", F.xxhash64("id", "version"), "id", "version").limit(most).select("id", "version")


def _lowest(rows: DataFrame, by: Column, most: int) -> DataFrame:
    """The ``most`` rows (with id, version) of the lowest hash ``by``.

    A bound on the hash, from the number of rows, leaves little more than that of a table of
    any size before anything is ordered; if chance leaves too few, the bound is doubled.
    """
    total = rows.count()
    share = min(1.0, (1.5 * most + 100) / max(total, 1))
    while True:
        low = rows.where(by <= F.lit(int(share * (2**64 - 1025)) - 2**63)) if share < 1 else rows
        if share >= 1 or low.count() >= most:
            return low.orderBy(by, "id", "version").limit(most)
        share = min(1.0, 2 * share)


def with_texts(texts: DataFrame, sample: DataFrame) -> DataFrame:
    """``sample`` (id, version, label) with the texts (of ``texts``, see `versions`), a row each however often a text is repeated."""
    wanted = F.broadcast(sample.select(F.col("id").alias("__id"), F.col("version").alias("__version")).distinct())
    found = texts.join(wanted, F.col("id").eqNullSafe(F.col("__id")) & (F.col("version") == F.col("__version")), "left_semi")
    once = found.dropDuplicates(["id", "version"]).alias("t")
    pairs = F.broadcast(sample).alias("s")
    return once.join(pairs, F.col("t.id").eqNullSafe(F.col("s.id")) & (F.col("t.version") == F.col("s.version"))).select("t.id", "t.version", "t.text", "s.label")


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -60, 60)))
