"""Whole texts as byte arrays: the vectorised helpers that the Arrow tasks share.

A task sees an Arrow batch and works on pieces of it (``pieces``), so that its memory
follows one piece or one document, whichever is larger, and never the partition.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

PIECE_BYTES = 1 << 19
#: Rows of an Arrow batch, in place of Spark's own 10,000, as rows are whole texts.
BATCH_ROWS = 1000
_BOUND = "spark.sql.execution.arrow.maxRecordsPerBatch"

_BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2**64
_BYTE = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def arrow_map(df: DataFrame, task: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str | StructType) -> DataFrame:
    """``df.mapInArrow``, with this package on the workers' path where they run on this machine.

    On a cluster the package is shipped with the job (``--py-files``). Rows are whole texts,
    so batches have fewer of them; a session that sets its own bound keeps it.
    """
    if df.sparkSession.conf.get(_BOUND, None) is None:
        df.sparkSession.conf.set(_BOUND, str(BATCH_ROWS))
    context = df.sparkSession.sparkContext
    if context.master.startswith("local"):
        root, known = str(Path(__file__).resolve().parents[2]), context.environment.get("PYTHONPATH", "")
        if root not in known.split(os.pathsep):
            context.environment["PYTHONPATH"] = os.pathsep.join(x for x in (root, known) if x)
    return df.mapInArrow(task, schema)


def pieces(batch: pa.RecordBatch, text: str = "text", most: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive rows of ``batch`` with at most ``most`` bytes of text, one row at least."""
    if not batch.num_rows:
        return
    sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(text)), 0), dtype=np.int64)
    ends = np.cumsum(sizes)
    first = 0
    while first < len(ends):
        before = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, before + most, side="right")))
        yield batch.slice(first, last - first)
        first = last


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts one after the other, and the n + 1 bounds of the texts. Null is empty."""
    column = pc.fill_null(column.cast(pa.binary()), b"")
    bounds = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    data = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]]
    return data, bounds - bounds[0]


def byte_class(*ranges: tuple[int, int]) -> np.ndarray:
    """A table of 256 booleans, false inside the (inclusive) ranges."""
    table = np.ones(256, bool)
    for low, high in ranges:
        table[low : high + 1] = False
    return table


#: Bytes of `[^\x20\x09-\x0D]+`; bytes of other characters are 0x80 and above in UTF-8.
NOT_BLANK = byte_class((0x20, 0x20), (0x09, 0x0D))
#: Bytes of `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` after A-Z became a-z.
ALNUM = byte_class((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def words(data: np.ndarray, bounds: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and the n + 1 bounds of the texts in words. No word crosses texts."""
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = kind[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[bounds] = True
    here, before = inside[1:].view(bool), inside[:-1].view(bool)
    starts = np.flatnonzero(here & (~before | edge))
    ends = np.flatnonzero(before & (~here | edge))
    return starts, ends, np.searchsorted(starts, bounds)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits after which all bits depend on all bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Rolling:
    """Hashes of any stretch of ``data`` in constant time each: a polynomial modulo 2**64, mixed."""

    _powers = np.ones(1, np.uint64)
    _inverses = np.ones(1, np.uint64)

    @classmethod
    def _upto(cls, n: int) -> None:
        if len(cls._powers) <= n:
            size = max(n + 1, PIECE_BYTES + 1)
            inverse = np.uint64(pow(int(_BASE), -1, 2**64))
            for name, base in (("_powers", _BASE), ("_inverses", inverse)):
                table = np.full(size, base, np.uint64)
                table[0] = 1
                setattr(cls, name, np.cumprod(table, dtype=np.uint64))

    def __init__(self, data: np.ndarray):
        self._upto(len(data))
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTE[data] * self._powers[: len(data)], out=self.sums[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mixed((self.sums[ends] - self.sums[starts]) * self._inverses[starts] + (ends - starts).astype(np.uint64))


def shingles(hashes: np.ndarray, bounds: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of ``n`` consecutive words and the n + 1 bounds of the texts among them.

    A text of fewer words is one shingle, a text without words has none.
    """
    counts = np.diff(bounds)
    number = np.where(counts >= n, counts - n + 1, (counts > 0).astype(np.int64))
    text = np.repeat(np.arange(len(counts)), number)
    first = np.concatenate([[0], np.cumsum(number)])
    at = np.arange(first[-1]) - first[text] + bounds[:-1][text]
    size = np.minimum(counts, n)[text]
    out = size.astype(np.uint64)
    padded = np.concatenate([hashes, np.zeros(n, np.uint64)])
    for k in range(n):
        out = mixed(out * _BASE + np.where(k < size, padded[at + k], np.uint64(0)))
    return out, first


def distinct_per_text(tokens: np.ndarray, first: np.ndarray) -> list[np.ndarray]:
    """The distinct tokens of each text, ascending. ``first``: the n + 1 bounds of the texts among the tokens."""
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        own = np.sort(tokens[a:b])
        out.append(own[np.concatenate([[True], own[1:] != own[:-1]])] if b > a else own)
    return out
