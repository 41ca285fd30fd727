"""Removal of byte strings that also start earlier, with Burrows-Wheeler transforms of bounded blocks.

Every byte is removed that a string of ``least`` bytes covers which also starts earlier: in a
document with a smaller id, or before it in the same one. The strings are judged on the
input. All strings are judged, none is sampled:

1. A string is dealt out by its minimiser, the stretch of `GRAM` bytes in it with the lowest
   hash. Neighbouring strings mostly share theirs; such a run travels as one row, without its
   bytes (a hash stands for them). Equal strings have equal minimisers at equal places.
2. Runs with equal bytes are resolved by their order: all but the first are repeats. Only
   minimisers that several different runs share go on, with one run of each kind.
3. These runs are cut into classes by the place of the minimiser, and dealt out anew by the
   bytes that all strings of a class have in common. The more runs share a minimiser, the
   narrower are the classes, down to two neighbouring strings, so that no group of different
   runs is large, however common a line is.
4. Blocks of whole groups are bounded in bytes. A block's suffixes are ordered, and its
   interval expansion (`bwt`) gives the suffixes that agree on ``least`` bytes; of these, all
   but the earliest are repeats.
5. Repeats are brought back to their documents, joined into spans and cut out.

Equal rows are folded before every shuffle, so a passage that stands in a third of all
documents sends one row for many texts, and groups are streamed, not gathered.

Defined cases: null and empty texts have no bytes and keep none; a missing id counts as the
smallest; rows that repeat id and text are one document (each row gives its result); rows
of one id with different texts are different documents, in the order of a hash of the text
(63 bits, with the id what a text is known by); texts of any length are cut into parts; an empty table gives no
rows; columns other than the two named ones are ignored. Ids must be whole numbers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.batches import Rolling, arrow_map, mixed, pieces, utf8
from tidegauge.llm.bwt import repeated
from tidegauge.session import stored

LEAST = 100
GRAM = 24
#: Bytes of different strings that one transform takes.
BLOCK = 1 << 18
#: Classes that a run is cut into, by the number of runs that share its minimiser.
CLASSES = ((1_000, 2), (30_000, 8))
_CHUNK = 1 << 20
#: Bytes of text after which equal rows are folded and sent off.
_FOLD = 8 << 20
_POSITION = np.uint64((1 << 21) - 1)
_RUNS = "key long, sh long, doc long, version long, at long"
_ORDER = ("key", "sh", "doc", "version", "at")


# A stretch of a document in 63 bits: 49 of the start, 7 of the length beyond `least`, 7 of
# the minimiser's place from the start. Ascending by start.
def _packed(start: np.ndarray, more: np.ndarray, place: np.ndarray | int = 0) -> np.ndarray:
    return start.astype(np.int64) << 14 | more.astype(np.int64) << 7 | place


def _unpacked(at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return at >> 14, at >> 7 & 127, at & 127


def _runs(data: np.ndarray, bounds: np.ndarray, least: int) -> tuple[np.ndarray, ...]:
    """Runs of neighbouring strings with one minimiser: its hash, a hash of the run's bytes, first start, strings less one, the minimiser's place."""
    if len(data) < least:
        return (np.zeros(0, np.uint64),) * 2 + (np.zeros(0, np.int64),) * 3
    rolling = Rolling(data)
    at = np.arange(len(data) - GRAM + 1)
    grams = rolling.of(at, at + GRAM)
    low = grams & ~_POSITION | at.astype(np.uint64)  # of equal hashes the leftmost is lowest
    width, span = least - GRAM + 1, 1
    while span * 2 <= width:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    if span < width:
        low = np.minimum(low[: len(low) - (width - span)], low[width - span :])
    starts = np.flatnonzero(np.repeat(bounds[1:], np.diff(bounds))[: len(low)] >= np.arange(len(low)) + least)
    chosen = (low[starts] & _POSITION).astype(np.int64)
    if not len(starts):
        return (np.zeros(0, np.uint64),) * 2 + (np.zeros(0, np.int64),) * 3
    edge = np.flatnonzero((chosen[1:] != chosen[:-1]) | (starts[1:] != starts[:-1] + 1)) + 1
    first, last = np.concatenate([[0], edge]), np.concatenate([edge, [len(starts)]]) - 1
    a, b, place = starts[first], starts[last], chosen[first]
    return grams[place], rolling.of(a, b + least), a, b - a, place - a


def _changes(*columns: np.ndarray) -> np.ndarray:
    """Whether a row differs from the one before."""
    new = np.ones(len(columns[0]), bool)
    new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return new


def _folded(key: np.ndarray, sh: np.ndarray, doc: np.ndarray, version: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows to keep: the first of each (key, sh). And rows that repeat one. Rows that are equal in all count once."""
    order = np.lexsort((at, version, doc, sh, key))
    key, sh, doc, version, at = (c[order] for c in (key, sh, doc, version, at))
    group = _changes(key, sh)
    return order[group], order[~group & _changes(doc, version, at)]


def _batch(columns: dict[str, np.ndarray | pa.Array]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns.values()], names=list(columns))


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about `_FOLD` bytes of text."""
    waiting: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        for part in pieces(batch, most=_FOLD):
            waiting.append(part)
            size += part.nbytes
            if size >= _FOLD:
                yield pa.concat_batches(waiting)
                waiting, size = [], 0
    if waiting:
        yield pa.concat_batches(waiting)


def _finding(least: int):
    """A task: runs of all texts, folded. A repeat has ~at; its key only spreads it."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _parts(batches):
            parts = []
            # Parts begin with a text, so a text is cut alike wherever it stands.
            for piece in pieces(batch, most=_CHUNK):
                data, bounds = utf8(piece.column("text"))
                doc, version = (piece.column(c).to_numpy() for c in ("doc", "version"))
                for low in range(0, max(len(data) - least + 1, 0), _CHUNK):
                    part = data[low : low + _CHUNK + least - 1]
                    key, sh, start, more, place = _runs(part, np.clip(bounds - low, 0, len(part)), least)
                    text = np.searchsorted(bounds, start + low, side="right") - 1
                    at = _packed(start + low - bounds[text], more, place)
                    parts.append((key.view(np.int64), sh.view(np.int64), doc[text], version[text], at))
            if not parts:
                continue
            key, sh, doc, version, at = (np.concatenate(x) for x in zip(*parts, strict=True))
            keep, again = _folded(key, sh, doc, version, at)
            yield _batch({"key": key[keep], "sh": sh[keep], "doc": doc[keep], "version": version[keep], "at": at[keep]})
            yield _batch({"key": _spread(doc[again], version[again]), "sh": sh[again], "doc": doc[again], "version": version[again], "at": ~at[again]})

    return task


def _spread(doc: np.ndarray, version: np.ndarray) -> np.ndarray:
    return mixed(doc.view(np.uint64) ^ mixed(version.view(np.uint64))).view(np.int64)


class _Groups:
    """Streams rows sorted by (key, sh, doc, version, at): tells repeats, and the first rows of keys with several different sh."""

    def __init__(self) -> None:
        self.pending: dict[str, np.ndarray] | None = None
        self.prior = False  # whether the pending row's key has had another row

    def take(self, rows: dict[str, np.ndarray], last: bool = False) -> tuple[dict[str, np.ndarray], dict[str, np.ndarray], np.ndarray]:
        """Repeats, rows of several to a key, and where a new key begins among the latter."""
        if self.pending is not None:
            rows = {c: np.concatenate([self.pending[c], x]) for c, x in rows.items()}
        if not len(rows["key"]):
            return rows, rows, np.zeros(0, bool)
        new = _changes(rows["key"], rows["sh"])
        again = ~new & _changes(*(rows[c] for c in ("doc", "version", "at")))
        repeats = {c: x[again] for c, x in rows.items()}
        rows = {c: x[new] for c, x in rows.items()}
        key = rows["key"]
        linked = np.concatenate([[self.prior], key[1:] == key[:-1]])
        several = linked | np.append(linked[1:], False)
        if last:
            self.pending, out = None, several
        else:
            # The last row waits, as the next batch may repeat it or add to its key.
            self.pending, self.prior = {c: x[-1:] for c, x in rows.items()}, bool(linked[-1])
            out = several.copy()
            out[-1] = False
        return repeats, {c: x[out] for c, x in rows.items()}, ~linked[out]


def _columns(batch: pa.RecordBatch, names: tuple[str, ...]) -> dict[str, np.ndarray]:
    return {c: batch.column(c).to_numpy(zero_copy_only=False) for c in names}


def _resolving():
    """A task over sorted runs: repeats (several false), and the first runs of minimisers that different runs share."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups = _Groups()

        def out(rows: dict[str, np.ndarray], several: bool) -> pa.RecordBatch:
            return _batch({"several": np.full(len(rows["at"]), several), **{c: rows[c] for c in ("key", "doc", "version", "at")}})

        for batch in batches:
            rows = _columns(batch, _ORDER)
            known = rows["at"] < 0
            yield out({c: ~x[known] if c == "at" else x[known] for c, x in rows.items()}, False)
            repeats, more, _ = groups.take({c: x[~known] for c, x in rows.items()})
            yield out(repeats, False)
            yield out(more, True)
        if groups.pending is not None:
            _, more, _ = groups.take({c: x[:0] for c, x in groups.pending.items()}, last=True)
            yield out(more, True)

    return task


def _cutting(least: int):
    """A task: runs with their bytes, cut into classes and dealt out by what the strings of a class share."""
    places = least - GRAM + 1

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _parts(batches):
            parts: list[tuple[np.ndarray, ...]] = []
            texts: list[bytes] = []
            for piece in pieces(batch):
                data, bounds = utf8(piece.column("text"))
                rolling = Rolling(data)
                runs = piece.column("runs")
                per_text = np.asarray(runs.value_lengths(), dtype=np.int64)
                fields = runs.flatten()
                key, at, classes = (fields.field(c).to_numpy() for c in ("key", "at", "classes"))
                text = np.repeat(np.arange(piece.num_rows), per_text)
                start, more, place = _unpacked(at)
                doc, version = (piece.column(c).to_numpy()[text] for c in ("doc", "version"))
                spot = bounds[text] + start + place  # of the minimiser
                for m in np.unique(classes).tolist():
                    width = -(-places // m)
                    for c in range(m):
                        low, high = c * width, min(c * width + width, places) - 1  # of the minimiser's place in a string
                        own_low, own_high = np.maximum(low, place - more), np.minimum(high, place)
                        some = np.flatnonzero((classes == m) & (own_low <= own_high))
                        a, b = spot[some] - own_high[some], spot[some] - own_low[some] + least
                        shared = rolling.of(spot[some] - low, spot[some] - high + least)
                        new = mixed(key[some].view(np.uint64) ^ mixed(shared + np.uint64(c)))
                        where = _packed(a - bounds[text[some]], b - a - least)
                        parts.append((new.view(np.int64), rolling.of(a, b).view(np.int64), doc[some], version[some], where))
                        texts += [data[x:y].tobytes() for x, y in zip(a.tolist(), b.tolist(), strict=True)]
            if not parts:
                continue
            key, sh, doc, version, at = (np.concatenate(x) for x in zip(*parts, strict=True))
            keep, again = _folded(key, sh, doc, version, at)
            kept = pa.array([texts[i] for i in keep.tolist()], pa.binary())
            yield _batch({"key": key[keep], "sh": sh[keep], "doc": doc[keep], "version": version[keep], "at": at[keep], "bytes": kept})
            none = pa.nulls(len(again), pa.binary())
            yield _batch({"key": _spread(doc[again], version[again]), "sh": sh[again], "doc": doc[again], "version": version[again], "at": ~at[again], "bytes": none})

    return task


def _expanding(least: int, block: int):
    """A task over sorted classes: the stretches that repeats cover, by transforms of blocks of whole groups."""

    def expanded(rows: list[dict[str, np.ndarray]]) -> pa.RecordBatch:
        doc, version, at = (np.concatenate([r[c] for r in rows]) for c in ("doc", "version", "at"))
        strings = [s for r in rows for s in r["bytes"]]
        rank = np.empty(len(strings), np.int64)
        rank[np.lexsort((at, version, doc))] = np.arange(len(strings))
        start, _, _ = _unpacked(at)
        owner, ats = [], []
        for i, offsets in enumerate(repeated(strings, rank, least)):
            if len(offsets):
                edge = np.flatnonzero(np.diff(offsets) != 1) + 1
                a, b = offsets[np.concatenate([[0], edge])], offsets[np.concatenate([edge, [len(offsets)]]) - 1]
                owner.append(np.full(len(a), i))
                ats.append(_packed(start[i] + a, b - a))
        empty = np.zeros(0, np.int64)
        of = np.concatenate([empty, *owner])
        return _batch({"doc": doc[of], "version": version[of], "at": np.concatenate([empty, *ats])})

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups, names, place = _Groups(), (*_ORDER, "bytes"), ("doc", "version", "at")
        waiting: list[dict[str, np.ndarray]] = []
        size = 0

        def add(rows: dict[str, np.ndarray], starts: np.ndarray) -> Iterator[pa.RecordBatch]:
            nonlocal size
            cuts = [0, *np.flatnonzero(starts).tolist(), len(starts)]
            lengths = np.cumsum([0, *(len(s) for s in rows["bytes"])])
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                if a < len(starts) and starts[a] and size >= block:
                    yield expanded(waiting)
                    waiting.clear()
                    size = 0
                if b > a:
                    waiting.append({c: rows[c][a:b] for c in (*place, "bytes")})
                    size += int(lengths[b] - lengths[a])

        for batch in batches:
            rows = _columns(batch, names)
            known = rows["at"] < 0
            yield _batch({c: ~rows[c][known] if c == "at" else rows[c][known] for c in place})
            repeats, more, starts = groups.take({c: x[~known] for c, x in rows.items()})
            yield _batch({c: repeats[c] for c in place})
            yield from add(more, starts)
        if groups.pending is not None:
            _, more, starts = groups.take({c: x[:0] for c, x in groups.pending.items()}, last=True)
            yield from add(more, starts)
        if waiting:
            yield expanded(waiting)

    return task


def _keeping(least: int):
    """A task: what is left of each text, and the spans that are cut out."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch):
                kept, removed, spans = [], [], []
                for text, cuts in zip(piece.column("text"), piece.column("cuts"), strict=True):
                    data = (text.as_py() or "").encode()
                    merged: list[list[int]] = []
                    if cuts.is_valid:
                        start, more, _ = _unpacked(np.sort(cuts.values.to_numpy()))
                        for a, b in zip(start.tolist(), (start + more + least).tolist(), strict=True):
                            if merged and a <= merged[-1][1]:
                                merged[-1][1] = max(merged[-1][1], b)
                            else:
                                merged.append([a, b])
                    edges = [0, *(x for span in merged for x in span), len(data)]
                    left = b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
                    kept.append(left)
                    removed.append(len(data) - len(left))
                    spans.append([{"start": a, "end": b} for a, b in merged])
                yield _batch(
                    {
                        "id": piece.column("id"),
                        "kept": pa.array(kept, pa.binary()),
                        "n_bytes": pa.array([len(k) + r for k, r in zip(kept, removed, strict=True)], pa.int64()),
                        "n_removed": pa.array(removed, pa.int64()),
                        "spans": pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                    }
                )

    return task


def remove_repeats(docs: DataFrame, least: int = LEAST, key: str = "doc_id", text: str = "text", block: int = BLOCK) -> DataFrame:
    """Per row: ``id``, ``kept`` (bytes), ``n_bytes``, ``n_removed`` and ``spans`` (start, end of what is cut out, in bytes)."""
    if not GRAM <= least <= GRAM + 104:
        raise ValueError(f"least must be from {GRAM} to {GRAM + 104}")
    # Rows without id come before those with the smallest one, and are told apart from them.
    version = F.xxhash64(F.coalesce(F.col(text), F.lit(""))).bitwiseAND(F.lit(2**63 - 1))
    version = F.when(F.col(key).isNull(), -1 - version).otherwise(version)
    number = F.coalesce(F.col(key).cast("long"), F.lit(-(2**63)))
    texts = docs.select(F.col(key).cast("long").alias("id"), number.alias("doc"), version.alias("version"), F.col(text).alias("text"))
    runs = arrow_map(texts.select("doc", "version", "text"), _finding(least), _RUNS)
    first = arrow_map(runs.repartition("key").sortWithinPartitions(*_ORDER), _resolving(), "several boolean, key long, doc long, version long, at long")
    first = stored(first, "runs")
    several = first.where("several").drop("several")
    crowds = several.groupBy("key").agg(F.count(F.lit(1)).alias("crowd")).where(F.col("crowd") > CLASSES[0][0])
    classes = F.when(F.coalesce("crowd", F.lit(0)) <= CLASSES[0][0], CLASSES[0][1]).when(F.col("crowd") <= CLASSES[1][0], CLASSES[1][1])
    # At most two neighbouring strings to a class: of them all, no more than the bytes on both sides allow.
    sized = several.join(crowds, "key", "left").withColumn("classes", classes.otherwise((least - GRAM + 2) // 2))
    wanted = sized.groupBy("doc", "version").agg(F.collect_list(F.struct("key", "at", "classes")).alias("runs"))
    unique = texts.select("doc", "version", "text").join(wanted, ["doc", "version"])
    cut = arrow_map(unique, _cutting(least), _RUNS + ", bytes binary")
    second = arrow_map(cut.repartition("key").sortWithinPartitions(*_ORDER), _expanding(least, block), "doc long, version long, at long")
    second = stored(second, "repeats")
    marks = first.where("not several").select("doc", "version", "at").union(second)
    cuts = marks.groupBy("doc", "version").agg(F.collect_list("at").alias("cuts"))
    schema = "id long, kept binary, n_bytes long, n_removed long, spans array<struct<start:long,end:long>>"
    return arrow_map(texts.join(cuts, ["doc", "version"], "left").select("id", "text", "cuts"), _keeping(least), schema)


def op8_interval_expansion(spark, sf_dir: str) -> DataFrame:
    left = remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return left.select(
        F.col("id").alias("doc_id"),
        "n_bytes",
        "n_removed",
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


OP8_SQL = r"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
p AS (SELECT doc_id, i, substr(h, 2 * i + 1, 200) AS s
      FROM (SELECT doc_id, h, unnest(range(0, greatest(length(h) // 2 - 99, 0))) AS i FROM d)),
f AS (SELECT doc_id, i, row_number() OVER (PARTITION BY s ORDER BY doc_id, i) AS k FROM p),
c AS (SELECT DISTINCT doc_id, unnest(range(i, i + 100)) AS b FROM f WHERE k > 1),
n AS (SELECT doc_id, count(*) AS n_removed, sum(CASE WHEN b = prev + 1 THEN 0 ELSE 1 END) AS n_spans
      FROM (SELECT doc_id, b, lag(b) OVER (PARTITION BY doc_id ORDER BY b) AS prev FROM c) GROUP BY doc_id),
a AS (SELECT doc_id, b, substr(h, 2 * b + 1, 2) AS x FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2)) AS b FROM d)),
k AS (SELECT a.doc_id, string_agg(x, '' ORDER BY a.b) AS h FROM a ANTI JOIN c ON a.doc_id = c.doc_id AND a.b = c.b GROUP BY a.doc_id)
SELECT d.doc_id, CAST(length(d.h) // 2 AS bigint) AS n_bytes, coalesce(n_removed, 0) AS n_removed,
       CAST(coalesce(n_spans, 0) AS bigint) AS n_spans, sha256(unhex(coalesce(k.h, ''))) AS kept_sha256
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN k USING (doc_id)
"""
