"""Sampling over the piece lattice: lossless, reproducible, and with the right probabilities."""

from collections import Counter

import numpy as np
from llm_data import ODD, none, odd

from tidegauge.llm import piecewise
from tidegauge.llm.batches import mixed


def sampled(texts, seeds, vocabulary):
    raw = [t.encode() for t in texts]
    bounds = np.concatenate([[0], np.cumsum([len(r) for r in raw])])
    data = np.frombuffer(b"".join(raw), np.uint8)
    ids, first = piecewise.sample(data, bounds, np.asarray(seeds, np.uint64), vocabulary)
    back, ends = piecewise.restore(ids, first, vocabulary)
    assert back.tobytes() == data.tobytes() and ends.tolist() == bounds.tolist()
    return [tuple(ids[a:b].tolist()) for a, b in zip(first[:-1], first[1:], strict=True)]


def test_probabilities():
    """Against all segmentations of a word, enumerated."""
    v = piecewise.load()
    content = {bytes(v.content[a:b]): i for i, (a, b) in enumerate(zip(v.first[:-1], v.first[1:], strict=True)) if i not in set(v.byte_ids.tolist())}
    weight = dict(zip(v.ids.tolist(), v.weights.tolist(), strict=True))

    def ways(rest):
        if not rest:
            yield (), 0.0
        for k in range(1, len(rest) + 1):
            if rest[:k] in content and content[rest[:k]] in weight:
                i = content[rest[:k]]
                for more, w in ways(rest[k:]):
                    yield (i, *more), weight[i] + w

    every = dict(ways(b" thing"))
    total = sum(np.exp(w) for w in every.values())
    n = 20_000
    counts = Counter(sampled(["thing"] * n, mixed(np.arange(n, dtype=np.uint64)), v))
    assert set(counts) <= set(every)
    gap = sum(abs(counts[s] / n - np.exp(w) / total) for s, w in every.items()) / 2
    assert gap < 0.03


def test_a_text_draws_alike_in_any_batch():
    v = piecewise.load()
    texts = [t or "" for _, t in ODD]
    seeds = mixed(np.arange(len(texts), dtype=np.uint64))
    together = sampled(texts, seeds, v)
    assert together == [sampled([t], [s], v)[0] for t, s in zip(texts, seeds, strict=True)]
    assert together != sampled(texts, seeds + np.uint64(1), v)


def test_odd_rows(spark):
    df = odd(spark)
    coded = piecewise.decode(piecewise.encode(df))
    assert set(coded.columns) == {*df.columns, "decoded"}
    for r in coded.collect():
        assert r.decoded == r.text
        assert (r.ids is None) == (r.text is None)
    assert all(r.same for r in piecewise.encode(df, check="same").collect())
    again = piecewise.encode(df.repartition(7)).select("doc_id", "ids")
    assert sorted(map(str, again.collect())) == sorted(map(str, coded.select("doc_id", "ids").collect()))
    assert piecewise.decode(piecewise.encode(none(spark))).collect() == []


def test_foreign_ids_are_decoded(spark):
    v = piecewise.load()
    broken = [int(v.byte_ids[0xE2]), int(v.byte_ids[0x41]), 1, 2]
    rows = spark.createDataFrame([(broken,), ([],), (None,)], "ids array<int>")
    assert [r.decoded for r in piecewise.decode(rows).collect()] == ["�A", "", None]


def test_memory_follows_the_piece_not_the_batch():
    """A batch of a thousand texts of 1 kB is sampled in pieces, whose arcs stay far below the 100 MB of one 1 MB piece."""
    import tracemalloc

    import pyarrow as pa

    from tidegauge.llm.batches import pieces, utf8

    v = piecewise.load()
    words = ["tide", "gauge", "harbour", "level", "mean", "surge", "datum", "station"]
    texts = [" ".join(words[(i * 7 + k * 3) % len(words)] + str(k % 13) for k in range(150))[:1000] for i in range(1000)]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])
    whole = sampled(texts[:50], range(50), v)
    tracemalloc.start()
    try:
        out = []
        for piece in pieces(batch, "text", piecewise._PIECE_BYTES):
            data, bounds = utf8(piece.column("text"))
            ids, first = piecewise.sample(data, bounds, np.arange(piece.num_rows, dtype=np.uint64), v)
            out += [tuple(ids[a:b].tolist()) for a, b in zip(first[:-1], first[1:], strict=True)]
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 40e6
    assert out[:50] == whole  # the same pieces, whatever else the piece holds
