"""Windows over keys that may hold any share of the rows.

A window hands each key to one task. That is right for ordinary series and
wrong for a key with a third of all rows, so the two helpers here split such
keys into buckets that respect the order and carry only small summaries (counts,
the last few values) from bucket to bucket.
"""

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tidegauge.session import stored

HOT_ROWS = 1_000_000
SLOT_ROWS = 100_000  # rows of one order value that stay in one bucket, about
EXPAND = 10_000  # copies of one row that a task writes out at a time


def key_sizes(df: DataFrame, key: str, order: str) -> DataFrame:
    """(key, order, n): rows of each order value of each key. Sums of several such tables are that of their rows."""
    return df.groupBy(key, order).agg(F.count("*").alias("n"))


def with_lags(
    df: DataFrame,
    key: str,
    order: str,
    value: str,
    offsets: dict[str, int],
    hot_rows: int | None = HOT_ROWS,
    slot_rows: int = SLOT_ROWS,
    sizes: DataFrame | None = None,
) -> DataFrame:
    """Add, per offset, the value that many rows earlier within the key.

    ``df`` has the columns key, order and value and no others. Rows of one key
    that tie on ``order`` are taken in the order of their value's hash, which
    makes the result repeatable and lets a tie of any size be cut into slots.

    Which keys are hot and how finely their order values are cut is a part of the plan, no
    job runs before it: ``sizes`` (see `key_sizes`) tells, kept with the table or made from
    ``df``. Keys that it lacks count as usual ones. With None for ``hot_rows`` all are usual.
    """
    if hot_rows is None:
        return _window_lags(df, key, order, value, offsets)
    usual, crowded = _parted(df, key, order, hot_rows, slot_rows, sizes)
    split = _bucket_lags(crowded, key, order, value, offsets)
    return _window_lags(usual, key, order, value, offsets).unionByName(split)


def _parted(df, key, order, hot_rows, slot_rows, sizes) -> tuple[DataFrame, DataFrame]:
    """Rows of usual keys, and those of hot ones with the bits (``_bits``) that their order value is cut by."""
    sizes = key_sizes(df, key, order) if sizes is None else sizes
    bits = F.greatest(F.lit(0), F.ceil(F.log2(F.col("n") / slot_rows)).cast("int"))
    cut = F.collect_list(F.when(bits > 0, F.struct(order, bits.alias("bits"))))
    totals = sizes.groupBy(key).agg(F.sum("n").alias("n"), cut.alias("_cuts"))
    # At most one key for every ``hot_rows`` rows, with at most one entry for every ``slot_rows``.
    hot = F.broadcast(totals.where(F.col("n") > hot_rows).select(key, "_cuts"))
    own = F.filter("_cuts", lambda cut: cut[order].eqNullSafe(F.col(order)))
    crowded = df.join(hot, key).withColumn("_bits", F.coalesce(F.get(own, F.lit(0))["bits"], F.lit(0))).drop("_cuts")
    return df.join(hot.select(key), key, "left_anti"), crowded


def _tie(value: str) -> Column:
    return F.xxhash64(value)


def _window_lags(df, key, order, value, offsets) -> DataFrame:
    w = W.partitionBy(key).orderBy(order, _tie(value), value)
    return df.withColumns({name: F.lag(value, k).over(w) for name, k in offsets.items()})


def _last(values: Column, k: int) -> Column:
    """The last ``k`` elements, or all where there are fewer."""
    return F.when(F.size(values) > k, F.slice(values, -k, k)).otherwise(values)


def _bucket_lags(df, key, order, value, offsets) -> DataFrame:
    whole = _with_lead_ins(df, key, order, value, max(offsets.values()))
    w = W.partitionBy(key, order, "_slot").orderBy(F.asc_nulls_last("_place"), "_tie", value, "_copy")
    lagged = whole.withColumns({name: F.lag(value, k).over(w) for name, k in offsets.items()})
    kept = lagged.where("_place IS NULL").select(key, order, value, "_tie", "_alike", *offsets)
    return _write_out(kept, [key, order, "_tie"]).drop("_tie", "_alike")


def _with_lead_ins(df, key, order, value, deepest) -> DataFrame:
    """Runs of equal rows by buckets (key, order, ``_slot``), each bucket with the ``deepest`` values before it.

    Lent values have a ``_place`` and only serve the rows behind them.
    """
    bucket = [key, order, "_slot"]

    # Copies of a row become one run with a count, already on the map side. Past
    # ``deepest`` copies a run looks back into itself and all its copies are
    # alike, so that one row with a count stands for them.
    runs = (
        df.groupBy(key, order, "_bits", value)
        .agg(F.count("*").alias("_n"))
        .withColumn("_tie", _tie(value))
        .withColumn("_slot", F.expr("CASE WHEN _bits > 0 THEN shiftright(_tie, 64 - _bits) ELSE 0 END"))
        .drop("_bits")
    )
    copy = F.explode(F.sequence(F.lit(0), F.least("_n", F.lit(deepest + 1)).cast("int") - 1))
    alike = F.when(F.col("_copy") == deepest, F.col("_n") - deepest).otherwise(F.lit(1))
    rows = runs.withColumn("_copy", copy).withColumn("_alike", alike).drop("_n")

    # The last values of each bucket, then of all buckets before it. Only these meet by
    # key: a few values for every ``slot_rows`` rows.
    backwards = W.partitionBy(*bucket).orderBy(F.desc("_tie"), F.desc(value), F.desc("_copy"))
    ends = (
        rows.withColumn("_back", F.row_number().over(backwards))
        .where(F.col("_back") <= deepest)
        .groupBy(*bucket)
        .agg(F.sort_array(F.collect_list(F.struct("_back", value)), asc=False)[value].alias("_end"))
    )
    earlier = W.partitionBy(key).orderBy(order, "_slot").rowsBetween(-deepest, -1)
    before = ends.select(*bucket, F.flatten(F.collect_list("_end").over(earlier)).alias("_before"))
    halo = before.select(*bucket, F.posexplode(_last(F.col("_before"), deepest)).alias("_place", value))

    return rows.withColumn("_place", F.lit(None).cast("int")).unionByName(halo, allowMissingColumns=True)


def laid_out(
    df: DataFrame,
    key: str,
    order: str,
    value: str,
    deepest: int,
    hot_rows: int = HOT_ROWS,
    slot_rows: int = SLOT_ROWS,
    sizes: DataFrame | None = None,
) -> DataFrame:
    """Rows in parts that can be windowed by themselves, to be stored by key and ``part``.

    A usual key is one part. A hot key has many, each with the values before it that its
    rows look back at. `lags_of_parts` needs no other rows than a part's.
    """
    usual, crowded = _parted(df, key, order, hot_rows, slot_rows, sizes)
    columns = [key, "part", order, value, "_tie", "_copy", "_alike", "_place"]
    nothing = F.lit(None).cast("int")
    plain = usual.withColumns(
        {"part": F.lit(0).cast("long"), "_tie": _tie(value), "_copy": F.lit(0), "_alike": F.lit(1).cast("long"), "_place": nothing}
    )
    whole = _with_lead_ins(crowded, key, order, value, deepest)
    parts = whole.withColumn("part", F.xxhash64(order, "_slot")).withColumn("_alike", F.col("_alike").cast("long"))
    return plain.select(*columns).unionByName(parts.select(*columns))


def lags_of_parts(parts: DataFrame, key: str, order: str, value: str, offsets: dict[str, int]) -> DataFrame:
    """Per row of `laid_out` rows, with its ``part``, the values ``offsets`` rows earlier within the key."""
    w = W.partitionBy(key, "part").orderBy(F.asc_nulls_last("_place"), order, "_tie", value, "_copy")
    lagged = parts.withColumns({name: F.lag(value, k).over(w) for name, k in offsets.items()})
    kept = lagged.where("_place IS NULL").select(key, "part", order, value, "_alike", *offsets)
    return kept.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), "_alike"))).drop("_copy", "_alike")


def _write_out(df: DataFrame, keys: list[str]) -> DataFrame:
    """Turn each row back into its ``_alike`` copies, in pieces spread over tasks."""
    pieces = F.explode(F.sequence(F.lit(0), F.floor((F.col("_alike") - 1) / EXPAND)))
    left = F.least(F.lit(EXPAND), F.col("_alike") - F.col("_piece") * EXPAND).cast("int")
    return (
        df.withColumn("_piece", pieces)
        .repartition(*keys, "_piece")
        .withColumn("_copy", F.explode(F.sequence(F.lit(1), left)))
        .drop("_piece", "_copy")
    )


def with_positions(df: DataFrame, groups: list[str], key: str) -> DataFrame:
    """Number the rows of each group in the order of the key, copies of a key counted but kept together.

    The keys are laid out in ranges of about equal numbers, by splitters from a sample. A
    range is numbered by itself; only the totals of ranges meet by group. Returns the
    groups, the key, its ``copies`` and the position ``start`` of its first copy, from 0.
    """
    runs = df.groupBy(*groups, key).agg(F.count("*").alias("copies"))
    ranges = runs.repartitionByRange(*groups, key).withColumn("_range", F.spark_partition_id())
    ranges = stored(ranges, "ranges")  # both uses below must see the same splitters
    sums = ranges.groupBy(*groups, "_range").agg(F.sum("copies").alias("_total"))
    lower = W.partitionBy(*groups).orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    offsets = sums.withColumn("_offset", F.coalesce(F.sum("_total").over(lower), F.lit(0)))
    named = offsets.select(*[F.col(g).alias(f"_of_{g}") for g in groups], F.col("_range").alias("_of_range"), "_offset")
    within = W.partitionBy(*groups, "_range").orderBy(key).rowsBetween(W.unboundedPreceding, -1)
    placed = ranges.withColumn("_inner", F.coalesce(F.sum("copies").over(within), F.lit(0)))
    same = F.col("_range") == F.col("_of_range")
    for g in groups:
        same &= F.col(g).eqNullSafe(F.col(f"_of_{g}"))
    return placed.join(named, same).select(*groups, key, "copies", (F.col("_offset") + F.col("_inner")).alias("start"))
