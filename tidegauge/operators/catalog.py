"""Series catalogs, extraction ledger and request batches."""

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidegauge.operators.hot import with_positions
from tidegauge.schemas import BATCH_SIZE, DAILY_LIMIT, NOT_FOUND, SERIES_TYPES
from tidegauge.sources.runs import FANOUT, RunLog, Table

_VERSION = T.StructType(
    [
        T.StructField("series_id", T.StringType()),
        T.StructField("series_type", T.StringType()),
        T.StructField("document", T.StringType()),
        T.StructField("batch_id", T.LongType()),
    ]
)


def combine_catalogs(aggregation: DataFrame, commodity: DataFrame, industry: DataFrame) -> DataFrame:
    """One catalog with a type per series; an id keeps the first type that lists it.

    Only ids of an earlier catalog are left out of a later one. Copies inside
    one catalog stay.
    """
    first = aggregation.select("series_id", "series_name", F.lit("aggregated").alias("series_type"))
    second = commodity.select("series_id", "series_name", F.lit("commodity").alias("series_type"))
    third = industry.select("series_id", "series_name", F.lit("industry").alias("series_type"))
    seen_first = first.select("series_id").distinct()
    seen_second = seen_first.unionByName(second.select("series_id")).distinct()
    return (
        first.unionByName(second.join(seen_first, "series_id", "left_anti"))
        .unionByName(third.join(seen_second, "series_id", "left_anti"))
        .select("series_id", "series_name", "series_type")
    )


def duplicate_totals(*catalogs: DataFrame) -> DataFrame:
    """Rows, distinct rows and surplus rows of the catalogs taken together."""
    rows = catalogs[0].select("series_id", "series_name")
    for catalog in catalogs[1:]:
        rows = rows.unionByName(catalog.select("series_id", "series_name"))
    copies = rows.groupBy("series_id", "series_name").agg(F.count("*").alias("n"))
    totals = copies.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"), F.count("*").alias("unique_rows")
    )
    return totals.withColumn("duplicate_rows", F.col("total_rows") - F.col("unique_rows"))


def series_of_type(catalog: DataFrame, series_type: str | None = None, valid_only: bool = False) -> DataFrame:
    """The catalog's series of one type (all types if none is named)."""
    if series_type is not None:
        catalog = catalog.where(F.col("series_type") == series_type)
    return catalog.where("is_valid") if valid_only else catalog


def series_by_type(catalog: DataFrame) -> DataFrame:
    return catalog.groupBy("series_type").agg(F.count("*").alias("n_series"))


def apply_validation(catalog: DataFrame, results: DataFrame) -> DataFrame:
    """Add ``is_valid`` from (series_id, ok) results; a series without one is not valid."""
    ok = results.groupBy("series_id").agg(F.bool_or("ok").alias("_ok"))
    return catalog.join(ok, "series_id", "left").select(
        *catalog.columns, F.coalesce("_ok", F.lit(False)).alias("is_valid")
    )


def validity_by_type(validated: DataFrame) -> DataFrame:
    return (
        validated.groupBy("series_type")
        .agg(F.count_if("is_valid").alias("n_valid"), F.count("*").alias("n_total"))
        .withColumn("valid_pct", F.round(F.col("n_valid") / F.col("n_total") * 100, 1))
    )


def pending_series(catalog: DataFrame, ledger: DataFrame, retry_failed: bool = False) -> DataFrame:
    """Series not yet in the ledger; failed ones count as done unless retried."""
    done = ledger.where(F.col("status") == "success") if retry_failed else ledger
    return catalog.join(done.select("series_id").distinct(), "series_id", "left_anti").select(catalog.columns)


def missing_series(requested: DataFrame, received: DataFrame) -> DataFrame:
    """Ledger rows for the requested series that the answer lacks."""
    return requested.join(received.select("series_id").distinct(), "series_id", "left_anti").select(
        "series_id", F.lit("error").alias("status"), F.lit(NOT_FOUND).alias("error"), "series_type"
    )


def failed_request(requested: DataFrame, reason: str) -> DataFrame:
    """Ledger rows of a request that failed as a whole: quota used up, empty answer, an exception's message."""
    error = F.lit(reason).alias("error")
    return requested.select("series_id", F.lit("error").alias("status"), error, "series_type")


def ledger_of_answer(requested: DataFrame, received: DataFrame) -> DataFrame:
    """Ledger rows of an answered request: success where received, error elsewhere."""
    found = requested.join(received.select("series_id").distinct(), "series_id", "left_semi").select(
        "series_id", F.lit("success").alias("status"), F.lit(None).cast("string").alias("error"), "series_type"
    )
    return found.unionByName(missing_series(requested, received))


def request_batches(pending: DataFrame, size: int = BATCH_SIZE) -> DataFrame:
    """Number requests of at most ``size`` ids within each type, from 1.

    One row per type, batch and id; ``copies`` is how often the catalog lists
    the id within that batch.
    """
    placed = with_positions(pending.select("series_type", "series_id"), ["series_type"], "series_id")
    end = F.col("start") + F.col("copies") - 1
    spans = F.sequence(F.floor(F.col("start") / size), F.floor(end / size))
    slots = placed.withColumn("_batch", F.explode(spans))
    first = F.greatest(F.col("start"), F.col("_batch") * size)
    last = F.least(F.col("start") + F.col("copies"), (F.col("_batch") + 1) * size)
    return slots.select(
        "series_type", (F.col("_batch") + 1).alias("batch"), "series_id", (last - first).alias("copies")
    )


def request_lists(batches: DataFrame) -> DataFrame:
    """One row per request with its ids; a list never exceeds the batch size."""
    ids = F.flatten(F.collect_list(F.array_repeat("series_id", F.col("copies").cast("int"))))
    return batches.groupBy("series_type", "batch").agg(
        F.sum("copies").alias("n_series"), F.sort_array(ids).alias("series_ids")
    )


def remaining_requests(used: list[int], limit: int = DAILY_LIMIT) -> int:
    """Requests left today over all keys, given what each has used."""
    return sum(max(limit - n, 0) for n in used)


def batches_within_budget(
    batches: DataFrame, max_batches: int | None = None, remaining: int | None = None
) -> DataFrame:
    """Keep the batches that may run: a cap per type and what is left of the daily quota.

    Types run in their fixed order, so the quota goes to the first types first.
    """
    kept = batches if max_batches is None else batches.where(F.col("batch") <= max_batches)
    if remaining is None:
        return kept
    last = [
        F.coalesce(F.max(F.when(F.col("series_type") == name, F.col("batch"))), F.lit(0)) for name in SERIES_TYPES
    ]
    # Requests before the first type, before the second, and so on; in one row.
    before = F.array(*[sum(last[:i], F.lit(0)) for i in range(len(SERIES_TYPES) + 1)])
    turn = F.array_position(F.array(*map(F.lit, SERIES_TYPES)), F.col("series_type"))
    place = F.when(turn > 0, turn - 1).otherwise(len(SERIES_TYPES)).cast("int")
    earlier = F.get(kept.agg(before.alias("before")).scalar(), place)
    return kept.where(F.col("batch") + earlier <= remaining)


def upsert_consolidated(existing: DataFrame, new: DataFrame) -> DataFrame:
    """Existing documents updated by key; the new version of a series wins."""
    replaced = new.select("series_id").distinct()
    return new.unionByName(existing.join(replaced, "series_id", "left_anti").select(new.columns))


def _newest_version(versions: DataFrame) -> DataFrame:
    """Of each series the document of its last batch. Only ids and numbers are compared, documents move once."""
    last = versions.groupBy("series_id").agg(F.max("batch_id").alias("batch_id"))
    return versions.join(last, ["series_id", "batch_id"], "left_semi")


def document_log(spark: SparkSession, path: str, fanout: int = FANOUT) -> RunLog:
    """Documents by key, to be updated at the cost of what is new: an update writes its own documents only."""
    return RunLog(spark, path, {"documents": Table(_VERSION, _newest_version)}, fanout)


def upsert_documents(log: RunLog, new: DataFrame, batch_id: int) -> None:
    """Add new versions of documents (series_id, series_type, document), once; one of each series in a batch counts."""
    if log.holds(batch_id):
        return
    run = log.begin(batch_id)
    one = new.select("series_id", "series_type", "document").dropDuplicates(["series_id"])
    log.write(run, "documents", one.withColumn("batch_id", F.lit(batch_id).cast("long")))
    log.commit(run)
    log.compact()


def current_documents(log: RunLog) -> DataFrame:
    return _newest_version(log.read("documents")).drop("batch_id")


def status_by_type(ledger: DataFrame) -> DataFrame:
    return ledger.groupBy("series_type").agg(
        F.count_if(F.col("status") == "success").alias("n_success"),
        F.count_if(F.col("status") == "error").alias("n_error"),
        F.count("*").alias("n_total"),
    )
