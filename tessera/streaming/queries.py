"""Streaming twins of the item queries: the events table read as a file stream of several batches.

The events are written, by position, as ``SLICES`` slices of a few files each into the shared folder,
and read back a slice per micro-batch (``trigger(availableNow=True)``), so that state is carried
across batches. Each query starts its own job with a fresh checkpoint and sink, waits for it, and
returns the batch view of the sink. Results equal the batch queries in ``STREAM_ORACLE_KEYS``, or the
SQL in ``STREAM_SQL``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.plans.catalog import item_params, items, prefix_length
from tessera.session import scratch_path
from tessera.sources.tables import table
from tessera.streaming import items as S
from tessera.streaming import live as L

SLICES = 6


def slice_of(step: int, k: int):
    """Which events are in slice k: those of its range of event_id, beyond it in the outer slices."""
    at = F.col("event_id")
    after, before = at >= k * step, at < (k + 1) * step
    return (at.isNull() | before) if k == 0 else after if k == SLICES - 1 else after & before


def sliced_lines(spark: SparkSession, d: str) -> DataFrame:
    """``(item)``: the events' items as a stream of text lines, one integer each, in SLICES micro-batches."""
    events = table(spark, d, "events")
    n, files = events.count(), min(8, spark.sparkContext.defaultParallelism)
    step = max(1, -(-n // SLICES))
    folder = scratch_path(spark, "lines")
    for k in range(SLICES):
        lines = events.filter(slice_of(step, k) & F.col("user_id").isNotNull()).select(F.col("user_id").cast("string").alias("value"), "event_id")
        lines.repartition(files, F.pmod("event_id", F.lit(files))).select("value").write.mode("append").text(folder)
    return S.line_stream(spark, folder, max_files_per_trigger=files)


def sliced_events(spark: SparkSession, d: str) -> DataFrame:
    """``(pos, item)``: a stream of the events in SLICES micro-batches by position. The first and the
    last slice are open, and rows without an event_id are in the first: none is left out."""
    events = table(spark, d, "events")
    n, files = events.count(), min(8, spark.sparkContext.defaultParallelism)
    step = max(1, -(-n // SLICES))
    folder = scratch_path(spark, "events")
    for k in range(SLICES):  # one after the other: a file stream reads files in the order they were written
        part = events.filter(slice_of(step, k))
        part.repartition(files, F.pmod("event_id", F.lit(files))).sortWithinPartitions("event_id").write.mode("append").parquet(folder)
    # all files: a write leaves one for its first partition even if that has no rows
    per_slice = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(folder).count() // SLICES
    return S.item_stream(spark, folder, max_files_per_trigger=max(1, per_slice))


def q_stream_distinct_items(spark: SparkSession, d: str) -> DataFrame:
    return S.distinct_items(S.StreamRun(spark, "distinct"), sliced_events(spark, d))


def q_stream_distinct_summary(spark: SparkSession, d: str) -> DataFrame:
    return S.distinct_summary(S.StreamRun(spark, "summary"), sliced_events(spark, d))


def q_stream_item_histogram(spark: SparkSession, d: str) -> DataFrame:
    return S.histogram(S.StreamRun(spark, "histogram"), sliced_events(spark, d))


def q_stream_reservoir(spark: SparkSession, d: str) -> DataFrame:
    return S.reservoir(S.StreamRun(spark, "reservoir"), sliced_events(spark, d), item_params(spark, d))


def q_stream_sticky(spark: SparkSession, d: str) -> DataFrame:
    return S.sticky(S.StreamRun(spark, "sticky"), sliced_events(spark, d), item_params(spark, d))


def q_stream_frequent_items(spark: SparkSession, d: str) -> DataFrame:
    return S.frequent_items(S.StreamRun(spark, "frequent"), sliced_events(spark, d), item_params(spark, d))


def q_stream_reservoir_frequent_items(spark: SparkSession, d: str) -> DataFrame:
    return S.reservoir_frequent_items(S.StreamRun(spark, "reservoir-frequent"), sliced_events(spark, d), item_params(spark, d))


def q_stream_sticky_frequent_items(spark: SparkSession, d: str) -> DataFrame:
    return S.sticky_frequent_items(S.StreamRun(spark, "sticky-frequent"), sliced_events(spark, d), item_params(spark, d))


def q_stream_frequent_items_summary(spark: SparkSession, d: str) -> DataFrame:
    return S.frequent_items_summary(S.StreamRun(spark, "methods"), sliced_events(spark, d), item_params(spark, d))


def q_stream_prefix_batches(spark: SparkSession, d: str) -> DataFrame:
    """Micro-batches taken while the length so far is below 0.8 N; the crossing batch is taken whole."""
    return S.prefix_whole_batches(S.StreamRun(spark, "prefix"), sliced_events(spark, d), prefix_length(spark, d))


def q_stream_batch_sizes(spark: SparkSession, d: str) -> DataFrame:
    return L.observed_sizes(S.StreamRun(spark, "sizes"), sliced_events(spark, d))


def q_stream_sticky_keyed(spark: SparkSession, d: str) -> DataFrame:
    """Sticky counts from the state store, which holds tracked items only."""
    return L.sticky_keyed(S.StreamRun(spark, "sticky-keyed"), sliced_events(spark, d), item_params(spark, d))[0]


def q_stream_prefix_stopped(spark: SparkSession, d: str) -> DataFrame:
    """The stream ends itself once 0.4 N items have come; the crossing batch is taken whole."""
    return L.prefix_until(S.StreamRun(spark, "until"), sliced_events(spark, d), table(spark, d, "events").count() * 2 // 5)[0]


def q_stream_histogram_resumed(spark: SparkSession, d: str) -> DataFrame:
    """A live stream stopped after three batches, gone on with from its checkpoint by another run."""
    run, stream = S.StreamRun(spark, "resumed"), sliced_events(spark, d)
    S.histogram(run, stream, drive=L.live_driver(3))
    return S.histogram(run, stream)


def q_stream_distinct_chained(spark: SparkSession, d: str) -> DataFrame:
    return L.distinct_chained(S.StreamRun(spark, "chained"), sliced_events(spark, d))


def _against_exact(found: DataFrame, items: DataFrame) -> DataFrame:
    """``(n_sketches, n_distinct, within_error)``: the exact count, and whether the estimate is within
    three standard errors (and one) of it."""
    exact = items.filter("item is not null").agg(F.count_distinct("item").alias("n_distinct"), F.lit(0).alias("k"))
    near = F.abs(F.col("estimate") - F.col("n_distinct")) <= 1 + 3 * L.standard_error() * F.col("n_distinct")
    return L.sketch_summary(found).withColumn("k", F.lit(0)).join(exact, "k").select("n_sketches", "n_distinct", near.alias("within_error"))


def q_stream_distinct_sketch(spark: SparkSession, d: str) -> DataFrame:
    """A sketch per micro-batch, merged."""
    return _against_exact(L.sketches(S.StreamRun(spark, "sketches"), sliced_events(spark, d)), items(spark, d))


def q_distinct_items_sketch(spark: SparkSession, d: str) -> DataFrame:
    """A sketch per block of positions, merged."""
    own = items(spark, d)
    return _against_exact(L.block_sketches(own, max(1, own.count() // 16)), own)


def q_stream_numbered_items(spark: SparkSession, d: str) -> DataFrame:
    """A text stream of one integer per line, numbered as it arrives: what positions and items there are."""
    folder = S.positioned(S.StreamRun(spark, "numbered"), sliced_lines(spark, d))
    return spark.read.schema(S.ITEM_POS_SCHEMA).parquet(folder).agg(
        F.count(F.lit(1)).alias("n_items"), F.min("pos").alias("first_pos"), F.max("pos").alias("last_pos"),
        F.count_distinct("pos").alias("n_positions"), F.sum("item").cast("bigint").alias("item_sum"),
    )


STREAM_QUERIES = {
    "stream_distinct_items": q_stream_distinct_items,
    "stream_distinct_summary": q_stream_distinct_summary,
    "stream_item_histogram": q_stream_item_histogram,
    "stream_reservoir": q_stream_reservoir,
    "stream_sticky": q_stream_sticky,
    "stream_frequent_items": q_stream_frequent_items,
    "stream_reservoir_frequent_items": q_stream_reservoir_frequent_items,
    "stream_sticky_frequent_items": q_stream_sticky_frequent_items,
    "stream_frequent_items_summary": q_stream_frequent_items_summary,
    "stream_batch_sizes": q_stream_batch_sizes,
    "stream_prefix_batches": q_stream_prefix_batches,
    "stream_sticky_keyed": q_stream_sticky_keyed,
    "stream_prefix_stopped": q_stream_prefix_stopped,
    "stream_histogram_resumed": q_stream_histogram_resumed,
    "stream_distinct_chained": q_stream_distinct_chained,
    "stream_distinct_sketch": q_stream_distinct_sketch,
    "distinct_items_sketch": q_distinct_items_sketch,
    "stream_numbered_items": q_stream_numbered_items,
}

# streaming query -> batch query with the same result (and oracle SQL)
STREAM_ORACLE_KEYS = {
    "stream_distinct_items": "distinct_items",
    "stream_distinct_summary": "distinct_items_summary",
    "stream_item_histogram": "item_histogram",
    "stream_reservoir": "reservoir_sample",
    "stream_sticky": "sticky_counts",
    "stream_frequent_items": "frequent_items",
    "stream_reservoir_frequent_items": "reservoir_frequent_items",
    "stream_sticky_frequent_items": "sticky_frequent_items",
    "stream_frequent_items_summary": "frequent_items_summary",
    "stream_sticky_keyed": "sticky_counts",
    "stream_histogram_resumed": "item_histogram",
    "stream_distinct_chained": "distinct_items_summary",
}

_SLICED = (
    f"WITH e AS (SELECT *, least({SLICES - 1}, greatest(0, coalesce(event_id, 0) // greatest(1, ((SELECT count(*) FROM events) + {SLICES - 1}) // {SLICES}))) AS batch_id FROM events), "
    "b AS (SELECT batch_id, count(*) AS n_rows FROM e GROUP BY batch_id), "
    "r AS (SELECT *, sum(n_rows) OVER (ORDER BY batch_id) - n_rows AS before FROM b) "
)

STREAM_SQL = {
    "stream_batch_sizes": _SLICED + "SELECT CAST(batch_id AS BIGINT) AS batch_id, n_rows FROM b",
    "stream_prefix_batches": _SLICED + "SELECT event_id AS pos, user_id AS item FROM e JOIN r USING (batch_id) "
    "WHERE before < (SELECT count(*) FROM events) * 4 // 5",
    "stream_prefix_stopped": _SLICED + "SELECT event_id AS pos, user_id AS item FROM e JOIN r USING (batch_id) "
    "WHERE before < (SELECT count(*) FROM events) * 2 // 5",
    "stream_distinct_sketch": _SLICED + "SELECT (SELECT count(*) FROM b) AS n_sketches, count(DISTINCT user_id) AS n_distinct, true AS within_error FROM events",
    "distinct_items_sketch": "SELECT count(DISTINCT event_id // greatest(1, (SELECT count(*) FROM events) // 16)) AS n_sketches, "
    "count(DISTINCT user_id) AS n_distinct, true AS within_error FROM events",
    "stream_numbered_items": "SELECT count(*) AS n_items, 0::BIGINT AS first_pos, count(*) - 1 AS last_pos, count(*) AS n_positions, "
    "sum(user_id)::BIGINT AS item_sum FROM events WHERE user_id IS NOT NULL",
}
