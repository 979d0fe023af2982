"""Item streams on Structured Streaming.

Sources: any streaming DataFrame of ``(pos, item)``; ``item_stream`` reads parquet files of a folder
as they arrive (``maxFilesPerTrigger`` sets the micro-batch size), ``line_stream`` reads text files
with one integer per line (items without positions), and ``positioned`` numbers such a stream.

State lives in Spark's state store or in the sink (partitioned, in the shared folder), never on the
driver:

* distinct items: ``dropDuplicates(['item'])`` in append mode -- each item is emitted once;
* histogram: ``groupBy('item').count()`` in update mode;
* reservoir: the slot rule of ``tessera.operators.frequency`` as a native aggregation per slot;
* sticky sampling: each micro-batch adds its counts and first accepted positions per (item, block of
  positions), partially aggregated; the merge goes by position, so batches may come in any order;
* batch sizes and stream length: a per-batch log written by ``foreachBatch``.

Sinks are folders of ``batch_id=<id>`` parts written with overwrite, so a replayed micro-batch
(at-least-once delivery) rewrites its own part and the result stays exact. The final table of an
update-mode stream is the latest row per key across parts; every ``COMPACT_EVERY`` parts are merged
into one, and only that and the parts after it are read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.hashing import uniform
from tessera.operators import frequency as FQ
from tessera.operators.frequency import TAG_RESERVOIR_ACCEPT, TAG_RESERVOIR_SLOT, FrequencyParams
from tessera.session import scratch_path
from tessera.sources.items import integer_column

COMPACT_EVERY = 16  # parts of an update-mode sink

EVENTS_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)


# ---- sources ---------------------------------------------------------------------------------


def item_stream(
    spark: SparkSession, folder: str, glob: str = "*.parquet", max_files_per_trigger: int | None = None
) -> DataFrame:
    """``(pos, item)`` from event parquet files arriving in ``folder``."""
    reader = spark.readStream.schema(EVENTS_SCHEMA).option("pathGlobFilter", glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    return reader.parquet(folder).select(F.col("event_id").alias("pos"), F.col("user_id").alias("item"))


def line_stream(spark: SparkSession, folder: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """``(item)`` from text files of one integer per line (a malformed line fails the query).

    A text stream carries no position, so it feeds the operators that need none (distinct items,
    histogram, batch sizes); ``positioned`` numbers it for the others.
    """
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    return reader.text(folder).select(integer_column(F.col("value")).alias("item"))


# ---- sinks -----------------------------------------------------------------------------------


class BatchLog:
    """A sink folder of per-micro-batch parts ``batch_id=<id>``."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType):
        self.spark = spark
        self.path = path
        self.schema = schema
        self.full = T.StructType([*schema.fields, T.StructField("batch_id", T.LongType())])

    def write(self, df: DataFrame, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(f"{self.path}/batch_id={int(batch_id)}")

    def _read(self, path: str) -> DataFrame | None:
        try:
            return self.spark.read.schema(self.full).parquet(path)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def read(self) -> DataFrame:
        found = self._read(self.path)
        return self.spark.createDataFrame([], self.full) if found is None else found

    def part(self, batch_id: int) -> DataFrame | None:
        """One batch's rows; None if it wrote none."""
        return self._read(f"{self.path}/batch_id={int(batch_id)}")


class LatestLog(BatchLog):
    """The sink of an update-mode stream: the last written row of every key is the result."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, keys: list[str]):
        super().__init__(spark, f"{path}/parts", schema)
        self.keys = keys
        self.merged = BatchLog(spark, f"{path}/merged", self.full_rows())

    def full_rows(self) -> T.StructType:
        return T.StructType([*self.schema.fields, T.StructField("as_of", T.LongType())])

    def write(self, df: DataFrame, batch_id: int) -> None:
        super().write(df, batch_id)
        if (int(batch_id) + 1) % COMPACT_EVERY == 0:
            # read from the merge before, which a replay of this batch finds again
            self.merged.write(self._rows(int(batch_id)), batch_id)

    def _rows(self, up_to: int | None = None) -> DataFrame:
        """The last row per key, with the batch that wrote it, of the batches up to one."""
        merged = self.merged.read()
        if up_to is not None:
            merged = merged.filter(F.col("batch_id") < up_to)
        base = merged.agg(F.max("batch_id")).first()[0]
        parts = self.read() if base is None else self.read().filter(F.col("batch_id") > base)
        if up_to is not None:
            parts = parts.filter(F.col("batch_id") <= up_to)
        rows = parts.withColumnRenamed("batch_id", "as_of")
        if base is not None:
            rows = rows.unionByName(merged.filter(F.col("batch_id") == base).drop("batch_id"))
        values = [c for c in self.schema.fieldNames() if c not in self.keys]
        last = rows.groupBy(*self.keys).agg(F.max_by(F.struct(*values, "as_of"), F.col("as_of")).alias("_v"))
        return last.select(*self.keys, *[F.col(f"_v.{c}").alias(c) for c in [*values, "as_of"]])

    def latest(self) -> DataFrame:
        return self._rows().drop("as_of")


def run_until_caught_up(
    stream: DataFrame,
    name: str,
    mode: str,
    on_batch: Callable[[DataFrame, int], None],
    checkpoint: str,
) -> None:
    """Run a ``foreachBatch`` query over everything available now, then stop."""
    query = (
        stream.writeStream.queryName(f"{name}_{checkpoint.rsplit('/', 1)[-1][:8]}")
        .outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(on_batch)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))


class StreamRun:
    """Scratch folders of one streaming run under the shared checkpoint folder."""

    def __init__(self, spark: SparkSession, name: str, base: str | None = None):
        self.spark = spark
        self.name = name
        self.base = base or scratch_path(spark, "streams", name)

    def checkpoint(self, part: str) -> str:
        return f"{self.base}/{part}/checkpoint"

    def sink(self, part: str) -> str:
        return f"{self.base}/{part}/sink"


# ---- operators -------------------------------------------------------------------------------


def _prefix(stream: DataFrame, params: FrequencyParams | int | None) -> DataFrame:
    """The first n items (n from the parameters, or given; none: all of them). A stream without
    positions has no first n items: number it with ``positioned`` first."""
    n = params.n if isinstance(params, FrequencyParams) else params
    if n is None:
        return stream
    if "pos" not in stream.columns:
        raise ValueError("the first n items need a stream with positions; see positioned()")
    return stream.filter(F.col("pos") < F.lit(int(n)))


BATCH_SCHEMA = T.StructType([T.StructField("n_rows", T.LongType())])
ITEM_SCHEMA = T.StructType([T.StructField("item", T.LongType())])
COUNT_SCHEMA = T.StructType([T.StructField("item", T.LongType()), T.StructField("n", T.LongType())])
SLOT_SCHEMA = T.StructType(
    [T.StructField("slot", T.LongType()), T.StructField("pos", T.LongType()), T.StructField("item", T.LongType())]
)


def batch_sizes(run: StreamRun, stream: DataFrame) -> DataFrame:
    """``(batch_id, n_rows)`` for the non-empty micro-batches."""
    log = BatchLog(run.spark, run.sink("sizes"), BATCH_SCHEMA)

    def on_batch(df: DataFrame, batch_id: int) -> None:
        n = df.count()
        if n > 0:
            log.write(run.spark.createDataFrame([(n,)], BATCH_SCHEMA), batch_id)

    run_until_caught_up(stream, "sizes", "append", on_batch, run.checkpoint("sizes"))
    return log.read().select("batch_id", "n_rows")


def distinct_items(run: StreamRun, stream: DataFrame, params: FrequencyParams | int | None = None) -> DataFrame:
    """``(item)``: insert-if-absent state via streaming dedup; each item is written once."""
    log = BatchLog(run.spark, run.sink("distinct"), ITEM_SCHEMA)
    dedup = _prefix(stream, params).select("item").dropDuplicates(["item"])
    run_until_caught_up(dedup, "distinct", "append", log.write, run.checkpoint("distinct"))
    return log.read().select("item")


def distinct_summary(run: StreamRun, stream: DataFrame, params: FrequencyParams | int | None = None) -> DataFrame:
    """``(n_items, n_distinct, largest_item)``: stream length, distinct items, largest item (>= 0),
    read from the streamed histogram state."""
    return histogram(run, stream, params).agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("n_items"),
        F.count(F.lit(1)).alias("n_distinct"),
        F.greatest(F.coalesce(F.max("item"), F.lit(0)), F.lit(0)).cast("bigint").alias("largest_item"),
    )


def histogram(
    run: StreamRun, stream: DataFrame, params: FrequencyParams | int | None = None, drive: Callable = run_until_caught_up
) -> DataFrame:
    """``(item, n)``: exact counts, a streaming aggregation in update mode. ``drive`` runs the query:
    until it has caught up, or as ``live.live_driver`` says; a later call goes on where it stopped."""
    log = LatestLog(run.spark, run.sink("histogram"), COUNT_SCHEMA, ["item"])
    counts = _prefix(stream, params).groupBy("item").agg(F.count(F.lit(1)).alias("n"))
    drive(counts, "histogram", "update", log.write, run.checkpoint("histogram"))
    return log.latest()


def reservoir(run: StreamRun, stream: DataFrame, params: FrequencyParams) -> DataFrame:
    """``(slot, pos, item)``: the reservoir as a native streaming aggregation per slot."""
    m = params.m
    pos = F.col("pos")
    u1 = uniform("pos", TAG_RESERVOIR_ACCEPT, params.seed)
    u2 = uniform("pos", TAG_RESERVOIR_SLOT, params.seed)
    accepted = _prefix(stream, params).filter((pos < F.lit(m)) | (u1 * pos.cast("double") <= F.lit(float(m))))
    slots = (
        accepted.select(
            F.when(pos < F.lit(m), pos).otherwise(F.floor(u2 * F.lit(float(m)))).cast("bigint").alias("slot"),
            "pos",
            "item",
        )
        .groupBy("slot")
        .agg(F.max("pos").alias("pos"), F.max_by("item", "pos").alias("item"))
    )
    log = LatestLog(run.spark, run.sink("reservoir"), SLOT_SCHEMA, ["slot"])
    run_until_caught_up(slots, "reservoir", "update", log.write, run.checkpoint("reservoir"))
    return log.latest()


BLOCK_SCHEMA = T.StructType([T.StructField(c, T.LongType()) for c in ("item", "b", "c", "p")])
PLACE_SCHEMA = T.StructType([T.StructField(c, T.LongType()) for c in ("item", "pos", "b")])


def sticky(run: StreamRun, stream: DataFrame, params: FrequencyParams) -> DataFrame:
    """``(item, n)``: sticky-sampling counts, whatever the order and the cut of the micro-batches.

    A micro-batch leaves its counts and first accepted positions per (item, block) and its rows'
    positions; the counts of an item are those of the blocks after its first accepted position, and
    single rows are only read in that position's block.
    """
    blocks = BatchLog(run.spark, run.sink("sticky_blocks"), BLOCK_SCHEMA)
    places = BatchLog(run.spark, run.sink("sticky_places"), PLACE_SCHEMA)

    def on_batch(df: DataFrame, batch_id: int) -> None:
        rows = FQ.sticky_rows(df, params)
        places.write(rows.select("item", "pos", "b"), batch_id)
        blocks.write(FQ.sticky_blocks(rows), batch_id)

    run_until_caught_up(_prefix(stream, params), "sticky", "append", on_batch, run.checkpoint("sticky"))
    return FQ.sticky_merge(blocks.read().select("item", "b", "c", "p"), places.read().select("item", "pos", "b"))


# ---- reports ---------------------------------------------------------------------------------


def frequent_items(run: StreamRun, stream: DataFrame, params: FrequencyParams) -> DataFrame:
    """``(item, n)``: the true frequent items of the stream, by item."""
    return FQ.frequent_of(histogram(run, stream, params), params).orderBy("item")


def reservoir_frequent_items(run: StreamRun, stream: DataFrame, params: FrequencyParams) -> DataFrame:
    """``(item, flag)``: the reservoir's distinct items, flagged against the true ones, by item."""
    true = FQ.frequent_of(histogram(run, stream, params), params)
    return FQ.flag_true(reservoir(run, stream, params).select("item").distinct(), true)


def sticky_frequent_items(run: StreamRun, stream: DataFrame, params: FrequencyParams) -> DataFrame:
    """``(item, flag)``: the items that sticky sampling reports, flagged, by item."""
    true = FQ.frequent_of(histogram(run, stream, params), params)
    return FQ.flag_true(FQ.sticky_estimates(sticky(run, stream, params), params), true)


def frequent_items_summary(run: StreamRun, stream: DataFrame, params: FrequencyParams) -> DataFrame:
    """``(method, n_held, n_estimated)``: the sizes of the three methods on the stream."""
    return FQ.method_sizes(
        histogram(run, stream, params), reservoir(run, stream, params), sticky(run, stream, params), params
    )


# ---- positions -------------------------------------------------------------------------------

ITEM_POS_SCHEMA = T.StructType([T.StructField("pos", T.LongType()), T.StructField("item", T.LongType())])


def positioned(run: StreamRun, stream: DataFrame) -> str:
    """Number a stream of ``(item)`` in arrival order, and return the folder of its numbered batches,
    parquet of ``(pos, item)``, for ``numbered_stream`` and batch reads.

    A row's position is the length of the stream before its micro-batch, plus the rows of the batch's
    earlier partitions, plus its place in its partition. A micro-batch is numbered once: a replay
    writes the same part again, from the length that the batch before it recorded.
    """
    raw = BatchLog(run.spark, run.sink("arrivals"), T.StructType([T.StructField("at", T.LongType()), T.StructField("item", T.LongType())]))
    out = BatchLog(run.spark, run.sink("numbered"), ITEM_POS_SCHEMA)
    lengths = BatchLog(run.spark, run.sink("lengths"), PROGRESS_SCHEMA)

    def on_batch(df: DataFrame, batch_id: int) -> None:
        before = _total_before(lengths, batch_id)
        # partition number in the high bits, place in the partition in the low 33
        raw.write(df.select(F.monotonically_increasing_id().alias("at"), "item"), batch_id)
        rows = raw.part(batch_id).withColumn("part", F.shiftright("at", 33))
        sizes = rows.groupBy("part").agg(F.count(F.lit(1)).alias("n"))  # a row per partition
        earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
        starts = sizes.withColumn("start", F.coalesce(F.sum("n").over(earlier), F.lit(0)) + before)
        place = F.col("start") + F.col("at").bitwiseAND((1 << 33) - 1)
        out.write(rows.join(starts, "part").select(place.cast("bigint").alias("pos"), "item"), batch_id)
        total = before + rows.count()
        lengths.write(run.spark.createDataFrame([(total,)], PROGRESS_SCHEMA), batch_id)

    run_until_caught_up(stream, "positions", "append", on_batch, run.checkpoint("positions"))
    return out.path


def numbered_stream(spark: SparkSession, folder: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """``(pos, item)`` from the folder that ``positioned`` returned."""
    reader = spark.readStream.schema(ITEM_POS_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    return reader.parquet(folder).select("pos", "item")


PROGRESS_SCHEMA = T.StructType([T.StructField("total", T.LongType())])


def _total_before(lengths: BatchLog, batch_id: int) -> int:
    """The stream's length before a batch, which the batch before it has recorded."""
    if int(batch_id) == 0:
        return 0
    found = lengths.part(int(batch_id) - 1)
    row = found.first() if found is not None else None
    if row is None:
        raise RuntimeError(f"no length recorded by micro-batch {int(batch_id) - 1} in {lengths.path}")
    return row.total


def prefix_whole_batches(run: StreamRun, stream: DataFrame, n: int) -> DataFrame:
    """``(pos, item)``: micro-batches taken while the length so far is below n; the batch that
    crosses n is taken whole (the reference's stopping rule).

    Each batch records the running length after it (``progress/batch_id=<id>``) and reads only the
    record of the batch before it, so a long stream costs O(1) per micro-batch; a replayed batch
    rewrites the same records.
    """
    progress = BatchLog(run.spark, run.sink("prefix_progress"), PROGRESS_SCHEMA)
    rows = BatchLog(run.spark, run.sink("prefix_rows"), ITEM_POS_SCHEMA)

    def on_batch(df: DataFrame, batch_id: int) -> None:
        total = _total_before(progress, batch_id)
        if total < n:
            size = df.count()
            if size:
                rows.write(df.select("pos", "item"), batch_id)
            total += size
        progress.write(run.spark.createDataFrame([(total,)], PROGRESS_SCHEMA), batch_id)

    run_until_caught_up(stream, "prefix", "append", on_batch, run.checkpoint("prefix"))
    return rows.read().select("pos", "item")
