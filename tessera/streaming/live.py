"""Streams that live across batches: processing-time triggers, queries ended from their own progress, restart
from a checkpoint, keyed sticky state, chained stateful operators, observed metrics and mergeable sketches.

* ``run_live`` drives a query with a processing-time trigger until a condition on its progress holds (or
  nothing arrives for a while), then stops it; what it committed is where the next run on the same
  checkpoint goes on.
* ``prefix_until`` takes micro-batches until n items have come and ends the stream itself; batches
  after the crossing one aren't read.
* ``sticky_keyed`` keeps one count per *tracked* item in the state store. It needs positions that grow
  from batch to batch and refuses others; ``items.sticky`` takes batches in any order instead, from a
  table of all rows.
* ``observed_sizes`` and ``distinct_chained`` take counts of the rows that pass, by ``observe`` and a
  listener: no second read of a batch and no job beside the stream's own.
* ``sketches`` leaves a HyperLogLog sketch per micro-batch; ``sketch_summary`` merges them.
"""

from __future__ import annotations

import sys
import threading
import time
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQueryListener

from tessera.functions.hashing import uniform
from tessera.operators.frequency import TAG_STICKY_ACCEPT, FrequencyParams
from tessera.streaming.items import COUNT_SCHEMA, ITEM_POS_SCHEMA, PROGRESS_SCHEMA, BatchLog, LatestLog, StreamRun, _prefix, _total_before

# workers need no installed package: what goes to them goes by value
cloudpickle.register_pickle_by_value(sys.modules[__name__])

POLL_S = 0.05
IDLE_S = 20.0  # a live stream without a new batch for so long is ended, unless told otherwise
LG_K = 12  # a sketch has 2^12 registers


class PositionsOutOfOrder(ValueError):
    """A micro-batch holds positions that aren't behind those of the batches before it."""


class Halted(Exception):
    """Raised in place of a batch that a stopped run has no more use for; it stays uncommitted."""


class Progress(StreamingQueryListener):
    """The progress of one run of a query: by batch, its input rows and observed metrics."""

    def __init__(self):
        self.run_id = None
        self.batches: dict[int, dict] = {}
        self.state_rows: dict[int, int] = {}
        self.ended, self.halted = threading.Event(), False

    def _own(self, run_id) -> bool:
        return self.run_id is None or str(run_id) == self.run_id

    def onQueryStarted(self, event) -> None:  # noqa: N802
        pass

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        p = event.progress
        if self._own(p.runId):
            told = {k: r.asDict() for k, r in p.observedMetrics.items()}
            # a trigger without data repeats the number of the batch to come
            if p.numInputRows or told or p.batchId not in self.batches:
                self.batches[p.batchId] = {"rows": p.numInputRows, **told}
            if p.stateOperators:
                self.state_rows[p.batchId] = p.stateOperators[0].numRowsTotal

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        if self._own(event.runId):
            self.ended.set()

    def observed(self, name: str, field: str) -> dict[int, int]:
        """A metric by batch; batches without rows are left out."""
        return {b: m[name][field] for b, m in self.batches.items() if m.get(name) and m[name][field]}


def _listened(spark, start: Callable, wait: Callable) -> Progress:
    """Start a query, wait as told, and return its whole progress."""
    listener = Progress()
    spark.streams.addListener(listener)
    try:
        query = start()
        listener.run_id = str(query.runId)
        try:
            wait(query, listener)
        except StreamingQueryException:
            if not listener.halted:
                raise
        finally:
            query.stop()
        listener.ended.wait(30)  # events come in order: all progress has been told by then
        if query.exception() is not None and not listener.halted:
            raise RuntimeError(str(query.exception()))
    finally:
        spark.streams.removeListener(listener)
    return listener


def _caught_up(query, listener: Progress) -> None:
    query.awaitTermination()


def run_live(
    stream: DataFrame, name: str, mode: str, on_batch: Callable[[DataFrame, int], None], checkpoint: str,
    interval: str = "200 milliseconds", until: Callable[[int], bool] = lambda batch: False, idle: float | None = IDLE_S,
) -> Progress:
    """Run a ``foreachBatch`` query with a processing-time trigger until ``until`` holds of a finished
    batch's number, or ``idle`` seconds pass without one (None: never). A batch that starts after that is
    neither read nor committed. A run on a checkpoint that has batches goes on behind the last one
    committed, and repeats one that was begun but not committed."""
    finished: list[int] = []
    listeners: list[Progress] = []

    def gated(df: DataFrame, batch_id: int) -> None:
        if finished and until(finished[-1]):
            listeners[0].halted = True
            raise Halted(f"stopped before micro-batch {int(batch_id)}")
        on_batch(df, batch_id)
        finished.append(int(batch_id))

    def start():
        return (
            stream.writeStream.queryName(f"{name}_{checkpoint.rsplit('/', 1)[-1][:8]}_{time.monotonic_ns()}").outputMode(mode)
            .option("checkpointLocation", checkpoint).foreachBatch(gated).trigger(processingTime=interval).start()
        )

    def wait(query, listener: Progress) -> None:
        listeners.append(listener)
        n, since = 0, time.monotonic()
        while not listener.halted and query.isActive and not query.awaitTermination(POLL_S):
            active = query.status["isTriggerActive"]
            if active or len(finished) > n:
                n, since = len(finished), time.monotonic()
            elif n and until(finished[-1]) and finished[-1] in listener.batches:
                return  # committed, and no other batch under way
            elif idle is not None and time.monotonic() - since > idle:
                return
        if listener.halted:
            query.awaitTermination(30)

    return _listened(stream.sparkSession, start, wait)


def live_driver(batches: int, interval: str = "200 milliseconds") -> Callable:
    """A driver for the operators of ``items``: a live run that is stopped after so many batches."""

    def drive(stream: DataFrame, name: str, mode: str, on_batch: Callable, checkpoint: str) -> Progress:
        return run_live(stream, name, mode, on_batch, checkpoint, interval, until=lambda batch: batch + 1 >= batches)

    return drive


# ---- a stream that ends itself -------------------------------------------------------------------


def prefix_until(run: StreamRun, stream: DataFrame, n: int, interval: str = "200 milliseconds", idle: float | None = IDLE_S) -> tuple[DataFrame, Progress]:
    """``(pos, item)`` of the micro-batches up to the one that brings the length to n, taken whole, and
    the run's progress. The query stops itself after that batch while the source may go on; no later
    batch is read."""
    lengths = BatchLog(run.spark, run.sink("until_lengths"), PROGRESS_SCHEMA)
    rows = BatchLog(run.spark, run.sink("until_rows"), ITEM_POS_SCHEMA)
    crossed: list[int] = []

    def on_batch(df: DataFrame, batch_id: int) -> None:
        total = _total_before(lengths, batch_id)
        if total < n:
            rows.write(df.select("pos", "item"), batch_id)
            part = rows.part(batch_id)
            total += part.count() if part is not None else 0  # a count of what was written, from the files' footers
        lengths.write(run.spark.createDataFrame([(total,)], PROGRESS_SCHEMA), batch_id)
        if total >= n:
            crossed.append(int(batch_id))

    progress = run_live(stream, "until", "append", on_batch, run.checkpoint("until"), interval, until=lambda batch: bool(crossed) and batch >= crossed[0], idle=idle)
    return rows.read().select("pos", "item"), progress


# ---- sticky sampling in the state store ----------------------------------------------------------

TRACKED_SCHEMA = "item bigint, n bigint, lo bigint, hi bigint"
LAST_SCHEMA = T.StructType([T.StructField("total", T.LongType())])
GROUPS = 1024  # groups of items that the state store deals out; a checkpoint goes on with the number it began with
NO_ITEM = -1  # the group of rows without an item
STATE_STORE = {  # map state is kept by this store only
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


@contextmanager
def _set(spark, conf: dict[str, str]) -> Iterator[None]:
    """Session settings for the queries started inside: a query keeps those it started with."""
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


class _Track(StatefulProcessor):
    """Count the rows of tracked items; start an untracked one at its first accepted position. Only an
    item with a count gets an entry in its group's map, and only entries of items that come are read. What
    is held is a micro-batch's positions before the first accepted one so far, of items not tracked before."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.tracked = handle.getMapState("tracked", "item bigint", "n bigint")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        least, most = np.iinfo(np.int64).min, np.iinfo(np.int64).max
        lo, hi, held, known = most, least, [], self.tracked.exists()
        n: dict[int, int] = {}
        first: dict[int, int] = {}  # counted from this position on
        for pdf in rows:
            if not len(pdf):
                continue
            pos, acc = pdf["pos"].to_numpy(np.int64), pdf["acc"].to_numpy(bool)
            lo, hi = min(lo, int(pos.min())), max(hi, int(pos.max()))
            items, at = np.unique(pdf["item"].to_numpy(np.int64), return_inverse=True)
            own = items.tolist()
            for i in own:
                if i not in n:
                    was = self.tracked.getValue((i,)) if known else None
                    n[i], first[i] = (was[0], least) if was is not None else (0, most)
            start = np.array([first[i] for i in own], np.int64)
            np.minimum.at(start, at[acc], pos[acc])
            late = (pos >= start[at]) & (start < most)[at]
            for i, s, c in zip(own, start.tolist(), np.bincount(at[late], minlength=len(own)).tolist(), strict=True):
                first[i], n[i] = s, n[i] + c
            if not late.all():
                held.append((items[at[~late]], pos[~late]))
        # a later chunk may have brought an earlier accepted position
        for item, pos in held:
            items, at = np.unique(item, return_inverse=True)
            late = pos >= np.array([first[i] for i in items.tolist()], np.int64)[at]
            for i, c in zip(items.tolist(), np.bincount(at[late], minlength=len(items)).tolist(), strict=True):
                n[i] += c
        found = [i for i in n if n[i]]
        for i in found:
            self.tracked.updateValue((i,), (n[i],))
        item = [None] * len(found) if key[0] == NO_ITEM else found
        out = {"item": item or [None], "n": [n[i] for i in found] or [None]}
        yield pd.DataFrame({c: pd.array(v, "Int64") for c, v in out.items()}).assign(lo=lo, hi=hi)


def sticky_keyed(run: StreamRun, stream: DataFrame, params: FrequencyParams) -> tuple[DataFrame, Progress]:
    """``(item, n)``: sticky-sampling counts from keyed state, and the run's progress.

    The state store holds a count per tracked item, about r of them for each factor by which the stream
    grows, and nothing of the others; items are dealt out in ``GROUPS`` groups, each a map of its tracked
    items, so that Python is called once per group and micro-batch and not once per item. Rows may come in
    any order within a micro-batch; a batch with a position at or before one of an earlier batch fails the
    query with ``PositionsOutOfOrder`` before any of it reaches the sink. A replayed batch starts from the
    state before it and rewrites its part.
    """
    log = LatestLog(run.spark, run.sink("sticky_keyed"), COUNT_SCHEMA, ["item"])
    last = BatchLog(run.spark, run.sink("sticky_keyed_last"), LAST_SCHEMA)
    accept = uniform("pos", TAG_STICKY_ACCEPT, params.seed) <= F.lit(params.sticky_p)
    item = F.col("item").cast("bigint")
    group = F.when(item.isNull(), F.lit(NO_ITEM)).otherwise(F.pmod(F.hash(item), F.lit(GROUPS)))
    rows = _prefix(stream, params).select(group.alias("g"), F.coalesce(item, F.lit(0)).alias("item"), "pos", accept.alias("acc"))
    counts = rows.groupBy("g").transformWithStateInPandas(_Track(), TRACKED_SCHEMA, "update", "None")

    def on_batch(df: DataFrame, batch_id: int) -> None:
        told = df.persist()
        try:
            lo, hi = told.agg(F.min("lo"), F.max("hi")).first()
            before = -1 if int(batch_id) == 0 else _total_before(last, batch_id)
            if lo is not None and lo <= before:
                raise PositionsOutOfOrder(f"micro-batch {int(batch_id)} has position {lo}, an earlier one had {before}; use items.sticky")
            log.write(told.filter("n is not null").select("item", "n"), batch_id)
            last.write(run.spark.createDataFrame([(max(before, hi if hi is not None else before),)], LAST_SCHEMA), batch_id)
        finally:
            told.unpersist()

    checkpoint = run.checkpoint("sticky_keyed")

    def start():
        with _set(run.spark, STATE_STORE):
            return counts.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(on_batch).trigger(availableNow=True).start()

    progress = _listened(run.spark, start, _caught_up)
    return log.latest(), progress


# ---- observed metrics ----------------------------------------------------------------------------

OBSERVED_SCHEMA = T.StructType([T.StructField("batch", T.LongType()), T.StructField("n_rows", T.LongType())])


def _noted(log: BatchLog, found: dict[int, int]) -> None:
    """Keep a run's observed counts: one part per run, named by its last batch."""
    if found:
        log.write(log.spark.createDataFrame(sorted(found.items()), OBSERVED_SCHEMA).coalesce(1), max(found))


def observed_sizes(run: StreamRun, stream: DataFrame) -> DataFrame:
    """``(batch_id, n_rows)`` for the non-empty micro-batches, from a metric observed while each batch
    passes to a sink that keeps nothing: one job a batch."""
    log = BatchLog(run.spark, run.sink("observed_sizes"), OBSERVED_SCHEMA)
    watched = stream.observe("batch", F.count(F.lit(1)).alias("n_rows"))
    checkpoint = run.checkpoint("observed_sizes")

    def start():
        return watched.writeStream.format("noop").outputMode("append").option("checkpointLocation", checkpoint).trigger(availableNow=True).start()

    _noted(log, _listened(run.spark, start, _caught_up).observed("batch", "n_rows"))
    return log.read().groupBy(F.col("batch").alias("batch_id")).agg(F.max("n_rows").alias("n_rows"))


SUMMARY_SCHEMA = T.StructType([T.StructField("n_distinct", T.LongType()), T.StructField("largest", T.LongType())])


def distinct_chained(run: StreamRun, stream: DataFrame, params: FrequencyParams | int | None = None) -> DataFrame:
    """``(n_items, n_distinct, largest_item)`` by one streaming query of two chained stateful operators:
    ``dropDuplicates`` lets each item pass once, a global aggregate counts them and keeps the largest.
    The length is a metric observed before the first of them."""
    log = BatchLog(run.spark, run.sink("chained"), SUMMARY_SCHEMA)
    lengths = BatchLog(run.spark, run.sink("chained_lengths"), OBSERVED_SCHEMA)
    watched = _prefix(stream, params).observe("length", F.count(F.lit(1)).alias("n"))
    summary = watched.select("item").dropDuplicates(["item"]).agg(
        F.count(F.lit(1)).alias("n_distinct"), F.max("item").cast("bigint").alias("largest")
    )
    checkpoint = run.checkpoint("chained")

    def start():
        return summary.writeStream.outputMode("complete").option("checkpointLocation", checkpoint).foreachBatch(log.write).trigger(availableNow=True).start()

    _noted(lengths, _listened(run.spark, start, _caught_up).observed("length", "n"))
    zero = F.lit(0).cast("bigint")
    last = log.read().agg(F.max_by(F.struct("n_distinct", "largest"), F.col("batch_id")).alias("s"))
    total = lengths.read().groupBy("batch").agg(F.max("n_rows").alias("n")).agg(F.coalesce(F.sum("n"), zero).alias("n_items"))
    # two tables of one row
    return total.withColumn("k", F.lit(0)).join(last.withColumn("k", F.lit(0)), "k").select(
        "n_items", F.coalesce("s.n_distinct", zero).alias("n_distinct"), F.greatest(F.coalesce("s.largest", zero), zero).alias("largest_item")
    )


# ---- sketches ------------------------------------------------------------------------------------

SKETCH_SCHEMA = T.StructType([T.StructField("sketch", T.BinaryType())])


def standard_error(lg_k: int = LG_K) -> float:
    """The relative standard error of a sketch of 2^lg_k registers, merged ones included."""
    return 1.04 / float(np.sqrt(2.0**lg_k))


def block_sketches(items: DataFrame, block: int, lg_k: int = LG_K) -> DataFrame:
    """``(block, sketch)``: the distinct items of each block of positions as a mergeable sketch."""
    return items.groupBy(F.floor(F.col("pos") / F.lit(int(block))).cast("bigint").alias("block")).agg(F.hll_sketch_agg("item", lg_k).alias("sketch"))


def sketches(run: StreamRun, stream: DataFrame, lg_k: int = LG_K) -> DataFrame:
    """``(batch_id, sketch)``: a sketch per non-empty micro-batch, 2^lg_k bytes at most each."""
    log = BatchLog(run.spark, run.sink("sketches"), SKETCH_SCHEMA)

    def on_batch(df: DataFrame, batch_id: int) -> None:
        log.write(df.agg(F.count(F.lit(1)).alias("n"), F.hll_sketch_agg("item", lg_k).alias("sketch")).filter("n > 0").select("sketch"), batch_id)

    checkpoint = run.checkpoint("sketches")

    def start():
        return stream.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(on_batch).trigger(availableNow=True).start()

    _listened(run.spark, start, _caught_up)
    return log.read().select("batch_id", "sketch")


def sketch_summary(parts: DataFrame) -> DataFrame:
    """``(n_sketches, estimate)`` of sketches merged."""
    return parts.agg(F.count(F.lit(1)).alias("n_sketches"), F.coalesce(F.hll_sketch_estimate(F.hll_union_agg("sketch")), F.lit(0)).cast("bigint").alias("estimate"))
