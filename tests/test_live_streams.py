"""Streams that live across batches: stops, restarts, refusals, keyed state, observed metrics, sketches."""

import os
import random

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tessera.functions.hashing import uniform
from tessera.operators import frequency as Q
from tessera.sources.items import items_from_events
from tessera.streaming import items as S
from tessera.streaming import live as L
from tessera.streaming.queries import SLICES, slice_of, sliced_events

from conftest import SF0001


def written(folder, parts):
    import os

    for k, part in enumerate(parts):
        path = folder / f"part-{k:03d}.parquet"
        pq.write_table(part, path)
        os.utime(path, (1_700_000_000 + k, 1_700_000_000 + k))  # read in this order
    return str(folder)


@pytest.fixture(scope="module")
def parts():
    """The events by position in 6 parts, rows shuffled inside each."""
    table = pq.read_table(f"{SF0001}/events.parquet").sort_by("event_id")
    step = -(-table.num_rows // 6)
    cut = [table.slice(k * step, step) for k in range(6)]
    return [t.take(list(range(t.num_rows))[::-1]) for t in cut]


@pytest.fixture(scope="module")
def batch(spark):
    items = items_from_events(spark.read.parquet(f"{SF0001}/events.parquet"))
    # few items are tracked at this rate
    return items, Q.FrequencyParams(n=1000, phi=0.2, epsilon=0.15, delta=0.1, seed=3)


def stream(spark, folder, params=None):
    return S.item_stream(spark, folder, max_files_per_trigger=1)


def test_keyed_sticky_holds_tracked_items_only(spark, parts, batch, tmp_path):
    items, p = batch
    # every item its own: the table would be as long as the stream if all were held
    own = items.withColumn("item", F.col("pos") % 300)
    made = [t.set_column(t.schema.get_field_index("user_id"), "user_id", pa.array([i % 300 for i in t["event_id"].to_pylist()], pa.int64())) for t in parts]
    run = S.StreamRun(spark, "keyed")
    got, progress = L.sticky_keyed(run, stream(spark, written(tmp_path, made)), p)
    want = sorted(Q.sticky_counts(own, p).collect())
    assert sorted(got.collect()) == want and 0 < len(want) < 100
    assert len(progress.batches) == 6 and progress.state_rows[5] == len(want)
    # a batch that is replayed after its sink was written: the state before it, the same part again
    again = S.StreamRun(spark, "keyed", base=run.base)
    assert sorted(L.sticky_keyed(again, stream(spark, str(tmp_path)), p)[0].collect()) == want


def test_keyed_sticky_replays_a_batch(spark, parts, batch, tmp_path, monkeypatch):
    items, p = batch
    run, folder = S.StreamRun(spark, "replay"), written(tmp_path, parts)
    plain, calls = S.LatestLog.write, []

    def fails_once(self, df, batch_id):
        plain(self, df, batch_id)
        calls.append(batch_id)
        if batch_id == 3 and calls.count(3) == 1:
            raise OSError("lost after the sink was written")

    monkeypatch.setattr(S.LatestLog, "write", fails_once)
    with pytest.raises(Exception, match="lost after"):
        L.sticky_keyed(run, stream(spark, folder), p)
    got, _ = L.sticky_keyed(run, stream(spark, folder), p)
    assert calls == [0, 1, 2, 3, 3, 4, 5] and sorted(got.collect()) == sorted(Q.sticky_counts(items, p).collect())


def test_keyed_sticky_refuses_positions_out_of_order(spark, parts, batch, tmp_path):
    items, p = batch
    folder = written(tmp_path, [parts[0], parts[2], parts[1], *parts[3:]])
    run = S.StreamRun(spark, "refused")
    with pytest.raises(Exception, match="PositionsOutOfOrder"):
        L.sticky_keyed(run, stream(spark, folder), p)
    # the documented way for such a stream
    assert sorted(S.sticky(S.StreamRun(spark, "any"), stream(spark, folder), p).collect()) == sorted(Q.sticky_counts(items, p).collect())


def test_keyed_sticky_calls_python_per_group(spark, tmp_path, monkeypatch):
    """Many items in few groups: a call per group and batch, not per item, each in many chunks."""
    n, rnd = 3000, random.Random(5)
    made = [None if pos % 50 == 7 else 2**60 + rnd.randrange(700) ** 2 for pos in range(n)]
    rows = list(enumerate(made))
    for k in range(3):
        part = rnd.sample(rows[1000 * k : 1000 * (k + 1)], 1000)  # a later chunk brings earlier positions
        pq.write_table(pa.table({"event_id": [p for p, _ in part], "user_id": pa.array([i for _, i in part], pa.int64())}), tmp_path / f"part-{k}.parquet")
        os.utime(tmp_path / f"part-{k}.parquet", (1_700_000_000 + k, 1_700_000_000 + k))
    calls, plain = tmp_path / "calls", L._Track.handleInputRows

    def counted(self, key, rows, timer):
        with open(calls, "a") as f:
            f.write(f"{key[0]}\n")
        return plain(self, key, rows, timer)

    monkeypatch.setattr(L._Track, "handleInputRows", counted)
    monkeypatch.setattr(L, "GROUPS", 4)
    before = {k: spark.conf.get(k, None) for k in L.STATE_STORE}
    p = Q.FrequencyParams(n=2900, phi=0.02, epsilon=0.015, delta=0.1, seed=3)
    assert 0.05 < p.sticky_p < 0.3  # items wait for their start
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "16")
    try:
        got, progress = L.sticky_keyed(S.StreamRun(spark, "groups"), stream(spark, str(tmp_path)), p)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    us = {r.pos: r.u for r in spark.range(n).select(F.col("id").alias("pos")).withColumn("u", uniform("pos", Q.TAG_STICKY_ACCEPT, p.seed)).collect()}
    want = {}
    for pos, item in rows[: p.n]:
        if item in want or us[pos] <= p.sticky_p:
            want[item] = want.get(item, 0) + 1
    assert {r.item: r.n for r in got.collect()} == want and None in want
    assert 100 < len(want) < len(set(made)) and progress.state_rows[2] == len(want)
    assert sorted(calls.read_text().split()) == sorted(["-1", "0", "1", "2", "3"] * 3)
    assert {k: spark.conf.get(k, None) for k in L.STATE_STORE} == before


def test_stream_stops_itself(spark, parts, tmp_path):
    sizes = [t.num_rows for t in parts]
    n = sizes[0] + sizes[1] + 1  # crossed by the third batch
    run, folder = S.StreamRun(spark, "stops"), written(tmp_path, parts)
    rows, progress = L.prefix_until(run, stream(spark, folder), n)
    assert rows.count() == sum(sizes[:3])
    assert {b: m["rows"] for b, m in progress.batches.items() if m["rows"]} == dict(enumerate(sizes[:3]))
    # fewer items than asked for: ended when nothing more comes
    rows, progress = L.prefix_until(S.StreamRun(spark, "short"), stream(spark, folder), 10**6, idle=2.0)
    assert rows.count() == sum(sizes) and len(progress.batches) == 6


def test_stop_and_resume(spark, parts, batch, tmp_path):
    items, _ = batch
    run, folder = S.StreamRun(spark, "resume"), written(tmp_path, parts)
    told = []

    def drive(*args):
        told.append(L.live_driver(3)(*args))

    half = S.histogram(run, stream(spark, folder), drive=drive)
    assert half.agg(F.sum("n")).first()[0] == sum(t.num_rows for t in parts[:3]) and sorted(told[0].batches)[:3] == [0, 1, 2]
    whole = S.histogram(run, stream(spark, folder))
    assert sorted(whole.collect()) == sorted(Q.item_histogram(items).collect())


def test_observed_sizes_and_chained_summary(spark, parts, batch, tmp_path):
    items, _ = batch
    folder = written(tmp_path, [*parts[:2], parts[0].slice(0, 0), *parts[2:]])
    got = L.observed_sizes(S.StreamRun(spark, "sizes"), stream(spark, folder))
    assert sorted(r.n_rows for r in got.collect()) == sorted(t.num_rows for t in parts)
    got = L.distinct_chained(S.StreamRun(spark, "chained"), stream(spark, folder))
    assert got.collect() == Q.distinct_items_summary(items).collect()
    (tmp_path / "none").mkdir()
    none = stream(spark, str(tmp_path / "none"))
    assert L.distinct_chained(S.StreamRun(spark, "none"), none).collect() == [(0, 0, 0)]
    assert L.observed_sizes(S.StreamRun(spark, "none"), none).collect() == []


def test_sketches_merge(spark, tmp_path):
    items = spark.range(20_000).select(F.col("id").alias("pos"), (F.col("id") % 7_000).alias("item"))
    one = L.sketch_summary(L.block_sketches(items, 20_000)).first()
    many = L.sketch_summary(L.block_sketches(items, 1_000)).first()
    assert (one.n_sketches, many.n_sketches) == (1, 20)
    for r in (one, many):
        assert abs(r.estimate - 7_000) <= 3 * L.standard_error() * 7_000
    assert L.sketch_summary(L.block_sketches(items.limit(0), 5)).collect() == [(0, 0)]


def test_slices_leave_no_event_out(spark):
    ids = [None, -5, 0, 3, 4, 11, 12, 29, 30, 10**12]
    events = spark.createDataFrame([(i,) for i in ids], "event_id bigint")
    found = [[r.event_id for r in events.filter(slice_of(5, k)).collect()] for k in range(6)]
    assert sorted((x is None, x or 0) for part in found for x in part) == sorted((x is None, x or 0) for x in ids)
    assert found[0] == [None, -5, 0, 3, 4] and found[5] == [29, 30, 10**12]


@pytest.mark.parametrize("cores", [3, 6, 8])
def test_a_slice_per_batch_on_any_number_of_cores(spark, tmp_path, monkeypatch, cores):
    monkeypatch.setattr(type(spark.sparkContext), "defaultParallelism", cores)
    pq.write_table(pa.table({"event_id": list(range(600)), "user_id": [i % 7 for i in range(600)]}), tmp_path / "events.parquet")
    got = L.observed_sizes(S.StreamRun(spark, "cores"), sliced_events(spark, str(tmp_path)))
    assert [tuple(r) for r in got.orderBy("batch_id").collect()] == [(k, 100) for k in range(SLICES)]
