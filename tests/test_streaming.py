import os

import pyarrow.parquet as pq
import pytest

from tessera.operators import frequency as Q
from tessera.sources.items import items_from_events
from tessera.streaming import items as S

from conftest import SF001


@pytest.fixture(scope="module")
def split_events(tmp_path_factory):
    """events split by position into 4 files, so a file stream sees 4 micro-batches."""
    table = pq.read_table(f"{SF001}/events.parquet").sort_by("event_id")
    out = tmp_path_factory.mktemp("events")
    step = (table.num_rows + 3) // 4
    for k in range(4):
        pq.write_table(table.slice(k * step, step), out / f"part-{k:03d}.parquet")
    return str(out)


def _batch(spark):
    items = items_from_events(spark.read.parquet(f"{SF001}/events.parquet"))
    return items, Q.FrequencyParams.for_length(items.count())


def _stream(spark, folder):
    return S.item_stream(spark, folder, max_files_per_trigger=1)


def test_stream_equals_batch_over_four_batches(spark, split_events):
    items, p = _batch(spark)
    run = S.StreamRun(spark, "test")
    sizes = S.batch_sizes(run, _stream(spark, split_events)).collect()
    assert len(sizes) == 4 and sum(r.n_rows for r in sizes) == 10000
    assert sorted(S.histogram(run, _stream(spark, split_events), p).collect()) == sorted(
        Q.item_histogram(Q.prefix(items, p)).collect()
    )
    assert sorted(S.reservoir(run, _stream(spark, split_events), p).collect()) == sorted(
        Q.reservoir_sample(items, p).collect()
    )
    assert sorted(S.sticky(run, _stream(spark, split_events), p).collect()) == sorted(
        Q.sticky_counts(items, p).collect()
    )
    assert sorted(r.item for r in S.distinct_items(run, _stream(spark, split_events), p).collect()) == sorted(
        r.item for r in Q.distinct_items(Q.prefix(items, p)).collect()
    )


@pytest.mark.parametrize("order", ["forward", "backward", "shuffled"])
def test_sticky_for_any_order_of_batches(spark, tmp_path, order):
    """Files by position in order, reversed, and with positions dealt over all files."""
    items, p = _batch(spark)
    table = pq.read_table(f"{SF001}/events.parquet").sort_by("event_id")
    step = (table.num_rows + 3) // 4
    parts = [table.slice(k * step, step) for k in range(4)]
    if order == "shuffled":
        parts = [table.take(list(range(k, table.num_rows, 4))) for k in (2, 0, 3, 1)]
    for k, part in enumerate(parts[::-1] if order == "backward" else parts):
        pq.write_table(part, tmp_path / f"part-{k:03d}.parquet")
        os.utime(tmp_path / f"part-{k:03d}.parquet", (1_700_000_000 + k, 1_700_000_000 + k))
    got = S.sticky(S.StreamRun(spark, "order"), _stream(spark, str(tmp_path)), p)
    assert sorted(got.collect()) == sorted(Q.sticky_counts(items, p).collect())


def test_line_stream_is_numbered_as_it_arrives(spark, tmp_path):
    values = [(37 * i) % 211 for i in range(3000)]
    for k in range(3):
        f = tmp_path / f"lines-{k}.txt"
        f.write_text("".join(f"{v}\n" for v in values[1000 * k : 1000 * (k + 1)]))
        os.utime(f, (1_700_000_000 + k, 1_700_000_000 + k))
    run = S.StreamRun(spark, "lines")
    lines = S.line_stream(spark, str(tmp_path), max_files_per_trigger=1)
    folder = S.positioned(run, lines)
    rows = spark.read.parquet(folder).select("pos", "item").collect()
    assert sorted((r.pos, r.item) for r in rows) == list(enumerate(values))
    S.positioned(run, lines)  # nothing new to read: nothing is numbered again
    assert spark.read.parquet(folder).count() == 3000
    items = spark.createDataFrame(list(enumerate(values)), "pos bigint, item bigint")
    p = Q.FrequencyParams(n=2500, phi=0.01, epsilon=0.004, delta=0.1)
    stream = S.numbered_stream(spark, folder, max_files_per_trigger=1)
    assert sorted(S.reservoir(run, stream, p).collect()) == sorted(Q.reservoir_sample(items, p).collect())
    assert sorted(S.sticky(run, stream, p).collect()) == sorted(Q.sticky_counts(items, p).collect())
    with pytest.raises(ValueError, match="positions"):
        S.histogram(run, lines, p)


def test_replayed_batch_changes_nothing(spark, split_events):
    """A sink part is written under its batch id: delivering a batch again leaves the result."""
    run = S.StreamRun(spark, "replay")
    counts = S.histogram(run, _stream(spark, split_events))
    before = sorted(counts.collect())
    log = S.LatestLog(spark, run.sink("histogram"), S.COUNT_SCHEMA, ["item"])
    again = spark.createDataFrame(log.part(2).select("item", "n").collect(), S.COUNT_SCHEMA)
    log.write(again, 2)
    assert sorted(log.latest().collect()) == before


def test_merged_parts_are_read_once(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(S, "COMPACT_EVERY", 3)
    log = S.LatestLog(spark, str(tmp_path / "log"), S.COUNT_SCHEMA, ["item"])
    want = {}
    for b in range(8):
        rows = [(i, 10 * b + i) for i in range(b % 4, 6)]
        want.update(rows)
        for _ in range(2):  # each batch twice
            log.write(spark.createDataFrame(rows, S.COUNT_SCHEMA), b)
        assert dict(sorted((r.item, r.n) for r in log.latest().collect())) == dict(sorted(want.items()))


def test_missing_length_is_an_error(spark, tmp_path):
    log = S.BatchLog(spark, str(tmp_path / "lengths"), S.PROGRESS_SCHEMA)
    assert S._total_before(log, 0) == 0
    with pytest.raises(RuntimeError, match="micro-batch 3"):
        S._total_before(log, 4)


def test_whole_batch_prefix_overshoots(spark, split_events):
    run = S.StreamRun(spark, "prefix")
    rows = S.prefix_whole_batches(run, _stream(spark, split_events), 6000)
    assert rows.count() == 7500
