import math

import numpy as np
import pytest

from plain import uniforms
from tessera.operators import frequency as Q
from tessera.sources.items import items_from_events

from conftest import SF0001, SF001


def test_params_float32():
    p = Q.FrequencyParams(n=1000, phi=0.02, epsilon=0.01, delta=0.1)
    assert p.m == 50
    at_small = Q.FrequencyParams.for_length(1000)
    assert at_small.n == 1000 and at_small.true_threshold == pytest.approx(75.0, abs=1e-5)


def _items(spark, d=SF001):
    return items_from_events(spark.read.parquet(f"{d}/events.parquet"))


def _sequential(pdf, p: Q.FrequencyParams):
    """The sequential loops over the stream prefix with the same uniforms."""
    pdf = pdf[pdf.pos < p.n].sort_values("pos")
    pos, items = pdf.pos.to_numpy(), pdf.item.to_numpy()
    u1 = uniforms(pos, Q.TAG_RESERVOIR_ACCEPT, p.seed)
    u2 = uniforms(pos, Q.TAG_RESERVOIR_SLOT, p.seed)
    us = uniforms(pos, Q.TAG_STICKY_ACCEPT, p.seed)
    sample, sticky = [], {}
    for k, (t, it) in enumerate(zip(pos, items)):
        if len(sample) < p.m:
            sample.append(int(it))
        elif u1[k] * t <= p.m:
            sample[int(math.floor(u2[k] * p.m))] = int(it)
        if it in sticky:
            sticky[it] += 1
        elif us[k] <= p.sticky_p:
            sticky[it] = 1
    return sample, {int(k): v for k, v in sticky.items()}


@pytest.mark.parametrize("d", [SF0001, SF001])
def test_reservoir_and_sticky_equal_sequential_loops(spark, d):
    items = _items(spark, d)
    p = Q.FrequencyParams.for_length(items.count())
    sample, sticky = _sequential(items.toPandas(), p)
    got = sorted(Q.reservoir_sample(items, p).collect())
    assert [r.item for r in got] == sample
    assert {r.item: r.n for r in Q.sticky_counts(items, p).collect()} == sticky


def test_sticky_blocks_do_not_change_counts(spark, monkeypatch):
    items = _items(spark)
    p = Q.FrequencyParams.for_length(items.count())
    want = {r.item: r.n for r in Q.sticky_counts(items, p).collect()}
    monkeypatch.setattr(Q, "STICKY_BLOCK", 37)
    assert {r.item: r.n for r in Q.sticky_counts(items, p).collect()} == want


def test_sticky_never_exceeds_exact(spark):
    items = _items(spark)
    p = Q.FrequencyParams.for_length(items.count())
    exact = {r.item: r.n for r in Q.item_histogram(Q.prefix(items, p)).collect()}
    for r in Q.sticky_counts(items, p).collect():
        assert r.n <= exact[r.item]


def test_short_stream_reservoir_keeps_all_in_order(spark):
    items = spark.createDataFrame([(i, 100 + i) for i in range(5)], "pos bigint, item bigint")
    p = Q.FrequencyParams(n=5, phi=0.02, epsilon=0.01, delta=0.1)
    rows = Q.reservoir_sample(items, p).orderBy("slot").collect()
    assert [r.item for r in rows] == [100, 101, 102, 103, 104]


def test_largest_item_floor_zero(spark):
    neg = spark.createDataFrame([(0, -5), (1, -3)], "pos bigint, item bigint")
    assert Q.distinct_items_summary(neg).first().largest_item == 0
    empty = spark.createDataFrame([], "pos bigint, item bigint")
    r = Q.distinct_items_summary(empty).first()
    assert (r.n_items, r.n_distinct, r.largest_item) == (0, 0, 0)


def test_summary_sizes(spark):
    items = _items(spark)
    p = Q.FrequencyParams.for_length(items.count())
    rows = {r.method: (r.n_held, r.n_estimated) for r in Q.frequent_items_summary(items, p).collect()}
    assert rows["reservoir"][0] == min(p.m, p.n)
    assert rows["exact"][1] == Q.frequent_items(items, p).count()


def test_approximate_distinct_count_is_close(spark):
    items = _items(spark)
    exact = Q.distinct_items_summary(items).first()
    approx = Q.distinct_items_summary(items, approx_rsd=0.02).first()
    assert (approx.n_items, approx.largest_item) == (exact.n_items, exact.largest_item)
    assert abs(approx.n_distinct - exact.n_distinct) <= 0.1 * exact.n_distinct


def test_sticky_plan_aggregates_before_it_shuffles(spark):
    """No window and no sort of raw rows; the flag join carries no broadcast hint."""
    items = _items(spark)
    p = Q.FrequencyParams.for_length(items.count())
    plan = Q.sticky_counts(items, p)._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and "Sort" not in plan
    hinted = Q.sticky_frequent_items(items, p)._jdf.queryExecution().analyzed().toString()
    assert "ResolvedHint" not in hinted and "UnresolvedHint" not in hinted


def test_sticky_on_a_single_hot_item(spark, monkeypatch):
    monkeypatch.setattr(Q, "STICKY_BLOCK", 64)
    items = spark.range(5000).selectExpr("id AS pos", "7L AS item")
    p = Q.FrequencyParams(n=5000, phi=0.02, epsilon=0.01, delta=0.1)
    _, want = _sequential(items.toPandas(), p)
    assert {r.item: r.n for r in Q.sticky_counts(items, p).collect()} == want
