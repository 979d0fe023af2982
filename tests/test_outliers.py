import math

import numpy as np
import plain
import pytest

from tessera.operators import outliers as O
from tessera.sources.points import parse_points, points_from_embeddings

from conftest import SF001


def test_ball_counts_of_15_points(n15, xy15):
    got = {r.id: r.ball for r in O.ball_counts(n15, 1.0).collect()}
    assert [got[i] for i in range(15)] == plain.balls(xy15, 1.0)


def test_exact_outliers_in_report_order(n15, xy15):
    want = sorted((n, i) for i, n in enumerate(plain.balls(xy15, 1.0)) if n <= 3)
    assert 0 < len(want) < 15
    assert [(r.ball, r.id) for r in O.exact_outliers_topk(n15, 1.0, 3, 100).collect()] == want
    assert O.exact_outlier_count(n15, 1.0, 3).first().n_outliers == len(want)


def test_approx_counts_and_cells_of_15_points(n15, xy15):
    r = O.approx_outlier_counts(n15, 1.0, 3).first()
    assert (r.sure_outliers, r.uncertain_points) == plain.totals(xy15, 1.0, 3)
    want = sorted((n, i, j) for (i, j), n in plain.cells(xy15, 1.0).items())
    assert O.cell_counts(n15, 1.0).count() == len(want)
    assert [(r.n, r.i, r.j) for r in O.smallest_cells(n15, 1.0, 9).collect()] == want[:9]


def test_regions_are_consistent(n15):
    for r in O.approx_regions(n15, 1.0).collect():
        assert r.n <= r.n3 <= r.n7


def test_sure_within_exact_within_sure_or_uncertain(spark):
    pts = points_from_embeddings(spark.read.parquet(f"{SF001}/embeddings.parquet"))
    labels = {r.id: r.label for r in O.point_labels(pts, 0.05, 5).collect()}
    exact = {r.id for r in O.exact_outliers(pts, 0.05, 5).collect()}
    sure = {i for i, lab in labels.items() if lab == "sure"}
    unsure = {i for i, lab in labels.items() if lab == "uncertain"}
    assert sure <= exact <= sure | unsure
    assert (len(sure), len(unsure), len(exact)) == (18, 150, 64)


def test_exact_equals_brute_force_on_lattice_with_ties(spark):
    # integer lattice: many pairs exactly at distance D, the border case of the grid
    rows = [(i * 10 + j, float(i), float(j)) for i in range(10) for j in range(10)]
    pts = spark.createDataFrame(rows, "id bigint, x float, y float")
    for d in (1.0, 2.0, math.sqrt(2.0), 3.0):
        d32 = float(__import__("numpy").float32(d))
        brute = {}
        for a, ax, ay in rows:
            brute[a] = sum(
                1 for _, bx, by in rows
                if float(__import__("numpy").float32(math.sqrt((ax - bx) ** 2 + (ay - by) ** 2))) <= d32
            )
        got = {r.id: r.ball for r in O.ball_counts(pts, d).collect()}
        assert got == brute


def test_weighted_points_count_multiplicity(spark):
    pts = spark.createDataFrame([(1, 0.0, 0.0, 3), (2, 0.5, 0.0, 2), (3, 9.0, 9.0, 1)], "id bigint, x float, y float, w bigint")
    got = {r.id: r.ball for r in O.ball_counts(pts, 1.0).collect()}
    assert got == {1: 5, 2: 5, 3: 1}
    assert O.exact_outlier_count(pts, 1.0, 2).first().n_outliers == 1


@pytest.mark.parametrize("broadcast,skew", [("10m", False), ("-1", False), ("-1", True)])
def test_ring_join_gives_the_same_balls_however_spark_joins(spark, broadcast, skew):
    """Broadcast or shuffled, with and without splitting of skewed blocks; a block hot on both sides."""
    rows = [(i, 0.001 * (i % 60), 0.001 * (i // 60)) for i in range(2400)] + [(5000 + i, float(i), 3.0) for i in range(50)]
    pts = spark.createDataFrame(rows, "id bigint, x float, y float")
    xy = np.array([(x, y) for _, x, y in rows], np.float32)
    apart = (xy[:, None] - xy[None]).astype(float)
    want = (np.sqrt((apart**2).sum(-1)).astype(np.float32) <= np.float32(0.02)).sum(1)
    conf = {"spark.sql.autoBroadcastJoinThreshold": broadcast}
    if skew:
        conf |= {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.0",
                 "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k"}
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        assert {r.id: r.ball for r in O.ball_counts(pts, 0.02).collect()} == {r[0]: int(n) for r, n in zip(rows, want)}
        assert {r.id for r in O.exact_outliers(pts, 0.02, 40).collect()} == {r[0] for r, n in zip(rows, want) if n <= 40}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_nothing_runs_while_the_join_is_built(spark):
    """One lazy plan: no job, no cached table; a probe goes to 9 blocks at most, not to 40 cells."""
    pts = points_from_embeddings(spark.read.parquet(f"{SF001}/embeddings.parquet"))
    spark.sparkContext.setJobGroup("build", "build")
    df = O.exact_outlier_count(pts, 0.05, 5)
    assert spark.sparkContext.statusTracker().getJobIdsForGroup("build") == []
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "InMemoryRelation" not in plan and plan.count("explode(sequence(") >= 2 and "inline" not in plan


@pytest.mark.parametrize("d", [0.0, -1.0, float("nan"), float("inf")])
def test_bad_distance_rejected(n15, d):
    with pytest.raises(ValueError):
        O.approx_outlier_counts(n15, d, 3)


def test_parse_errors(spark):
    bad = spark.createDataFrame([("1.0,abc",)], "value string")
    with pytest.raises(Exception):
        parse_points(bad).collect()
    one = spark.createDataFrame([("1.0",)], "value string")
    with pytest.raises(Exception):
        parse_points(one).collect()
    nan = spark.createDataFrame([("NaN,1.0",)], "value string")
    with pytest.raises(Exception):
        parse_points(nan).collect()
    extra = spark.createDataFrame([("1.5, 2.5,zzz",)], "value string")
    r = parse_points(extra).first()
    assert (r.x, r.y) == (1.5, 2.5)


def test_grid_plan_has_no_join(n15):
    plan = O.approx_outlier_counts(n15, 1.0, 3)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan


def test_fold_duplicates_gives_multiplicities(spark):
    from tessera.sources.points import fold_duplicates

    raw = spark.createDataFrame([(1, 0.0, 0.0), (2, 0.0, 0.0), (3, 0.0, 0.0), (4, 0.5, 0.0), (5, 9.0, 9.0)],
                                "id bigint, x float, y float")
    folded = fold_duplicates(raw)
    assert sorted((r.id, r.w) for r in folded.collect()) == [(1, 3), (4, 1), (5, 1)]
    balls = {r.id: r.ball for r in O.ball_counts(folded, 1.0).collect()}
    assert balls == {1: 4, 4: 4, 5: 1}
