"""Ball counts on the adaptive grid against the ring join and sequential loops."""

import math
import random

import numpy as np
import plain
import pytest
from pyspark.sql import functions as F

from tessera.operators import outliers as O
from tessera.operators.ball_tree import ball_counts_adaptive, cell_pairs

SCHEMA = "id bigint, x float, y float"


def counts(df):
    rows = df.collect()
    out = {r.id: r.ball for r in rows}
    assert len(out) == len(rows)
    return out


def brute(rows, d):
    x, y = (np.array([r[k] for r in rows], np.float32) for k in (1, 2))
    dx, dy = ((z[:, None] - z[None, :]).astype(float) for z in (x, y))
    near = np.sqrt(dx * dx + dy * dy).astype(np.float32) <= np.float32(d)
    return {r[0]: int(n) for r, n in zip(rows, near.sum(1))}


def test_15_points(n15, xy15):
    got = counts(ball_counts_adaptive(n15, 1.0, leaf=1))
    assert [got[i] for i in range(15)] == plain.balls(xy15, 1.0)


@pytest.mark.parametrize("d", [1.0, math.sqrt(2.0)])
def test_lattice_of_pairs_at_the_distance(spark, d):
    rows = [(i * 8 + j, float(i - 4), float(j - 4)) for i in range(8) for j in range(8)]
    assert counts(ball_counts_adaptive(spark.createDataFrame(rows, SCHEMA), d, leaf=1)) == brute(rows, d)


def test_dense_places_weights_and_repeated_points(spark):
    r = random.Random(3)
    at = [(r.gauss(0, 0.6), r.gauss(0, 0.6)) for _ in range(900)] + [(r.uniform(-9, 9), r.uniform(-9, 9)) for _ in range(200)]
    at += [(0.25, -0.5)] * 70 + [(1e6, -1e6), (1e6, -1e6 + 0.5)]
    rows = [(n, *p) for n, p in enumerate(at)]
    pts = spark.createDataFrame(rows, SCHEMA)
    want = brute(rows, 1.0)
    for leaf in (4, 32):
        assert counts(ball_counts_adaptive(pts, 1.0, leaf)) == want
    folded = pts.groupBy("x", "y").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("w"))
    assert counts(ball_counts_adaptive(folded, 1.0, 8)) == {i: n for i, n in want.items() if i in {x.id for x in folded.collect()}}


def test_no_points_and_bad_distance(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert ball_counts_adaptive(none, 1.0).collect() == []
    with pytest.raises(ValueError):
        ball_counts_adaptive(none, 0.0)


def compared(pts, leaf=16):
    """Pairs of points that are compared, and pairs of cells that were looked at last."""
    _, leaves, _, near, _ = cell_pairs(pts, 1.0, leaf)
    n = leaves.groupBy("l", "i", "j").count()
    p, q = n.toDF("pl", "pi", "pj", "pn"), n.toDF("ql", "qi", "qj", "qn")
    return near.join(p, ["pl", "pi", "pj"]).join(q, ["ql", "qi", "qj"]).agg(F.sum(F.col("pn") * F.col("qn"))).first()[0]


def test_pairs_grow_less_than_with_the_square(spark):
    made = []
    for n in (4000, 16000):  # a third of the points in one cell of the ring join
        g = np.random.default_rng(n)
        at = np.concatenate([g.uniform(0, 0.3, (n // 3, 2)), g.uniform(-1, 1, (n - n // 3, 2))])
        pts = spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(at)], SCHEMA)
        made.append(compared(pts))
    assert made[1] < 4**1.6 * made[0]
    assert made[1] < 0.1 * 16000**2
    assert counts(ball_counts_adaptive(pts, 1.0)) == counts(O.ball_counts(pts, 1.0))
