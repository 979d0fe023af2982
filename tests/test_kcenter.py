import numpy as np
import plain
import pytest
from pyspark.sql import functions as F

from tessera.operators import kcenter as K
from tessera.operators import outliers as O
from tessera.sources.points import points_from_embeddings, points_from_lineitem

from conftest import SF001


def fft_indices(xs, ys, k):
    """The traversal on arrays in list order: row positions of the centers."""
    xs, ys = xs.astype(np.float32), ys.astype(np.float32)
    nearest, picks = np.full(len(xs), np.finfo(np.float32).max, np.float32), [0]
    while len(picks) < k:
        dx, dy = (xs - xs[picks[-1]]).astype(float), (ys - ys[picks[-1]]).astype(float)
        nearest = np.minimum(nearest, np.sqrt(dx * dx + dy * dy).astype(np.float32))
        if not nearest.max() > 0:
            break
        picks.append(int(np.argmax(nearest)))
    return picks


def _xy(df):
    return [(round(r.x, 6), round(r.y, 6)) for r in df.orderBy("pick").collect()]


def test_farthest_first_of_15_points(n15, xy15):
    for k in (2, 3, 4):
        centers = K.farthest_first(n15, k)
        want = [xy15[i] for i in plain.farthest_first(xy15, k)]
        assert _xy(centers) == want
        assert K.radius(n15, centers).first().radius == plain.radius(xy15, want)


def test_three_rounds_of_15_points(n15, xy15):
    centers = K.mr_centers(n15, 3, 2, assign="mod")
    want = plain.three_rounds(xy15, 3, 2)
    assert _xy(centers) == want
    assert K.radius(n15, centers).first().radius == plain.radius(xy15, want)


@pytest.mark.parametrize("k", [2, 3, 4])
def test_radius_then_outliers_of_15_points(n15, xy15, k):
    r = K.radius(n15, K.mr_centers(n15, k, 2, assign="mod")).first().radius
    got = O.approx_outlier_counts(n15, r, 3).first()
    assert (got.sure_outliers, got.uncertain_points) == plain.totals(xy15, plain.radius(xy15, plain.three_rounds(xy15, k, 2)), 3)


def test_fewer_distinct_points_than_k(spark):
    pts = spark.createDataFrame([(i, 1.0, 1.0) for i in range(5)] + [(9, 2.0, 2.0)], "id bigint, x float, y float")
    assert K.farthest_first(pts, 5).count() == 2
    assert K.mr_centers(pts, 5, 1).count() == 2


def test_empty_part_emits_nothing(spark):
    pts = spark.createDataFrame([(0, 0.0, 0.0), (3, 1.0, 1.0)], "id bigint, x float, y float")
    core = K.coreset(pts, 2, 3, assign="mod").collect()
    assert {r.part for r in core} == {0}


def test_k_must_be_positive(n15):
    with pytest.raises(ValueError):
        K.coreset(n15, 0, 2)


def test_coreset_matches_numpy_and_radius_bound(spark):
    pts = points_from_embeddings(spark.read.parquet(f"{SF001}/embeddings.parquet"))
    pdf = pts.toPandas().sort_values("id")
    core = K.coreset(pts, 4, 3, assign="mod").toPandas()
    for part, grp in pdf.groupby(pdf["id"] % 3):
        picks = fft_indices(grp["x"].to_numpy(), grp["y"].to_numpy(), 4)
        want = grp.iloc[picks]["id"].tolist()
        assert core[core.part == part].sort_values("pick")["id"].tolist() == want
    assert set(core["id"]) <= set(pdf["id"])
    mr = K.radius(pts, K.mr_centers(pts, 4, 3)).first().radius
    seq = K.radius(pts, K.farthest_first(pts, 4)).first().radius
    # both are 2-approximations of the optimum on their inputs: the coreset radius is within 4x of
    # the optimum, so within 4x of the sequential radius (which is >= the optimum)
    assert mr <= 4 * seq + 1e-6


def test_hash_parts_are_balanced(spark):
    # ids that are all multiples of L would put every point in one part under pmod(id, L)
    pts = spark.createDataFrame([(3 * i, float(i % 17), float(i % 23)) for i in range(300)], "id bigint, x float, y float")
    sizes = [r["count"] for r in pts.groupBy(K.part_of(pts["id"], 3).alias("p")).count().collect()]
    assert len(sizes) == 3 and min(sizes) > 60
    centers = K.mr_centers(pts, 4, 8).collect()
    assert len(centers) == 4 and {r.id for r in centers} <= {3 * i for i in range(300)}


def test_one_part_of_any_size_is_never_gathered(spark):
    """L = 1 on all lineitem points: the rounds only aggregate, no Python and no shuffle of points."""
    pts = points_from_lineitem(spark.read.parquet("/root/testdata/sf0.1/lineitem.parquet")).withColumn("id", F.xxhash64("x", "y"))
    centers = K.coreset(pts, 3, 1).collect()
    pdf = pts.select("id", "x", "y").toPandas().sort_values("id").reset_index(drop=True)
    want = pdf.iloc[fft_indices(pdf["x"].to_numpy(), pdf["y"].to_numpy(), 3)]["id"].tolist()
    assert [r.id for r in sorted(centers, key=lambda r: r.pick)] == want


def test_many_rounds_cross_checkpoints(spark):
    # more rounds than CHECKPOINT_EVERY: the distance column is checkpointed mid-way
    pts = points_from_embeddings(spark.read.parquet(f"{SF001}/embeddings.parquet"))
    pdf = pts.toPandas().sort_values("id").reset_index(drop=True)
    want = pdf.iloc[fft_indices(pdf["x"].to_numpy(), pdf["y"].to_numpy(), 12)]["id"].tolist()
    got = [r.id for r in K.farthest_first(pts, 12).orderBy("pick").collect()]
    assert got == want
