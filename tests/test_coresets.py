"""One-pass coresets against the same traversals on lists, and against the exact coreset."""

import hashlib

import numpy as np
import pytest

from tessera.operators import coresets as C
from tessera.operators import kcenter as K

from test_kcenter import fft_indices


def picked(rows, k):
    xy = np.array([(x, y) for _, x, y in rows], np.float32)
    return [rows[i] for i in fft_indices(xy[:, 0], xy[:, 1], k)]


def of_block(rows, k, chunk):
    rows, centers = sorted(rows), []
    for at in range(0, len(rows), chunk):
        full = at + chunk <= len(rows)
        centers.append(picked(rows[at : at + chunk], k))
        if full and sum(map(len, centers)) >= max(chunk, 2 * k):
            centers = [picked(sum(centers, []), k)]
    return centers[0] if len(centers) == 1 else picked(sum(centers, []), k)


def plainly(rows, k, parts, blocks, chunk):
    dealt = {}
    for row in rows:
        dealt.setdefault(int(hashlib.md5(str(row[0]).encode()).hexdigest()[:8], 16) % (parts * blocks), []).append(row)
    out = []
    for part in range(parts):
        found = [of_block(dealt[b], k, chunk) for b in sorted(dealt) if b % parts == part]
        if found:
            out += [(part, n, *row) for n, row in enumerate(found[0] if len(found) == 1 else picked(sum(found, []), k))]
    return out


@pytest.mark.parametrize("blocks, chunk", [(1, 1 << 16), (4, 1 << 16), (3, 16), (1, 7)])
def test_one_pass_equals_the_traversals_on_lists(spark, blocks, chunk):
    r = np.random.default_rng(5)
    # a third of the rows have one id, some points are equal
    rows = [(7 if i % 3 == 0 else i, float(np.float32(x)), float(np.float32(y))) for i, (x, y) in enumerate(r.integers(0, 60, (600, 2)) / 4)]
    pts = spark.createDataFrame(rows, "id bigint, x float, y float").repartition(5)
    got = sorted(tuple(x) for x in C.one_pass_coreset(pts, 5, 3, blocks, chunk=chunk).collect())
    assert got == plainly(rows, 5, 3, blocks, chunk)


def test_one_block_of_one_chunk_is_the_exact_coreset(spark):
    r = np.random.default_rng(6)
    pts = spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(r.normal(size=(400, 2)))], "id bigint, x float, y float")
    assert sorted(C.one_pass_coreset(pts, 6, 4, blocks=1).collect()) == sorted(K.coreset(pts, 6, 4).collect())
    # the traversal of all points is within twice the best radius
    bound = K.radius(pts, K.farthest_first(pts, 6)).first().radius
    for blocks, chunk, factor in ((8, 1 << 16, 4), (2, 40, 6)):
        core = C.one_pass_coreset(pts, 6, 1, blocks, chunk=chunk)
        assert K.radius(pts, core.drop("part")).first().radius <= factor * bound


def test_no_points_few_points_and_no_id(spark):
    schema = "id bigint, x float, y float"
    assert C.one_pass_coreset(spark.createDataFrame([], schema), 3, 2).collect() == []
    same = spark.createDataFrame([(i, 1.0, 1.0) for i in range(5)], schema)
    assert [r.pick for r in C.one_pass_coreset(same, 3, 1, 1).collect()] == [0]
    none = spark.createDataFrame([(None, 1.0, 1.0), (None, 2.0, 2.0), (3, 1.0, 1.0)], schema)
    assert sorted((r.x, r.y) for r in C.one_pass_coreset(none, 3, 1).collect()) == [(1.0, 1.0), (2.0, 2.0)]
    assert C.one_pass_centers(none, 1, 1).count() == 1
    with pytest.raises(ValueError):
        C.one_pass_coreset(same, 0, 1)
