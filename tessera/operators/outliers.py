"""Distance-based (D, M) outliers on 2-D points.

A point p is an outlier when its ball B(p, D) -- the points within distance D of p, p itself
included -- holds at most M points.

Approximate method (grid of side lambda = D / (2*sqrt(2))): each occupied cell gets N3, the points
in its 3x3 block, and N7, the points in its 7x7 block. Cells with N7 <= M hold sure outliers, cells
with N3 <= M < N7 hold uncertain points. The 7x7 sums are one aggregation: every occupied cell
sends its count to the cells around it -- as two separable passes, along i then along j, each a
partially aggregated shuffle (no join).

Exact method: a theta self-join (distance <= D) rewritten as an equi-join on a private grid whose
3x3 block has diameter 0.97*D. All points of the 3x3 block are inside the ball, so they are counted
wholesale (N3'); only the 40 ring cells of the 7x7 block are joined pair by pair. For outliers, only
cells with N3' <= M can hold one, so only their points probe the ring. The join is one lazy plan by
blocks of cells, see ``_ring_counts``: no job runs and nothing is cached while it is built.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.floats import f32, require_positive_finite
from tessera.functions.geometry import SQRT8, cell_side, cell_side_col, sql_distance

# fixed values of the method
EXACT_GRID_SLACK = 0.97  # private grid: 3x3 block diameter is 0.97*D, 7x7 reach is 1.029*D


def _double(v: float) -> str:
    return f"CAST('{float(v)!r}' AS DOUBLE)"


def _float(v: float) -> str:
    return f"CAST({_double(f32(v))} AS FLOAT)"


def with_weight(points: DataFrame) -> DataFrame:
    """Add ``w = 1`` unless the point set already carries multiplicities."""
    if "w" in points.columns:
        return points.withColumn("w", F.col("w").cast("bigint"))
    return points.withColumn("w", F.lit(1).cast("bigint"))


# --------------------------------------------------------------------------------------------
# approximate method
# --------------------------------------------------------------------------------------------


def grid_cells(points: DataFrame, distance_d: float | Column) -> DataFrame:
    """``(id, x, y, w, i, j)``: the cell of every point on the grid of side D/(2*sqrt(2)).

    The quotient is float32 (Spark divides in double; rounding it to float gives the float32
    quotient), then floored, as in the reference.
    """
    pts = with_weight(points)
    if isinstance(distance_d, Column):
        side = F.when(
            (distance_d > 0) & (distance_d < float("inf")), cell_side_col(distance_d)
        ).otherwise(F.raise_error(F.lit("D must be a positive finite number")).cast("float"))
        return pts.select(
            "id", "x", "y", "w",
            F.floor((F.col("x") / side).cast("float")).cast("bigint").alias("i"),
            F.floor((F.col("y") / side).cast("float")).cast("bigint").alias("j"),
        )
    side = _float(cell_side(require_positive_finite("D", distance_d)))
    return pts.selectExpr(
        "id", "x", "y", "w",
        f"CAST(floor(CAST(x / {side} AS FLOAT)) AS BIGINT) AS i",
        f"CAST(floor(CAST(y / {side} AS FLOAT)) AS BIGINT) AS j",
    )


def cell_counts(points: DataFrame, distance_d: float | Column) -> DataFrame:
    """``(i, j, n)``: points per occupied cell (partial aggregation before the shuffle)."""
    return grid_cells(points, distance_d).groupBy("i", "j").agg(F.expr("CAST(sum(w) AS BIGINT) AS n"))


def _spread(df: DataFrame, axis: str, reach: int, sums: dict[str, tuple[str, bool]]) -> DataFrame:
    """One pass of a separable box sum: every row sends its sums to the rows within ``reach``
    along ``axis`` (``_i`` or ``_j``); ``sums`` maps output -> (input, inner 3-wide only?); the
    own count ``_own`` is kept at offset 0 only."""
    sent = df.selectExpr("*", f"explode(sequence({-reach}, {reach})) AS _d")
    other = "_j" if axis == "_i" else "_i"
    aggs = [
        (f"CAST(sum(CASE WHEN abs(_d) <= 1 THEN {src} ELSE 0 END) AS BIGINT) AS {out}" if inner
         else f"CAST(sum({src}) AS BIGINT) AS {out}")
        for out, (src, inner) in sums.items()
    ]
    aggs.append("max(CASE WHEN _d = 0 THEN _own END) AS _own")
    return sent.groupBy(F.expr(f"{axis} + _d AS {axis}"), F.col(other)).agg(*[F.expr(a) for a in aggs])


def cell_regions(cells: DataFrame, i: str = "i", j: str = "j", n: str = "n", reach: int = 3) -> DataFrame:
    """``(i, j, n, n3, n7)`` for every occupied cell, from ``(i, j, n)`` (``reach=1``: no n7).

    N3 and N7 are box sums, and box sums are separable: a row pass sends each cell's count to the
    cells within ``reach`` along i, a column pass sends those row sums within ``reach`` along j.
    That is 2 * (2*reach+1) rows per cell through two partially aggregated shuffles instead of
    (2*reach+1)^2 through one. The count at offset (0, 0) carries through both passes and marks
    the occupied cells (the result keeps only those).
    """
    base = cells.selectExpr(f"{i} AS _i", f"{j} AS _j", f"{n} AS _own", f"{n} AS _v")
    wide = {"_s3": ("_v", True)} | ({"_s7": ("_v", False)} if reach >= 3 else {})
    narrow = {"n3": ("_s3", True)} | ({"n7": ("_s7", False)} if reach >= 3 else {})
    cols = _spread(_spread(base, "_i", reach, wide), "_j", reach, narrow)
    out = [f"_i AS {i}", f"_j AS {j}", f"_own AS {n}", "n3"] + (["n7"] if reach >= 3 else [])
    return cols.filter("_own IS NOT NULL").selectExpr(*out)


def cell_class(n3: Column, n7: Column, m: int) -> Column:
    """'sure' when N7 <= M, 'uncertain' when N3 <= M < N7, else 'inlier'."""
    return (
        F.when(n7 <= F.lit(int(m)), F.lit("sure"))
        .when(n3 <= F.lit(int(m)), F.lit("uncertain"))
        .otherwise(F.lit("inlier"))
    )


def approx_regions(points: DataFrame, distance_d: float | Column) -> DataFrame:
    return cell_regions(cell_counts(points, distance_d))


def approx_outlier_counts(points: DataFrame, distance_d: float | Column, m: int) -> DataFrame:
    """One row ``(sure_outliers, uncertain_points)``: totals of points in sure / uncertain cells."""
    m = int(m)
    return approx_regions(points, distance_d).agg(
        F.expr(f"CAST(coalesce(sum(CASE WHEN n7 <= {m} THEN n END), 0) AS BIGINT) AS sure_outliers"),
        F.expr(f"CAST(coalesce(sum(CASE WHEN n3 <= {m} AND n7 > {m} THEN n END), 0) AS BIGINT) AS uncertain_points"),
    )


def point_labels(points: DataFrame, distance_d: float | Column, m: int) -> DataFrame:
    """``(id, label)``: the class of each point's cell.

    Spark broadcasts the cell statistics when they are small; else the join shuffles points by cell.
    """
    cells = grid_cells(points, distance_d)
    regions = cell_regions(cells.groupBy("i", "j").agg(F.expr("CAST(sum(w) AS BIGINT) AS n")))
    return cells.join(regions, ["i", "j"]).select("id", cell_class(F.col("n3"), F.col("n7"), m).alias("label"))


def smallest_cells(points: DataFrame, distance_d: float | Column, k: int) -> DataFrame:
    """The K occupied cells with fewest points, ties by (i, j): a top-k (TakeOrderedAndProject)."""
    return cell_counts(points, distance_d).orderBy("n", "i", "j").limit(int(k))


# --------------------------------------------------------------------------------------------
# exact method
# --------------------------------------------------------------------------------------------


def exact_cell_side(distance_d: float) -> float:
    return EXACT_GRID_SLACK * f32(distance_d) / SQRT8


def _private_grid(points: DataFrame, distance_d: float) -> DataFrame:
    side = _double(exact_cell_side(distance_d))
    return with_weight(points).selectExpr(
        "id", "x", "y", "w",
        f"CAST(floor(CAST(x AS DOUBLE) / {side}) AS BIGINT) AS ci",
        f"CAST(floor(CAST(y AS DOUBLE) / {side}) AS BIGINT) AS cj",
    )


PROBE_KEY = ["id", "x", "y", "w", "n3"]
BLOCK = 4  # cells on a side of a block; a 7x7 neighbourhood lies in 4 to 9 of them, 6.25 on average


def _ring_counts(grid: DataFrame, probe_cells: DataFrame, distance_d: float) -> DataFrame:
    """``(id, x, y, w, n3, ring)`` for every point of ``probe_cells (ci, cj, n3)``; ring is the weight
    of the points of the 40 ring cells within distance D.

    One join by blocks of BLOCK x BLOCK cells: a probe goes to the blocks that its 7x7 neighbourhood
    meets, a build point to its own block only, and the ring and the distance are conditions of the
    join. Blocks without probes drop their build points in the join. Both sides are plain shuffles,
    so Spark splits a block that is hot on either side, and broadcasts the probes when they are few.
    """
    near = f"{sql_distance('x', 'y', 'qx', 'qy')} <= {_float(distance_d)}"
    probes = grid.join(probe_cells, ["ci", "cj"]).selectExpr(*PROBE_KEY, "ci", "cj")
    low, high = f"CAST(floor(({{c}} - 3) / {BLOCK}) AS BIGINT)", f"CAST(floor(({{c}} + 3) / {BLOCK}) AS BIGINT)"
    sent = probes.selectExpr("*", f"explode(sequence({low.format(c='ci')}, {high.format(c='ci')})) AS bi").selectExpr(
        "*", f"explode(sequence({low.format(c='cj')}, {high.format(c='cj')})) AS bj"
    )
    build = grid.selectExpr(
        f"CAST(floor(ci / {BLOCK}) AS BIGINT) AS bi", f"CAST(floor(cj / {BLOCK}) AS BIGINT) AS bj",
        "ci AS ti", "cj AS tj", "x AS qx", "y AS qy", "w AS qw",
    )
    ring = "greatest(abs(ci - ti), abs(cj - tj)) BETWEEN 2 AND 3"
    matched = sent.join(build, ["bi", "bj"]).filter(f"{ring} AND {near}").selectExpr(*PROBE_KEY, "qw AS ring")
    zero = probes.selectExpr(*PROBE_KEY, "CAST(0 AS BIGINT) AS ring")
    return matched.unionByName(zero).groupBy(*PROBE_KEY).agg(F.expr("CAST(sum(ring) AS BIGINT) AS ring"))


def _grid_regions(points: DataFrame, distance_d: float) -> tuple[DataFrame, DataFrame]:
    """The points on the private grid, and ``(ci, cj, n, n3)`` of its occupied cells."""
    grid = _private_grid(points, require_positive_finite("D", distance_d))
    cells = grid.groupBy("ci", "cj").agg(F.expr("CAST(sum(w) AS BIGINT) AS n"))
    return grid, cell_regions(cells, "ci", "cj", "n", reach=1)


def ball_counts(points: DataFrame, distance_d: float) -> DataFrame:
    """``(id, x, y, ball)``: |B(p, D)| for every point, the point and its duplicates included.

    Rows are distinct points (``w`` carries multiplicity). Every cell probes its ring.
    """
    grid, regions = _grid_regions(points, distance_d)
    return _ring_counts(grid, regions.select("ci", "cj", "n3"), distance_d).selectExpr("id", "x", "y", "CAST(n3 + ring AS BIGINT) AS ball")


def exact_outliers(points: DataFrame, distance_d: float, m: int, keep_weight: bool = False) -> DataFrame:
    """``(id, x, y, ball)`` for the points with |B(p, D)| <= M.

    Only points in private cells with N3' <= M probe the ring (a cell with N3' > M holds no
    outlier); such a cell holds at most M points, so the probe side never concentrates.
    """
    grid, regions = _grid_regions(points, distance_d)
    probe_cells = regions.filter(f"n3 <= {int(m)}").select("ci", "cj", "n3")
    out = _ring_counts(grid, probe_cells, distance_d).selectExpr("id", "x", "y", "w", "CAST(n3 + ring AS BIGINT) AS ball")
    out = out.filter(f"ball <= {int(m)}")
    return out if keep_weight else out.drop("w")


def exact_outlier_count(points: DataFrame, distance_d: float, m: int) -> DataFrame:
    """One row ``(n_outliers)``; weighted points count with their multiplicity."""
    return exact_outliers(points, distance_d, m, keep_weight=True).agg(
        F.expr("CAST(coalesce(sum(w), 0) AS BIGINT) AS n_outliers")
    )


def exact_outliers_topk(points: DataFrame, distance_d: float, m: int, k: int) -> DataFrame:
    """The first K outliers by ball count, ties by id (the reference's stable sort on list order)."""
    return exact_outliers(points, distance_d, m).orderBy("ball", "id").limit(int(k))
