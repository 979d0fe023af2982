"""Ball counts on an adaptive grid, for point sets with dense places.

``ball_counts_adaptive`` gives the rows of ``outliers.ball_counts``. That one compares every pair of
points in a ring of cells, which grows with the square of the density. Here cells that hold more
than ``leaf`` points are cut in four, again and again, and pairs of cells are told apart before any
pair of points: a pair that lies wholly inside the distance counts in bulk, one that lies wholly
outside counts nothing, and of the others the larger cells are cut further. Only points of pairs of
uncut cells that the circle passes through are compared. Of N points in one dense place these are in
the order of N^1.5 pairs of points and (N / leaf)^1.5 pairs of cells, in place of N^2.

Every level is a few joins and aggregates over tables in the shared folder; cells nest exactly, as a
level's quotients are the first level's times a power of two.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.floats import require_positive_finite
from tessera.functions.geometry import SQRT8, sql_distance
from tessera.operators.outliers import EXACT_GRID_SLACK, _double, _float, exact_cell_side, with_weight
from tessera.scratch import Scratch

LEAF = 32  # points of a cell that isn't cut
MAX_DEPTH = 16  # cells of 1 / 2^16 of the first side aren't cut either
REACH = SQRT8 / EXACT_GRID_SLACK  # the distance, in sides of a first cell
MARGIN = 1e-4  # pairs of cells this near to the distance are compared point by point


def _kind(pairs: DataFrame) -> DataFrame:
    """``pairs`` that aren't apart, with ``inside``: every point of one cell is in all balls of the other's."""
    low = lambda a, c: f"{a}{c} / CAST(shiftleft(CAST(1 AS BIGINT), {a}l) AS DOUBLE)"
    high = lambda a, c: f"({a}{c} + 1) / CAST(shiftleft(CAST(1 AS BIGINT), {a}l) AS DOUBLE)"
    most = lambda c: f"pow(greatest({high('p', c)}, {high('q', c)}) - least({low('p', c)}, {low('q', c)}), 2)"
    least = lambda c: f"pow(greatest(0D, {low('q', c)} - {high('p', c)}, {low('p', c)} - {high('q', c)}), 2)"
    near, far = (REACH * (1 - MARGIN)) ** 2, (REACH * (1 + MARGIN)) ** 2
    return pairs.filter(f"{least('i')} + {least('j')} <= {_double(far)}").selectExpr(
        "*", f"{most('i')} + {most('j')} <= {_double(near)} AS inside"
    )


def _first_pairs(cells: DataFrame) -> DataFrame:
    """Every first cell with the cells of the 7x7 block around it."""
    sent = cells.selectExpr(*[f"{c} AS p{c}" for c in cells.columns], "explode(sequence(-3, 3)) AS di").selectExpr(
        "*", "explode(sequence(-3, 3)) AS dj"
    )
    sent = sent.withColumn("qi", F.expr("pi + di")).withColumn("qj", F.expr("pj + dj")).drop("di", "dj")
    return sent.join(cells.selectExpr(*[f"{c} AS q{c}" for c in cells.columns]), ["qi", "qj"])


def _children(pairs: DataFrame, cells: DataFrame, side: str) -> DataFrame:
    """``pairs`` with the cut cells of one side replaced by the ``cells`` in them."""
    keys = [f"{side}i", f"{side}j"]
    inner = cells.selectExpr(f"shiftright(i, 1) AS {side}i", f"shiftright(j, 1) AS {side}j", *[f"{c} AS _{c}" for c in cells.columns])
    cut = pairs.filter(f"{side}cut").drop(*[f"{side}{c}" for c in ("l", "n", "cut")]).join(inner, keys).drop(*keys)
    return pairs.filter(f"NOT {side}cut").unionByName(cut.withColumnsRenamed({f"_{c}": f"{side}{c}" for c in cells.columns}))


def cell_pairs(points: DataFrame, distance_d: float, leaf: int = LEAF) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame, int]:
    """The points ``(id, x, y, w, u, v)``; points of uncut cells ``(id, x, y, w, l, i, j)``; weights that
    count for all points of a cell ``(pl, pi, pj, n)``; pairs of uncut cells to compare; the last level."""
    s = Scratch(points.sparkSession, "balls")
    side = _double(exact_cell_side(require_positive_finite("D", distance_d)))
    every = s.keep(
        with_weight(points).selectExpr("id", "x", "y", "w", f"CAST(x AS DOUBLE) / {side} AS u", f"CAST(y AS DOUBLE) / {side} AS v")
    )
    rest, pairs, level, leaves, bulk, near = every, None, 0, [], [], []
    while True:
        scale = f"{2**level}D"
        placed = rest.selectExpr("*", f"CAST(floor(u * {scale}) AS BIGINT) AS i", f"CAST(floor(v * {scale}) AS BIGINT) AS j")
        cells = s.keep(
            placed.groupBy("i", "j").agg(F.expr("CAST(sum(w) AS BIGINT) AS n"), F.expr("count(1) AS rows"))
            .selectExpr(f"{level} AS l", "i", "j", "n", f"rows > {int(leaf)} AND {level} < {MAX_DEPTH} AS cut")
        )
        placed = s.keep(placed.join(cells.select("i", "j", "l", "cut"), ["i", "j"]))
        leaves.append(placed.filter("NOT cut").select("id", "x", "y", "w", "l", "i", "j"))
        rest = placed.filter("cut").select(*every.columns)
        found = _first_pairs(cells) if pairs is None else _children(_children(pairs, cells, "p"), cells, "q")
        found = s.keep(_kind(found))
        bulk.append(found.filter("inside").groupBy("pl", "pi", "pj").agg(F.expr("CAST(sum(qn) AS BIGINT) AS n")))
        near.append(found.filter("NOT inside AND NOT pcut AND NOT qcut"))
        pairs = found.filter("NOT inside AND (pcut OR qcut)").drop("inside")
        if pairs.isEmpty():
            one = lambda tables: reduce(DataFrame.unionByName, tables)
            return every, one(leaves), one(bulk), one(near).select("pl", "pi", "pj", "ql", "qi", "qj"), level
        level += 1


def ball_counts_adaptive(points: DataFrame, distance_d: float, leaf: int = LEAF) -> DataFrame:
    """``(id, x, y, ball)``: |B(p, D)| for every point, the point and its duplicates included.

    Rows are distinct points (``w`` carries multiplicity). Jobs run while the plan is built, a few per level.
    """
    every, leaves, bulk, near, last = cell_pairs(points, distance_d, leaf)
    scale = "CAST(shiftleft(CAST(1 AS BIGINT), pl) AS DOUBLE)"
    placed = every.selectExpr("id", "x", "y", "u", "v", f"explode(sequence(0, {last})) AS pl").selectExpr(
        "id", "x", "y", "pl", f"CAST(floor(u * {scale}) AS BIGINT) AS pi", f"CAST(floor(v * {scale}) AS BIGINT) AS pj"
    )
    whole = placed.join(bulk, ["pl", "pi", "pj"]).select("id", "x", "y", "n")
    probes = leaves.selectExpr("id", "x", "y", "l AS pl", "i AS pi", "j AS pj")
    others = leaves.selectExpr("x AS qx", "y AS qy", "w AS n", "l AS ql", "i AS qi", "j AS qj")
    close = f"{sql_distance('x', 'y', 'qx', 'qy')} <= {_float(distance_d)}"
    single = probes.join(near, ["pl", "pi", "pj"]).join(others, ["ql", "qi", "qj"]).filter(close).select("id", "x", "y", "n")
    # a cell lies inside its own balls, so every point has a row
    return whole.unionByName(single).groupBy("id", "x", "y").agg(F.expr("CAST(sum(n) AS BIGINT) AS ball"))
