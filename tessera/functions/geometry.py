"""Planar geometry expressions on float32 coordinates.

Distances follow one fixed recipe: the coordinate differences are float32 subtractions, their
squares and sum are double (exact for float inputs up to the final rounding), and the square root
is rounded to float32. Grid cells use float32 division ``x / side`` (Spark divides in double; the
result rounded to float equals the float32 quotient) followed by ``floor``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions.floats import f32

SQRT8 = 2.0 * math.sqrt(2.0)


def cell_side(distance: float) -> float:
    """Side of the approximate grid: float32 of ``D / (2*sqrt(2))`` with D a float32."""
    return f32(f32(distance) / SQRT8)


def cell_side_col(distance: Column) -> Column:
    """``cell_side`` for a distance given as a column (e.g. a scalar subquery)."""
    return (distance.cast("float").cast("double") / F.lit(SQRT8)).cast("float")


def distance(x1: Column | str, y1: Column | str, x2: Column | str, y2: Column | str) -> Column:
    """Euclidean distance of two float32 points, rounded to float32.

    Given column names (or SQL expressions) it is built as one SQL expression (one driver round
    trip); given Column objects it is composed from them.
    """
    if all(isinstance(c, str) for c in (x1, y1, x2, y2)):
        return F.expr(sql_distance(x1, y1, x2, y2))
    dx = (x1.cast("float") - x2.cast("float")).cast("double")
    dy = (y1.cast("float") - y2.cast("float")).cast("double")
    return F.sqrt(dx * dx + dy * dy).cast("float")


def sql_distance(x1: str, y1: str, x2: str, y2: str) -> str:
    """The same distance in SQL text."""
    return (
        f"CAST(sqrt(CAST(({x1}) - ({x2}) AS DOUBLE) * CAST(({x1}) - ({x2}) AS DOUBLE)"
        f" + CAST(({y1}) - ({y2}) AS DOUBLE) * CAST(({y1}) - ({y2}) AS DOUBLE)) AS FLOAT)"
    )
