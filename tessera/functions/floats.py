"""float32 fidelity.

Parameters and thresholds of the operators are float32 values computed once on the driver with
numpy, then used as ``float`` literals so Spark compares float against float (a bare Python float
is a double literal and would make Spark widen the comparison).
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F


def f32(value: float) -> float:
    """Round a Python number to the nearest float32 and return it as a Python float (exact)."""
    return float(np.float32(value))


def f32_col(col: Column) -> Column:
    return col.cast("float")


def require_positive_finite(name: str, value: float) -> float:
    value = f32(value)
    if not math.isfinite(value) or value <= 0.0:
        raise ValueError(f"{name} must be a positive finite number, got {value}")
    return value
