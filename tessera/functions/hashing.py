"""Seeded uniforms that are pure functions of (tag, seed, position).

The reference draws ``Math.random()``; a pure function of the stream position makes reruns, task
retries, micro-batch splits and the SQL oracle agree. The value is the first 32 bits of
``md5(tag:seed:pos)`` divided by 2**32, so it lies in [0, 1).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_32 = 4294967296.0


def uniform(pos: Column | str, tag: str, seed: int) -> Column:
    """The uniform of each position; ``pos`` a column name (one SQL expression) or a Column."""
    if isinstance(pos, str):
        return F.expr(
            f"CAST(CAST(conv(substring(md5(concat('{tag}:{seed}:', CAST({pos} AS STRING))), 1, 8), 16, 10) AS BIGINT)"
            f" AS DOUBLE) / CAST({int(TWO_32)} AS DOUBLE)"
        )
    key = F.concat(F.lit(f"{tag}:{seed}:"), pos.cast("string"))
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("bigint").cast("double") / F.lit(TWO_32)
