"""Coresets for k-center in one pass over the points.

``one_pass_coreset`` is the form of ``kcenter.coreset`` for large K: that one updates a distance column
K times, this one reads the points once. A part is dealt over blocks by the same hash of the id, a block
is sorted by (id, x, y) and goes through a task as a stream: every ``CHUNK`` points leave their K
farthest-first centers, and what has been left is traversed again when a chunk of centers has gathered
and at the end of the block. The centers of a part's blocks, at most ``blocks`` * K, are traversed once more.
A task holds two chunks at most, whatever the size of a block or the number of rows with one id.

Each traversal leaves every point within twice the best radius for K centers of its part. Distances add
up: 2 times the best with one block of one chunk (then the rows are those of ``coreset``), 4 with several
blocks of a chunk each, 6 with blocks of at most ``CHUNK``**2 / K points, and 2 more for each power of
``CHUNK`` / K beyond.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.kcenter import CORESET_SCHEMA, DEFAULT_PARTS, FLOAT_MAX, MAX_PARTS, _require, centers_from_coreset, part_of

# workers need no installed package: what goes to them goes by value
cloudpickle.register_pickle_by_value(sys.modules[__name__])

CHUNK = 1 << 16  # points traversed at a time
DEFAULT_BLOCKS = 16


def farthest(rows: pd.DataFrame, k: int) -> pd.DataFrame:
    """The rows of up to k farthest-first centers, in the order picked; distances in single precision."""
    xs, ys = rows["x"].to_numpy(np.float32), rows["y"].to_numpy(np.float32)
    near, picks = np.full(len(rows), FLOAT_MAX, np.float32), [0] if len(rows) else []
    while 0 < len(picks) < k:
        dx, dy = (xs - xs[picks[-1]]).astype(float), (ys - ys[picks[-1]]).astype(float)
        near = np.minimum(near, np.sqrt(dx * dx + dy * dy).astype(np.float32))
        at = int(near.argmax())
        if not near[at] > 0:
            break
        picks.append(at)
    return rows.iloc[picks]


class _Block:
    """The points of one block so far: those not traversed yet, and the centers of the others."""

    def __init__(self, k: int, chunk: int):
        self.k, self.chunk, self.points, self.centers = k, chunk, [], []

    def add(self, rows: pd.DataFrame) -> None:
        self.points.append(rows)
        if sum(map(len, self.points)) < self.chunk:
            return
        rows = pd.concat(self.points)
        while len(rows) >= self.chunk:
            self.centers.append(farthest(rows[: self.chunk], self.k))
            rows = rows[self.chunk :]
            if sum(map(len, self.centers)) >= max(self.chunk, 2 * self.k):
                self.centers = [farthest(pd.concat(self.centers), self.k)]
        self.points = [rows]

    def end(self) -> pd.DataFrame:
        rest = pd.concat(self.points)
        found = self.centers + ([farthest(rest, self.k)] if len(rest) else [])
        out = found[0] if len(found) == 1 else farthest(pd.concat(found), self.k)
        return out.assign(pick=np.arange(len(out), dtype=np.int32))


def one_pass_coreset(
    points: DataFrame, k: int, parts: int | None = None, blocks: int = DEFAULT_BLOCKS, assign: str = "hash", chunk: int = CHUNK
) -> DataFrame:
    """``(part, pick, id, x, y)``: up to K centers of every part, from one pass over the points.

    Parts are those of ``kcenter.coreset``. Points without id are one block; equal points are one center;
    a part without points has no rows.
    """
    k, blocks, chunk = _require("K", k), _require("blocks", blocks), _require("chunk", chunk)
    parts = _require("L", DEFAULT_PARTS if parts is None else parts, MAX_PARTS)
    block = F.coalesce(part_of(F.col("id"), parts * blocks, assign), F.lit(0).cast("bigint"))

    def through(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, state = None, None
        for pdf in batches:
            pdf["id"] = pdf["id"].astype("Int64")
            for b, rows in pdf.groupby("block", sort=False):
                if b != now:
                    if state is not None:
                        yield state.end()
                    now, state = b, _Block(k, chunk)
                state.add(rows)
        if state is not None:
            yield state.end()

    def merged(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["block", "pick"]).assign(id=lambda r: r["id"].astype("Int64"))
        out = farthest(rows, k) if rows["block"].nunique() > 1 else rows
        return out.assign(pick=np.arange(len(out), dtype=np.int32))[["part", "pick", "id", "x", "y"]]

    dealt = points.select(block.alias("block"), "id", "x", "y").repartition(parts * blocks, "block").sortWithinPartitions("block", "id", "x", "y")
    of_blocks = dealt.mapInPandas(through, "block bigint, id bigint, x float, y float, pick int")
    return of_blocks.withColumn("part", F.col("block") % parts).groupBy("part").applyInPandas(merged, CORESET_SCHEMA)


def one_pass_centers(points: DataFrame, k: int, parts: int | None = None, blocks: int = DEFAULT_BLOCKS, assign: str = "hash") -> DataFrame:
    """``(pick, id, x, y)``: farthest-first on the one-pass coreset, in (part, pick) order."""
    return centers_from_coreset(one_pass_coreset(points, k, parts, blocks, assign), k)
