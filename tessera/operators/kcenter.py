"""k-center clustering by farthest-first traversal (Gonzalez) and its MapReduce coreset form.

* ``traverse``: the traversal inside each part of a point set, one Spark job per round for all parts
  together. Every point carries ``d``, its distance to the nearest center of its part, updated with
  the part's last center; the next center is the part's arg-max of ``d`` (first in list order on
  ties), a partially aggregated ``max_by`` per part. No point is shuffled and no part is ever
  gathered, so a part may be of any size; the driver sees a row per part and round (L * K in all).
  ``d`` is persisted per round and written out every few rounds, so the lineage stays short.
* ``farthest_first``: one part, in id order. ``coreset``: L parts, by an md5 hash of the id (balanced
  whatever the id pattern; ``assign="mod"`` gives pmod(id, L)). ``mr_centers``: the traversal of the
  coreset, as one part in (part, pick) order.
* ``nearest_center_distance`` / ``radius``: each point's distance to the nearest center, a map with
  the K centers as one array (a scalar subquery), and a global max.
"""

from __future__ import annotations

import numpy as np
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.geometry import distance
from tessera.scratch import Scratch

FLOAT_MAX = float(np.finfo(np.float32).max)
CHECKPOINT_EVERY = 8  # rounds between written copies of the distance column
DEFAULT_PARTS = 8
MAX_PARTS = 1 << 16  # a row per part is broadcast each round

CENTER_SCHEMA = T.StructType(
    [
        T.StructField("pick", T.IntegerType()),
        T.StructField("id", T.LongType()),
        T.StructField("x", T.FloatType()),
        T.StructField("y", T.FloatType()),
    ]
)
CORESET_SCHEMA = T.StructType([T.StructField("part", T.LongType())] + list(CENTER_SCHEMA.fields))


def _require(name: str, value: int, most: int | None = None) -> int:
    if int(value) < 1 or most is not None and int(value) > most:
        raise ValueError(f"{name} must be at least 1" + (f" and at most {most}" if most else ""))
    return int(value)


def part_of(ids: Column, parts: int, assign: str = "hash") -> Column:
    """The part of each point: ``hash`` (default) spreads any id pattern evenly --
    pmod(first 32 bits of md5(id), L), reproducible in SQL -- while ``mod`` is pmod(id, L)."""
    if assign == "mod":
        key = ids
    elif assign == "hash":
        key = F.conv(F.substring(F.md5(ids.cast("string")), 1, 8), 16, 10).cast("bigint")
    else:
        raise ValueError("assign must be 'hash' or 'mod'")
    return F.pmod(key, F.lit(int(parts))).cast("bigint")


def traverse(points: DataFrame, k: int, order: list[str]) -> DataFrame:
    """``(part, pick, id, x, y)``: up to K centers of each part of ``points`` (part, id, x, y, ...).

    The first center of a part is its first row by ``order`` (integer columns). A part whose points
    all lie on its centers gets no further ones.
    """
    k = _require("K", k)
    spark = points.sparkSession
    scratch = Scratch(spark, "kcenter") if k > CHECKPOINT_EVERY else None
    base = points.select("part", *{c: 0 for c in ("id", "x", "y", *order) if c != "part"})
    point = F.struct("id", "x", "y")
    picks = [
        (r.part, 0, r.c.id, r.c.x, r.c.y)
        for r in base.groupBy("part").agg(F.min_by(point, F.struct(*order)).alias("c")).collect()
    ]
    last, cur = picks, base.withColumn("d", F.lit(FLOAT_MAX).cast("float"))
    held, written = None, None
    farthest = F.struct(F.col("d"), *[-F.col(c) for c in order])
    for rnd in range(1, k):
        if not last:
            break
        latest = F.broadcast(  # at most a row per part
            spark.createDataFrame([(p, x, y) for p, _, _, x, y in last], "part bigint, cx float, cy float")
        )
        cur = cur.join(latest, "part").withColumn("d", F.least("d", distance("x", "y", "cx", "cy"))).drop("cx", "cy")
        if rnd % CHECKPOINT_EVERY == 0 and scratch is not None:
            cur = scratch.keep(cur)
            scratch.drop(written)
            written = cur
        cur = cur.persist(StorageLevel.MEMORY_AND_DISK)
        far = cur.filter("d > 0").groupBy("part").agg(F.max_by(point, farthest).alias("c")).collect()
        if held is not None:
            held.unpersist()
        held = cur
        last = [(r.part, rnd, r.c.id, r.c.x, r.c.y) for r in far]
        picks += last
    if held is not None:
        held.unpersist()
    if scratch is not None:
        scratch.drop(written)
    return spark.createDataFrame(picks, CORESET_SCHEMA)


def coreset(points: DataFrame, k: int, parts: int | None = None, assign: str = "hash") -> DataFrame:
    """``(part, pick, id, x, y)``: K farthest-first centers of every part."""
    parts = _require("L", DEFAULT_PARTS if parts is None else parts, MAX_PARTS)
    return traverse(points.withColumn("part", part_of(F.col("id"), parts, assign)), k, ["id"])


def centers_from_coreset(core: DataFrame, k: int) -> DataFrame:
    """``(pick, id, x, y)``: farthest-first on the coreset in (part, pick) order (L*K rows)."""
    rows = core.select(F.lit(0).cast("bigint").alias("part"), "id", "x", "y", F.col("part").alias("o1"), F.col("pick").alias("o2"))
    return traverse(rows, k, ["o1", "o2"]).drop("part")


def mr_centers(points: DataFrame, k: int, parts: int | None = None, assign: str = "hash") -> DataFrame:
    """The MapReduce k-center: coreset per part, then farthest-first on the coreset."""
    return centers_from_coreset(coreset(points, k, parts, assign), k)


def farthest_first(points: DataFrame, k: int) -> DataFrame:
    """``(pick, id, x, y)``: sequential farthest-first traversal over all points, in id order."""
    return traverse(points.withColumn("part", F.lit(0).cast("bigint")), k, ["id"]).drop("part")


def nearest_center_distance(points: DataFrame, centers: DataFrame) -> DataFrame:
    """``(id, d)``: distance of each point to its nearest center; null without centers."""
    one = centers.agg(F.collect_list(F.struct("x", "y")).alias("centers")).select("centers").scalar()  # K centers
    nearest = F.array_min(
        F.transform("centers", lambda c: distance(F.col("x"), F.col("y"), c["x"], c["y"]))
    )
    return points.select("id", "x", "y", one.alias("centers")).select("id", nearest.alias("d"))


def radius(points: DataFrame, centers: DataFrame) -> DataFrame:
    """One row ``(radius)``: the largest nearest-center distance (map, then one global max)."""
    return nearest_center_distance(points, centers).agg(F.max("d").alias("radius"))
