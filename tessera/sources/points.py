"""Point sources: text lines ``x,y`` and adapters from the driver tables.

A point set is a DataFrame ``(id bigint, x float, y float)``, optionally with ``w bigint``, the
multiplicity of the point (default 1). Rows are distinct points: a point repeated many times is one
row with its multiplicity in ``w`` (``fold_duplicates`` does that with a partial aggregation, so a
hot repeated point never lands whole in one task). Non-finite coordinates are rejected on ingestion.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.floats import f32_col


def _reject_non_finite(df: DataFrame) -> DataFrame:
    bad = F.isnan("x") | F.isnan("y") | (F.abs("x") == float("inf")) | (F.abs("y") == float("inf"))
    return df.withColumn(
        "x", F.when(bad, F.raise_error(F.lit("non-finite point coordinate"))).otherwise(F.col("x")).cast("float")
    )


def _number(text: Column) -> Column:
    value = F.trim(text).try_cast("float")
    bad = F.raise_error(F.concat(F.lit("not a number: "), F.coalesce(text, F.lit("null"))))
    return F.when(value.isNull(), bad.cast("float")).otherwise(value)


def parse_points(lines: DataFrame, line_col: str = "value", id_col: str | None = None) -> DataFrame:
    """Parse ``x,y[,...]`` lines to points; fields after the second are ignored.

    A line with fewer than two fields or a field that is not a number fails the job, whatever
    ``spark.sql.ansi.enabled`` says. Without an id column, ``monotonically_increasing_id`` numbers the lines
    (stable for a given input split).
    """
    fields = F.split(F.col(line_col), ",", -1)
    ident = F.col(id_col).cast("bigint") if id_col else F.monotonically_increasing_id()
    checked = F.when(F.size(fields) < 2, F.raise_error(F.lit("point line needs two fields"))).otherwise(fields)
    pts = lines.select(
        ident.alias("id"),
        _number(F.get(checked, F.lit(0))).alias("x"),
        _number(F.get(checked, F.lit(1))).alias("y"),
    )
    return _reject_non_finite(pts)


def read_points(spark: SparkSession, path: str) -> DataFrame:
    """Points from a text file (or folder) of ``x,y`` lines."""
    return parse_points(spark.read.text(path))


def points_from_embeddings(embeddings: DataFrame) -> DataFrame:
    """PTS: the first two embedding components of each vector."""
    return _reject_non_finite(
        embeddings.select(
            F.col("vec_id").alias("id"),
            F.col("embedding").getItem(0).cast("float").alias("x"),
            F.col("embedding").getItem(1).cast("float").alias("y"),
        )
    )


def points_from_orders(orders: DataFrame) -> DataFrame:
    """ORD: total price in thousands against days since 1992-01-01."""
    return _reject_non_finite(
        orders.select(
            F.col("o_orderkey").alias("id"),
            f32_col(F.col("o_totalprice") / F.lit(1000.0)).alias("x"),
            f32_col(F.datediff(F.col("o_orderdate").cast("date"), F.lit("1992-01-01").cast("date"))).alias("y"),
        )
    )


def points_from_lineitem(lineitem: DataFrame) -> DataFrame:
    """LI: extended price in thousands against quantity, one weighted row per distinct point.

    lineitem has no unique key, and equal points have equal ball counts, so the rows are folded to
    ``(x, y, w)`` with a partial aggregation before any shuffle (a repeated point cannot pile up in
    one task). ``id`` is only a label here (a hash of the point); results are keyed by (x, y).
    """
    pts = lineitem.select(
        f32_col(F.col("l_extendedprice") / F.lit(1000.0)).alias("x"),
        f32_col(F.col("l_quantity")).alias("y"),
    )
    folded = pts.groupBy("x", "y").agg(F.count(F.lit(1)).alias("w"))
    return _reject_non_finite(folded.select(F.xxhash64("x", "y").alias("id"), "x", "y", "w"))


def fold_duplicates(points: DataFrame) -> DataFrame:
    """One row per distinct (x, y): ``w`` sums the multiplicities, ``id`` is the smallest id."""
    w = F.col("w").cast("bigint") if "w" in points.columns else F.lit(1).cast("bigint")
    return points.groupBy("x", "y").agg(F.min("id").alias("id"), F.sum(w).cast("bigint").alias("w")).select(
        "id", "x", "y", "w"
    )
