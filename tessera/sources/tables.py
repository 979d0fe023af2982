"""Parquet tables of a data folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def table(spark: SparkSession, data_dir: str, name: str) -> DataFrame:
    """Read one table; column pruning and filters reach the parquet scan through Catalyst."""
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(f"{data_dir.rstrip('/')}/{name}.parquet")


def balanced(df: DataFrame) -> DataFrame:
    """Spread rows over the session's cores when the scan yields fewer partitions than cores.

    A small input (here a single parquet row group) is read by one task, and every map-side step
    after it -- tokenising, the grid fan-out, hashing -- would run on one core. Large inputs have
    at least as many splits as cores and pass through unchanged, so this adds no shuffle at scale;
    the rows are the same either way.
    """
    target = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(target) if df.rdd.getNumPartitions() < target else df
