"""Intermediate tables in the shared folder that ``spark.checkpoint.dir`` names.

A ``Scratch`` is a catalog database located in that folder: ``keep`` writes a DataFrame as a managed
table there and reads it back, which cuts the lineage (a lost executor re-reads files instead of
recomputing), fixes what was random or order-dependent, and gives later plans exact sizes.
``drop`` removes a table that no later step reads.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tessera.session import checkpoint_root


class Scratch:
    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.db = f"tessera_{name}_{uuid.uuid4().hex}"
        place = f"{checkpoint_root(spark)}/tessera/{self.db}".replace("'", "\\'")
        spark.sql(f"CREATE DATABASE {self.db} LOCATION '{place}'")
        self._tables: dict[int, tuple[DataFrame, str]] = {}

    def keep(self, df: DataFrame) -> DataFrame:
        """Write ``df`` and return what was written."""
        name = f"{self.db}.t{uuid.uuid4().hex}"
        df.write.format("parquet").saveAsTable(name)
        out = self.spark.table(name)
        self._tables[id(out)] = (out, name)
        return out

    def drop(self, *tables: DataFrame | None) -> None:
        """Delete tables that ``keep`` returned; nothing may read them any more."""
        for t in tables:
            if t is not None and id(t) in self._tables:
                self.spark.sql(f"DROP TABLE IF EXISTS {self._tables.pop(id(t))[1]}")
