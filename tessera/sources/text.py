"""Text sources: documents as lines (a line is one document of the word-count operators)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.text import split_lines


def doc_lines(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, line_no, line)``: every text split into lines with the line-reader rules."""
    return documents.select(
        F.col(id_col).alias("doc_id"),
        F.posexplode(split_lines(F.col(text_col))).alias("line_no", "line"),
    )


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of text files as ``(doc_id, line_no, line)``; ``doc_id`` numbers the lines, line_no is 0."""
    return spark.read.text(path).select(
        F.monotonically_increasing_id().alias("doc_id"),
        F.lit(0).alias("line_no"),
        F.col("value").alias("line"),
    )
