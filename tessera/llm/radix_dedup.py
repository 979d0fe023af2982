"""Exact dedup by distributed MSD radix partitioning.

Documents are split by successive digits of their bytes, most significant first: all documents start
in one group, and a round splits every group by the next digit. A group is finished when it has one
document (nothing equals it) or when its documents have ended (they are equal); only the others go
on. Groups are told apart by the bytes themselves, so equality needs no digest.

A digit is a run of bytes, 64 in the first round and 16 times as many in each later one: a text of n
bytes is decided after about log16(n) rounds, and most documents after the first. A round counts
each (group, digit) by a partial aggregate -- a group with a third of all documents sends one row
per task --, writes the counts, and joins them back; both sides of that join are plain shuffles, so
Spark splits a skewed digit. Bytes are moved once for the first digit and again only for documents
that still share a digit with another.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.scratch import Scratch, text_column

FIRST_DIGIT, GROWTH = 64, 16  # bytes
WHITE = r"[\x20\x09-\x0D]+"


def normalised(text: Column) -> Column:
    return F.regexp_replace(text, WHITE, " ")


def dedup(spark, documents: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """``(doc_id, keep_id, group_size, kept, text_sha256, *carry)``, one row per document.

    Texts are equal when identical after each run of white space becomes one space. keep_id is the
    smallest doc_id of the group (null only if all are null). Exactly one row of a group has
    ``kept``: a row with keep_id; of several rows with that same id, one of them. A null text is an
    empty one; empty texts equal each other; an empty table gives an empty result.
    """
    s = Scratch(spark, "radix")
    text = F.encode(normalised(text_column(documents)), "utf-8")
    rest = documents.select("doc_id", *carry, text.alias("rest")).select(
        "doc_id", *carry, F.sha2("rest", 256).alias("text_sha256"), F.lit(0).cast("bigint").alias("grp"), "rest"
    )
    width, done, old = FIRST_DIGIT, [], None
    while True:
        keyed = rest.select(
            "*", F.substring("rest", 1, width).alias("digit"), (F.octet_length("rest") <= width).alias("ended")
        )
        key = ["grp", "digit", "ended"]
        counts = s.keep(
            keyed.groupBy(*key)
            .agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("keep_id"))
            .withColumn("new_grp", F.monotonically_increasing_id())
        )
        split = s.keep(
            keyed.join(counts, key).select(
                "doc_id", *carry, "text_sha256", F.col("new_grp").alias("grp"), "keep_id", F.col("n").alias("group_size"),
                F.when(~F.col("ended") & (F.col("n") > 1), F.expr(f"substring(rest, {width + 1})")).alias("rest"),
            )
        )
        s.drop(counts, old)
        done.append(split.filter(F.col("rest").isNull()).drop("rest"))
        rest = split.filter(F.col("rest").isNotNull()).drop("keep_id", "group_size")
        if rest.isEmpty():
            break
        width *= GROWTH
    out = done[0].withColumn("_round", F.lit(0))
    for i, d in enumerate(done[1:], 1):
        out = out.unionByName(d.withColumn("_round", F.lit(i)))
    # rows that repeat one doc_id within a group: the first of them stays
    again = Window.partitionBy("doc_id", "_round", "grp").orderBy("text_sha256", *carry)
    first = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.row_number().over(again) == 1)
    return out.select("doc_id", "keep_id", "group_size", first.alias("kept"), "text_sha256", *carry)


def distinct_rows(spark, documents: DataFrame) -> DataFrame:
    """The rows of ``documents`` that stay: for each normalised text the one of the smallest doc_id."""
    kept = dedup(spark, documents).filter("kept").select(F.col("doc_id").alias("_id"), F.col("text_sha256").alias("_sha"))
    docs = documents.withColumn("_own", F.sha2(F.encode(normalised(text_column(documents)), "utf-8"), 256))
    both = docs.join(kept, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_own") == F.col("_sha")))
    others = [c for c in documents.columns if c != "doc_id"]  # rows that repeat an id: the least by their columns
    first = F.row_number().over(Window.partitionBy("doc_id", "_own").orderBy(*others))
    return both.withColumn("_first", first).filter("_first = 1").select(*documents.columns)
