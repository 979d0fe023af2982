"""Word counts over documents (a document is one text line) by four aggregation strategies.

All four give the same ``(word, n)``; they differ in plan shape:

* ``word_counts``: explode tokens, one ``groupBy(word)`` -- partial HashAggregate per task
  (the per-document / per-partition pre-aggregation the reference writes by hand), one exchange.
* ``word_counts_salted``: two rounds with a salt drawn per (document, word) pair, so the first
  exchange spreads a hot word over K tasks before the second merges at most K partials per word.
* ``word_counts_salted_pairs``: the same with the salt drawn per (document, word) count after the
  per-document counts.
* ``word_counts_partitioned``: partial sums per task, then one merge by word -- which is what Spark's
  partial aggregation does, so its plan has that one exchange.

A document is one row, so per-document counts are made inside the row (sorted tokens, run lengths by
array functions) and exchange nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.text import space_tokens, utf16_length


def _tokens(lines: DataFrame) -> DataFrame:
    return lines.select("doc_id", "line_no", F.explode(space_tokens(F.col("line"))).alias("word"))


def doc_word_counts(lines: DataFrame) -> DataFrame:
    """``(doc_id, line_no, word, n)``: counts of each word inside each document, without an exchange.

    The tokens are sorted; a run starts where a token differs from the one before, and its length is
    the distance to the next start.
    """
    tokens = lines.select("doc_id", "line_no", F.array_sort(space_tokens(F.col("line"))).alias("t"))
    starts = F.filter(
        F.sequence(F.lit(0), F.size("t")),
        lambda i: (i == 0) | (i == F.size("t")) | (F.get("t", i) != F.get("t", i - 1)),
    )
    runs = tokens.filter(F.size("t") > 0).select("doc_id", "line_no", "t", starts.alias("s"))
    pairs = F.transform(
        F.slice("s", 1, F.size("s") - 1),
        lambda a, k: F.struct(F.get("t", a).alias("word"), (F.get("s", k + 1) - a).cast("bigint").alias("n")),
    )
    return runs.select("doc_id", "line_no", F.explode(pairs).alias("p")).select("doc_id", "line_no", "p.word", "p.n")


def word_counts(lines: DataFrame) -> DataFrame:
    """``(word, n)`` in one round."""
    return _tokens(lines).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def _salt(k: int, seed: int) -> F.Column:
    return F.pmod(F.xxhash64(F.lit(seed), "doc_id", "line_no", "word"), F.lit(int(k)))


def word_counts_salted(lines: DataFrame, k: int, seed: int = 17) -> DataFrame:
    """``(word, n)`` in two rounds, salt assigned per (document, word) in the map phase."""
    partial = (
        _tokens(lines)
        .groupBy(_salt(k, seed).alias("salt"), "word")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return partial.groupBy("word").agg(F.sum("n").cast("bigint").alias("n"))


def word_counts_salted_pairs(lines: DataFrame, k: int, seed: int = 29) -> DataFrame:
    """``(word, n)`` in two rounds, salt drawn for each per-document (word, count) pair."""
    per_doc = doc_word_counts(lines)
    partial = per_doc.groupBy(_salt(k, seed).alias("salt"), "word").agg(F.sum("n").alias("n"))
    return partial.groupBy("word").agg(F.sum("n").cast("bigint").alias("n"))


def word_counts_partitioned(lines: DataFrame) -> DataFrame:
    """``(word, n)``: a sum per task of its documents' counts, then one merge by word."""
    return doc_word_counts(lines).groupBy("word").agg(F.sum("n").cast("bigint").alias("n"))


def doc_count(lines: DataFrame) -> DataFrame:
    return lines.agg(F.count(F.lit(1)).alias("n_docs"))


def distinct_word_count(lines: DataFrame) -> DataFrame:
    return word_counts(lines).agg(F.count(F.lit(1)).alias("n_words"))


def avg_distinct_word_length(lines: DataFrame) -> DataFrame:
    """``(n_words, total_length, avg_length)`` over distinct words, lengths in UTF-16 units."""
    return word_counts(lines).agg(
        F.count(F.lit(1)).alias("n_words"),
        F.coalesce(F.sum(utf16_length(F.col("word"))), F.lit(0)).cast("bigint").alias("total_length"),
    ).select(
        "n_words",
        "total_length",
        F.try_divide(F.col("total_length").cast("double"), F.col("n_words").cast("double")).alias("avg_length"),
    )
