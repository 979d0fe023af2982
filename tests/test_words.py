import collections

import pytest
from pyspark.sql import functions as F

from tessera.functions.text import space_tokens, split_lines
from tessera.operators import words as W
from tessera.sources.text import doc_lines

from conftest import SF0001


@pytest.mark.parametrize(
    "line,tokens",
    [("", [""]), ("  ", []), (" a", ["", "a"]), ("a  b ", ["a", "", "b"]), ("a b", ["a", "b"]), ("\ta b", ["\ta", "b"])],
)
def test_java_space_split(spark, line, tokens):
    df = spark.createDataFrame([(line,)], "line string")
    assert df.select(space_tokens(F.col("line")).alias("t")).first().t == tokens


@pytest.mark.parametrize(
    "text,lines",
    [("", []), ("a", ["a"]), ("a\n", ["a"]), ("a\nb", ["a", "b"]), ("a\r\nb\rc", ["a", "b", "c"]), ("a\n\nb\n", ["a", "", "b"])],
)
def test_line_rules(spark, text, lines):
    df = spark.createDataFrame([(text,)], "text string")
    assert df.select(split_lines(F.col("text")).alias("l")).first().l == lines


def _docs(spark):
    return doc_lines(spark.read.parquet(f"{SF0001}/documents.parquet"))


def _as_dict(df):
    return {r.word: r.n for r in df.collect()}


def test_four_word_counts_agree_with_python(spark):
    lines = _docs(spark)
    want = {}
    for r in lines.collect():
        toks = r.line.split(" ")
        while toks and toks[-1] == "" and r.line != "":
            toks.pop()
        if r.line == "":
            toks = [""]
        for t in toks:
            want[t] = want.get(t, 0) + 1
    assert _as_dict(W.word_counts(lines)) == want
    assert _as_dict(W.word_counts_salted(lines, 5)) == want
    assert _as_dict(W.word_counts_salted_pairs(lines, 3)) == want
    assert _as_dict(W.word_counts_partitioned(lines.repartition(7))) == want
    assert W.distinct_word_count(lines).first().n_words == len(want)
    avg = W.avg_distinct_word_length(lines).first()
    assert avg.total_length == sum(len(w.encode("utf-16-le")) // 2 for w in want)
    assert avg.avg_length == pytest.approx(avg.total_length / len(want))


def test_doc_word_counts_sum_to_word_counts(spark):
    lines = _docs(spark)
    per_doc = W.doc_word_counts(lines).groupBy("word").agg(F.sum("n").alias("n"))
    assert _as_dict(per_doc) == _as_dict(W.word_counts(lines))


def test_salted_plan_has_two_exchanges(spark):
    plan = W.word_counts_salted(_docs(spark), 4)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2


def _exchanges(df):
    """Exchanges of the plan on an input that balanced() doesn't touch."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    plan = plan.split("== Initial Plan ==")[-1]
    return plan.count("Exchange ")


def test_exchanges_of_the_strategies(spark):
    lines = spark.range(0, 1000, 1, 16).selectExpr("id AS doc_id", "0 AS line_no", "concat('a b a ', id % 7) AS line")
    assert _exchanges(W.doc_word_counts(lines)) == 0
    assert _exchanges(W.word_counts(lines)) == 1
    assert _exchanges(W.word_counts_partitioned(lines)) == 1
    assert _exchanges(W.word_counts_salted_pairs(lines, 4)) == 2


def test_doc_word_counts_on_hard_lines(spark):
    rows = [(0, ""), (1, " "), (2, "a"), (3, "b a b  b"), (4, "x x x"), (5, None)]
    lines = spark.createDataFrame([(i, 0, t) for i, t in rows], "doc_id int, line_no int, line string")
    got = collections.Counter({(r.doc_id, r.word): r.n for r in W.doc_word_counts(lines).collect()})
    exploded = W._tokens(lines).groupBy("doc_id", "word").count().collect()
    assert got == collections.Counter({(r.doc_id, r.word): r["count"] for r in exploded})
