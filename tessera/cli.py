"""Command-line front end: five jobs as ``python -m tessera <job> ... [--out FOLDER]``.

Each job reads its input with Spark and runs the library's operators. Every report is printed whole,
row by row, or written as ``FOLDER/<report>`` (CSV with a header) when ``--out`` is given, which is
the way for reports that grow with the input.

    python -m tessera outliers  POINTS D M K L     exact (D, M) outliers, top K, and grid totals
    python -m tessera kcenter   POINTS M K L       MapReduce k-center radius, then grid totals
    python -m tessera wordcount K DOCS             word counts by the four strategies
    python -m tessera frequent  n phi eps delta FOLDER   exact / reservoir / sticky over a stream
    python -m tessera distinct  n FOLDER           distinct items of a stream

POINTS is a text file of ``x,y`` lines, DOCS a text file with one document per line, FOLDER a
folder read as a stream: event parquet files (``event_id``, ``user_id``), or with ``--lines`` text
files of one integer per line.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from tessera.operators import frequency, kcenter, outliers, words
from tessera.session import checkpoint_root
from tessera.sources.points import read_points
from tessera.sources.text import read_lines
from tessera.streaming import items as streams


def _session() -> SparkSession:
    spark = SparkSession.builder.appName("tessera").getOrCreate()
    checkpoint_root(spark)
    return spark


def report(a: argparse.Namespace, name: str, df: DataFrame) -> None:
    """All rows of a report: into the output folder, or printed."""
    if a.out:
        df.write.mode("overwrite").option("header", True).csv(f"{a.out.rstrip('/')}/{name}")
        return
    print(f"{name}: {', '.join(df.columns)}")
    for row in df.toLocalIterator():
        print(*row, sep=", ")


def run_outliers(spark: SparkSession, a: argparse.Namespace) -> None:
    pts = read_points(spark, a.points).repartition(a.L)
    report(a, "points", pts.groupBy().count().withColumnRenamed("count", "n_points"))
    report(a, "exact_outliers", outliers.exact_outlier_count(pts, a.D, a.M))
    report(a, "top_outliers", outliers.exact_outliers_topk(pts, a.D, a.M, a.K))
    report(a, "grid_outliers", outliers.approx_outlier_counts(pts, a.D, a.M))
    report(a, "smallest_cells", outliers.smallest_cells(pts, a.D, a.K))


def run_kcenter(spark: SparkSession, a: argparse.Namespace) -> None:
    pts = read_points(spark, a.points)
    report(a, "points", pts.groupBy().count().withColumnRenamed("count", "n_points"))
    r = kcenter.radius(pts, kcenter.mr_centers(pts, a.K, a.L)).select("radius").scalar()
    report(a, "radius_then_outliers", outliers.approx_outlier_counts(pts, r, a.M).select(r.alias("radius"), "*"))


def run_wordcount(spark: SparkSession, a: argparse.Namespace) -> None:
    lines = read_lines(spark, a.docs).repartition(a.K)
    report(a, "documents", words.doc_count(lines))
    for name, wc in (
        ("one_round", words.word_counts(lines)),
        ("salted", words.word_counts_salted(lines, a.K)),
        ("salted_pairs", words.word_counts_salted_pairs(lines, a.K)),
        ("per_partition", words.word_counts_partitioned(lines)),
    ):
        report(a, name, wc.groupBy().count().withColumnRenamed("count", "n_words"))
    report(a, "distinct_words", words.avg_distinct_word_length(lines))


def _item_stream(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    """The folder as a stream with positions; lines are numbered as they arrive."""
    if not a.lines:
        return streams.item_stream(spark, a.folder)
    run = streams.StreamRun(spark, "cli-positions")
    return streams.numbered_stream(spark, streams.positioned(run, streams.line_stream(spark, a.folder)))


def run_frequent(spark: SparkSession, a: argparse.Namespace) -> None:
    p = frequency.FrequencyParams(n=a.n, phi=a.phi, epsilon=a.eps, delta=a.delta)
    stream = _item_stream(spark, a)
    run = lambda name: streams.StreamRun(spark, f"cli-{name}")
    report(a, "methods", streams.frequent_items_summary(run("methods"), stream, p))
    report(a, "frequent_items", streams.frequent_items(run("frequent"), stream, p))
    report(a, "reservoir_frequent_items", streams.reservoir_frequent_items(run("reservoir"), stream, p))
    report(a, "sticky_frequent_items", streams.sticky_frequent_items(run("sticky"), stream, p))


def run_distinct(spark: SparkSession, a: argparse.Namespace) -> None:
    stream = _item_stream(spark, a)
    report(a, "batches", streams.batch_sizes(streams.StreamRun(spark, "cli-sizes"), stream).orderBy("batch_id"))
    report(a, "distinct_items", streams.distinct_summary(streams.StreamRun(spark, "cli-distinct"), stream, a.n))


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="tessera")
    sub = parser.add_subparsers(dest="job", required=True)
    o = sub.add_parser("outliers")
    o.add_argument("points")
    o.add_argument("D", type=float)
    o.add_argument("M", type=int)
    o.add_argument("K", type=int)
    o.add_argument("L", type=int)
    k = sub.add_parser("kcenter")
    k.add_argument("points")
    k.add_argument("M", type=int)
    k.add_argument("K", type=int)
    k.add_argument("L", type=int)
    w = sub.add_parser("wordcount")
    w.add_argument("K", type=int)
    w.add_argument("docs")
    f = sub.add_parser("frequent")
    f.add_argument("n", type=int)
    f.add_argument("phi", type=float)
    f.add_argument("eps", type=float)
    f.add_argument("delta", type=float)
    f.add_argument("folder")
    d = sub.add_parser("distinct")
    d.add_argument("n", type=int)
    d.add_argument("folder")
    for job in (f, d):
        job.add_argument("--lines", action="store_true")
    for job in (o, k, w, f, d):
        job.add_argument("--out")
    a = parser.parse_args(argv)
    spark = _session()
    {"outliers": run_outliers, "kcenter": run_kcenter, "wordcount": run_wordcount,
     "frequent": run_frequent, "distinct": run_distinct}[a.job](spark, a)


if __name__ == "__main__":
    main()
