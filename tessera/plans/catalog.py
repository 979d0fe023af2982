"""Named queries: the operators bound to the driver tables.

Bindings (fixed values of the query set):

* PTS  = embeddings: id = vec_id, (x, y) = the first two components; D = 0.05, M = 5, top K = 10;
  k-center with K = 4 centers and L = 3 parts.
* ORD  = orders: id = o_orderkey, x = totalprice / 1000, y = days since 1992-01-01; D = 14, M = 5.
* LI   = lineitem: x = extendedprice / 1000, y = quantity, folded to weighted distinct points;
  D = 0.4, M = 7.
* DOCS = documents.text split to lines; salted word counts with 8 salts.
* ITEMS = events: pos = event_id, item = user_id; with N rows, n = N, phi = 75/N, epsilon = 15/N,
  delta = 0.1. Only the two prefix queries, whose feature it is, take a prefix: n = 0.8 N.

Every query reads the whole table it names. Each callable takes (spark, data_dir).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import frequency as FQ
from tessera.operators import coresets as CS
from tessera.operators import kcenter as KC
from tessera.operators import outliers as OL
from tessera.operators.ball_tree import ball_counts_adaptive
from tessera.operators import words as WC
from tessera.sources.items import items_from_events, parse_items
from tessera.sources.points import (
    parse_points,
    points_from_embeddings,
    points_from_lineitem,
    points_from_orders,
)
from tessera.sources.tables import balanced, table
from tessera.sources.text import doc_lines

# fixed values of the query bindings
PTS_D, PTS_M, PTS_TOPK = 0.05, 5, 10
KC_K, KC_L = 4, 3
KC_BLOCKS = 4
ORD_D, ORD_M = 14.0, 5  # a seventh of the points are outliers at 15,000 orders
LI_D, LI_M = 0.4, 7  # a fifth at 60,000 lines
WORD_SALTS = 8
ITEMS_SEED = 42

Query = Callable[[SparkSession, str], DataFrame]


# ---- inputs ----------------------------------------------------------------------------------


def pts(spark: SparkSession, d: str) -> DataFrame:
    return balanced(points_from_embeddings(table(spark, d, "embeddings")))


def ord_points(spark: SparkSession, d: str) -> DataFrame:
    return balanced(points_from_orders(table(spark, d, "orders")))


def li_points(spark: SparkSession, d: str) -> DataFrame:
    # the fold is an aggregation: balance the scan so its partial aggregation runs on every core
    return points_from_lineitem(balanced(table(spark, d, "lineitem")))


def docs(spark: SparkSession, d: str) -> DataFrame:
    return doc_lines(balanced(table(spark, d, "documents")))


def items(spark: SparkSession, d: str) -> DataFrame:
    return balanced(items_from_events(table(spark, d, "events")))


def item_params(spark: SparkSession, d: str) -> FQ.FrequencyParams:
    # a metadata-only count of the parquet table
    return FQ.FrequencyParams.for_length(table(spark, d, "events").count(), seed=ITEMS_SEED)


def prefix_length(spark: SparkSession, d: str) -> int:
    return table(spark, d, "events").count() * 4 // 5


# ---- points ----------------------------------------------------------------------------------


def q_points_parse(spark: SparkSession, d: str) -> DataFrame:
    """S2: ``x,y[,...]`` lines built from part's integer columns, parsed to points."""
    lines = table(spark, d, "part").select(
        F.col("p_partkey").alias("key"),
        F.concat_ws(
            ",",
            F.concat(F.col("p_size").cast("string"), F.lit("."), F.pmod("p_partkey", F.lit(97)).cast("string")),
            F.concat(F.lit(" "), F.pmod(F.col("p_partkey") * 7, F.lit(1000)).cast("string"), F.lit(".25")),
            F.col("p_brand"),
        ).alias("value"),
    )
    return parse_points(lines, id_col="key")


def q_point_count(spark, d):
    return pts(spark, d).agg(F.count(F.lit(1)).alias("n_points"))


def q_grid_cells(spark, d):
    return OL.grid_cells(pts(spark, d), PTS_D).select("id", "i", "j")


def q_cell_counts(spark, d):
    return OL.cell_counts(pts(spark, d), PTS_D)


def q_cell_regions(spark, d):
    return OL.approx_regions(pts(spark, d), PTS_D)


def q_approx_outlier_counts(spark, d):
    return OL.approx_outlier_counts(pts(spark, d), PTS_D, PTS_M)


def q_point_labels(spark, d):
    return OL.point_labels(pts(spark, d), PTS_D, PTS_M)


def q_smallest_cells_topk(spark, d):
    return OL.smallest_cells(pts(spark, d), PTS_D, PTS_TOPK)


def q_ball_counts(spark, d):
    return OL.ball_counts(pts(spark, d), PTS_D)


def q_ball_counts_adaptive(spark, d):
    return ball_counts_adaptive(pts(spark, d), PTS_D)


def q_exact_outliers(spark, d):
    return OL.exact_outliers(pts(spark, d), PTS_D, PTS_M)


def q_exact_outlier_count(spark, d):
    return OL.exact_outlier_count(pts(spark, d), PTS_D, PTS_M)


def q_exact_outliers_topk(spark, d):
    return OL.exact_outliers_topk(pts(spark, d), PTS_D, PTS_M, PTS_TOPK)


def q_approx_outlier_counts_ord(spark, d):
    return OL.approx_outlier_counts(ord_points(spark, d), ORD_D, ORD_M)


def q_exact_outliers_ord(spark, d):
    return OL.exact_outliers(ord_points(spark, d), ORD_D, ORD_M)


def q_approx_outlier_counts_li(spark, d):
    return OL.approx_outlier_counts(li_points(spark, d), LI_D, LI_M)


def q_exact_outliers_li(spark, d):
    return OL.exact_outliers(li_points(spark, d), LI_D, LI_M, keep_weight=True).select("x", "y", "w", "ball")


# ---- k-center --------------------------------------------------------------------------------


def q_kcenter_coreset(spark, d):
    return KC.coreset(pts(spark, d), KC_K, KC_L)


def q_kcenter_coreset_one_pass(spark, d):
    return CS.one_pass_coreset(pts(spark, d), KC_K, KC_L, KC_BLOCKS)


def q_kcenter_centers(spark, d):
    return KC.mr_centers(pts(spark, d), KC_K, KC_L)


def q_kcenter_global(spark, d):
    return KC.farthest_first(pts(spark, d), KC_K)


def q_nearest_center_distance(spark, d):
    p = pts(spark, d)
    return KC.nearest_center_distance(p, KC.mr_centers(p, KC_K, KC_L))


def q_kcenter_radius(spark, d):
    p = pts(spark, d)
    return KC.radius(p, KC.mr_centers(p, KC_K, KC_L))


def q_radius_then_outliers(spark, d):
    """K5: the k-center radius becomes D of the approximate outlier counter (a scalar subquery)."""
    p = pts(spark, d)
    r = KC.radius(p, KC.mr_centers(p, KC_K, KC_L)).select(F.col("radius")).scalar()
    return OL.approx_outlier_counts(p, r, PTS_M).select(r.alias("radius"), "sure_outliers", "uncertain_points")


# ---- words -----------------------------------------------------------------------------------


def q_doc_lines(spark, d):
    return docs(spark, d)


def q_doc_count(spark, d):
    return WC.doc_count(docs(spark, d))


def q_word_counts(spark, d):
    return WC.word_counts(docs(spark, d))


def q_doc_word_counts(spark, d):
    return WC.doc_word_counts(docs(spark, d))


def q_word_counts_salted(spark, d):
    return WC.word_counts_salted(docs(spark, d), WORD_SALTS)


def q_word_counts_salted_pairs(spark, d):
    return WC.word_counts_salted_pairs(docs(spark, d), WORD_SALTS)


def q_word_counts_partitioned(spark, d):
    return WC.word_counts_partitioned(docs(spark, d))


def q_distinct_word_count(spark, d):
    return WC.distinct_word_count(docs(spark, d))


def q_avg_distinct_word_length(spark, d):
    return WC.avg_distinct_word_length(docs(spark, d))


# ---- items -----------------------------------------------------------------------------------


def q_items_parse(spark, d):
    """S6: one integer per line, lines built from events."""
    lines = table(spark, d, "events").select("event_id", F.col("user_id").cast("string").alias("value"))
    return parse_items(lines, pos_col="event_id")


def q_stream_prefix(spark, d):
    return FQ.prefix(items(spark, d), prefix_length(spark, d))


def q_distinct_items(spark, d):
    return FQ.distinct_items(items(spark, d))


def q_distinct_items_summary(spark, d):
    return FQ.distinct_items_summary(items(spark, d))


def q_item_histogram(spark, d):
    return FQ.item_histogram(items(spark, d))


def q_frequent_items(spark, d):
    return FQ.frequent_items(items(spark, d), item_params(spark, d))


def q_reservoir_sample(spark, d):
    return FQ.reservoir_sample(items(spark, d), item_params(spark, d))


def q_reservoir_frequent_items(spark, d):
    return FQ.reservoir_frequent_items(items(spark, d), item_params(spark, d))


def q_sticky_counts(spark, d):
    return FQ.sticky_counts(items(spark, d), item_params(spark, d))


def q_sticky_frequent_items(spark, d):
    return FQ.sticky_frequent_items(items(spark, d), item_params(spark, d))


def q_frequent_items_summary(spark, d):
    return FQ.frequent_items_summary(items(spark, d), item_params(spark, d))


QUERIES: dict[str, Query] = {
    "points_parse": q_points_parse,
    "point_count": q_point_count,
    "grid_cells": q_grid_cells,
    "cell_counts": q_cell_counts,
    "cell_regions": q_cell_regions,
    "approx_outlier_counts": q_approx_outlier_counts,
    "point_labels": q_point_labels,
    "smallest_cells_topk": q_smallest_cells_topk,
    "ball_counts": q_ball_counts,
    "ball_counts_adaptive": q_ball_counts_adaptive,
    "exact_outliers": q_exact_outliers,
    "exact_outlier_count": q_exact_outlier_count,
    "exact_outliers_topk": q_exact_outliers_topk,
    "approx_outlier_counts_ord": q_approx_outlier_counts_ord,
    "exact_outliers_ord": q_exact_outliers_ord,
    "approx_outlier_counts_li": q_approx_outlier_counts_li,
    "exact_outliers_li": q_exact_outliers_li,
    "kcenter_coreset": q_kcenter_coreset,
    "kcenter_coreset_one_pass": q_kcenter_coreset_one_pass,
    "kcenter_centers": q_kcenter_centers,
    "kcenter_global": q_kcenter_global,
    "nearest_center_distance": q_nearest_center_distance,
    "kcenter_radius": q_kcenter_radius,
    "radius_then_outliers": q_radius_then_outliers,
    "doc_lines": q_doc_lines,
    "doc_count": q_doc_count,
    "word_counts": q_word_counts,
    "doc_word_counts": q_doc_word_counts,
    "word_counts_salted": q_word_counts_salted,
    "word_counts_salted_pairs": q_word_counts_salted_pairs,
    "word_counts_partitioned": q_word_counts_partitioned,
    "distinct_word_count": q_distinct_word_count,
    "avg_distinct_word_length": q_avg_distinct_word_length,
    "items_parse": q_items_parse,
    "stream_prefix": q_stream_prefix,
    "distinct_items": q_distinct_items,
    "distinct_items_summary": q_distinct_items_summary,
    "item_histogram": q_item_histogram,
    "frequent_items": q_frequent_items,
    "reservoir_sample": q_reservoir_sample,
    "reservoir_frequent_items": q_reservoir_frequent_items,
    "sticky_counts": q_sticky_counts,
    "sticky_frequent_items": q_sticky_frequent_items,
    "frequent_items_summary": q_frequent_items_summary,
}
