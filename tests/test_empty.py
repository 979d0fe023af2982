"""Every operator family on empty input: results are empty or zero, never an error."""

from tessera.operators import frequency as Q
from tessera.operators import kcenter as K
from tessera.operators import outliers as O
from tessera.operators import words as W
from tessera.sources.text import doc_lines


def test_empty_points(spark):
    pts = spark.createDataFrame([], "id bigint, x float, y float")
    assert O.approx_outlier_counts(pts, 1.0, 3).first().asDict() == {"sure_outliers": 0, "uncertain_points": 0}
    assert O.exact_outlier_count(pts, 1.0, 3).first().n_outliers == 0
    assert O.ball_counts(pts, 1.0).count() == 0
    assert O.point_labels(pts, 1.0, 3).count() == 0
    assert K.coreset(pts, 3, 2).count() == 0
    assert K.farthest_first(pts, 3).count() == 0
    centers = K.mr_centers(pts, 3, 2)
    assert K.radius(pts, centers).first().radius is None


def test_empty_documents_and_stream(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    lines = doc_lines(docs)
    assert W.word_counts(lines).count() == 0
    assert W.avg_distinct_word_length(lines).first().n_words == 0
    items = spark.createDataFrame([], "pos bigint, item bigint")
    p = Q.FrequencyParams(n=10, phi=0.2, epsilon=0.05, delta=0.1)
    assert Q.reservoir_sample(items, p).count() == 0
    assert Q.sticky_counts(items, p).count() == 0
    assert Q.frequent_items(items, p).count() == 0
    assert {r.method: r.n_held for r in Q.frequent_items_summary(items, p).collect()} == {
        "exact": 0, "reservoir": 0, "sticky": 0
    }
