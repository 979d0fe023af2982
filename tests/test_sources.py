import plain
import pyarrow.parquet as pq
import pytest

from tessera.operators import frequency as Q
from tessera.operators import outliers as O
from tessera.sources.items import items_from_events, parse_items
from tessera.sources.points import parse_points, read_points
from tessera.sources.text import read_lines
from tessera.streaming import items as S

from conftest import N15, SF0001


def test_read_points_from_text_file(spark, xy15):
    pts = read_points(spark, N15)
    assert pts.count() == 15
    assert tuple(O.approx_outlier_counts(pts, 1.0, 3).first()) == plain.totals(xy15, 1.0, 3)


def test_read_lines_one_document_per_line(spark):
    lines = read_lines(spark, N15)
    assert lines.count() == 15
    assert sorted(r.line for r in lines.collect())[0] == "0.5,9.5"


def test_text_item_stream(spark, tmp_path):
    # the events' items written as text files, one integer per line, read as a stream
    table = pq.read_table(f"{SF0001}/events.parquet").sort_by("event_id")
    items = table.column("user_id").to_pylist()
    half = len(items) // 2
    for k, chunk in enumerate((items[:half], items[half:])):
        (tmp_path / f"items-{k}.txt").write_text("\n".join(str(v) for v in chunk) + "\n")
    stream = S.line_stream(spark, str(tmp_path), max_files_per_trigger=1)
    run = S.StreamRun(spark, "lines")
    sizes = S.batch_sizes(run, stream).collect()
    assert sorted(r.n_rows for r in sizes) == [half, len(items) - half]
    batch = items_from_events(spark.read.parquet(f"{SF0001}/events.parquet"))
    p = Q.FrequencyParams(n=len(items), phi=0.05, epsilon=0.01, delta=0.1)
    got = {r.item: r.n for r in S.histogram(S.StreamRun(spark, "lines-h"), S.line_stream(spark, str(tmp_path))).collect()}
    assert got == {r.item: r.n for r in Q.item_histogram(batch).collect()}


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_malformed_lines_fail_whatever_ansi_says(spark, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        for line in ("1.0,abc", "1.0", ",2", "x,1"):
            with pytest.raises(Exception, match="not a number|two fields"):
                parse_points(spark.createDataFrame([(line,)], "value string")).collect()
        for line in (" 5", "5 ", "", "4.0", "99999999999999999999"):
            with pytest.raises(Exception, match="not an integer"):
                parse_items(spark.createDataFrame([(0, line)], "pos bigint, value string"), pos_col="pos").collect()
        assert parse_items(spark.createDataFrame([(0, "-5")], "pos bigint, value string"), pos_col="pos").first().item == -5
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)
