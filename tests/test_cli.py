import plain
import pyarrow.parquet as pq

from tessera import cli

from conftest import N15, SF0001


def test_cli_jobs_run(spark, tmp_path, capsys, xy15):
    cli.main(["outliers", N15, "1", "3", "5", "2"])
    out = capsys.readouterr().out
    n = sum(b <= 3 for b in plain.balls(xy15, 1.0))
    assert f"exact_outliers: n_outliers\n{n}\n" in out
    cli.main(["kcenter", N15, "3", "3", "2"])
    assert "radius" in capsys.readouterr().out
    docs = tmp_path / "docs.txt"
    table = pq.read_table(f"{SF0001}/documents.parquet")
    docs.write_text("\n".join(t.replace("\r", "") for t in table.column("text").to_pylist()[:20]) + "\n")
    cli.main(["wordcount", "4", str(docs)])
    assert capsys.readouterr().out.count("n_words") >= 5
    events = tmp_path / "events"
    events.mkdir()
    pq.write_table(pq.read_table(f"{SF0001}/events.parquet"), events / "part-0.parquet")
    cli.main(["frequent", "800", "0.05", "0.01", "0.1", str(events)])
    assert "flag" in capsys.readouterr().out
    cli.main(["distinct", "800", str(events)])
    out = capsys.readouterr().out
    assert "n_distinct" in out and "n_rows" in out


def test_reports_are_complete(spark, tmp_path, capsys):
    """More than 20 frequent items, from lines without positions; all of them are reported."""
    lines = tmp_path / "lines"
    lines.mkdir()
    (lines / "a.txt").write_text("".join(f"{i % 40}\n" for i in range(2000)))
    args = ["frequent", "2000", "0.02", "0.005", "0.1", str(lines), "--lines"]
    cli.main(args)
    out = capsys.readouterr().out
    got = out[out.index("\nfrequent_items:") + 1 : out.index("reservoir_frequent_items:")].splitlines()[1:]
    assert got == [f"{i}, 50" for i in range(40)]
    cli.main([*args, "--out", str(tmp_path / "out")])
    assert spark.read.option("header", True).csv(f"{tmp_path}/out/frequent_items").count() == 40
