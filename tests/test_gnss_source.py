"""The data source of daily solutions against the readers of lines."""

import datetime as dt

from pyspark.sql import functions as F

from subsidia.sources import gnss_source, readers


def write(folder):
    for name in ("AAAA", "BBBB", "CCCC"):
        lines = ["header"] + [f"{name} 21JAN{d:02d} 2021.0 59215 2139 {d} -117.0 10 0.{d} 20 0.5 30 0.25 0.1 0.001 0.002 0.003 0.4 0.5 0.6 1 2 3" for d in range(1, 11)] + ["short line"]
        (folder / f"{name}.tenv3").write_text("\n".join(lines) + "\n")


def test_equals_the_reader_of_lines(spark, tmp_path):
    write(tmp_path)
    got, want = gnss_source.gnss_daily(spark, str(tmp_path)), readers.read_gnss_daily(spark, str(tmp_path))
    valid = F.col("obs_date").isNotNull()
    assert sorted(map(tuple, got.filter(valid).select(want.columns).collect())) == sorted(map(tuple, want.filter(valid).collect()))
    assert got.count() == want.count()


def test_filters_leave_out_files_and_lines(spark, tmp_path):
    write(tmp_path)
    (tmp_path / "DDDD.tenv3").write_bytes(b"\xff\xfe not to be opened")
    df = gnss_source.gnss_daily(spark, str(tmp_path))
    some = df.filter((F.col("station") == "BBBB") & (F.col("obs_date") >= F.lit("2021-01-09").cast("date")))
    assert some.rdd.getNumPartitions() == 1
    assert sorted(r["obs_date"] for r in some.collect()) == [dt.date(2021, 1, 9), dt.date(2021, 1, 10)]
    two = df.filter(F.col("station").isin("AAAA", "CCCC"))
    assert two.rdd.getNumPartitions() == 2 and {r["station"] for r in two.collect()} == {"AAAA", "CCCC"}
    assert df.filter(F.col("station") == "NONE").count() == 0


def test_series_files(spark, tmp_path):
    (tmp_path / "efgh.series").write_text("header\n2021.01 1 2 3 4 5 6 7 8 9 0 2021 1 5 0 0 0\n")
    (tmp_path / "empty.series").write_text("")
    (tmp_path / "bad.series").write_text("header\n2021.01 1 2 x 4 5 6 7 8 9 0 2021 13 5 0 0 0\n")
    got = gnss_source.gnss_daily(spark, str(tmp_path), "series").collect()
    assert [(r["station"], r["obs_date"], r["east"], r["corr_nu"]) for r in sorted(got, key=lambda r: r["station"])] == [("BAD", None, 1.0, 9.0), ("EFGH", dt.date(2021, 1, 5), 1.0, 9.0)]
