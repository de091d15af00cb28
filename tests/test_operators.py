"""Edge rules of the validation operators on hand-made fixtures."""

import collections
import datetime as dt
import json
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from subsidia.functions import columns as fn
from subsidia.functions import stages
from subsidia.operators import catalog, compare, cube, gnss, stitch, validate, variogram, velocity
from subsidia.sources import readers

D = dt.date


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def pairs(spark, rows):
    return spark.createDataFrame(rows, "distance double, difference double")


def test_bins_are_right_closed_and_empty_bins_fail(spark):
    p = pairs(spark, [(0.1, 1.0), (5.09, 1.0), (50.0, 9.0), (50.1, 1.0), (20.0, None)])
    got = {r["bin"]: r for r in validate.binned_requirement_test(p).collect()}
    assert [got[b]["n_total"] for b in range(10)] == [1, 0, 0, 0, 0, 0, 0, 0, 0, 1]
    assert got[-1]["n_total"] == 2 and got[-1]["n_pass"] == 1
    assert got[0]["success"] and not got[1]["success"] and got[1]["pass_ratio"] is None


def test_transient_bins_are_left_closed_and_compat_drops_the_last(spark):
    p = pairs(spark, [(0.1, 1.0), (49.9, 1.0), (50.0, 1.0)]).withColumn("ifg", F.lit(1))
    total = lambda **k: validate.transient_requirement_test(p, **k).filter("bin = -1").first()["n_total"]
    assert total() == 2 and total(compat=True) == 1
    verdict = validate.stack_verdict(validate.transient_requirement_test(p)).first()
    assert verdict["n_ifg"] == 1 and verdict["verdict"]
    assert not validate.stack_verdict(validate.transient_requirement_test(p), use_mean=True).first()["verdict"]


def test_sample_pairs_drops_the_odd_one(spark):
    pts = spark.createDataFrame([(i, float(i), 0.0, float(i) if i != 4 else None) for i in range(8)], "id long, x double, y double, v double")
    assert validate.sample_pairs(pts, 100).count() == 3
    assert validate.sample_pairs(pts, 4).count() == 2
    again = validate.sample_pairs(pts.repartition(5), 100)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, validate.sample_pairs(pts, 100).collect()))


def test_outliers(spark):
    rows = [(0, float(v)) for v in (1, 2, 3, 2, 1, 2, 30)] + [(1, 5.0)] * 4 + [(1, 6.0), (1, None)] + [(2, 7.0)]
    layer = spark.createDataFrame(rows, "frame_id int, value double")
    found = lambda m, t: sorted((r["frame_id"], r["value"]) for r in validate.outlier_mask(layer, m, t).filter("outlier").collect())
    assert found("modified", 3.0) == [(0, 30.0), (1, 6.0)]  # MAD 0: all off the median
    assert found("zscore", 2.0) == [(0, 30.0)]


@pytest.mark.parametrize("direction", ["passing", "failing"])
def test_requirement_limit_equals_a_walk(spark, direction):
    d = [0.013, 0.02, 0.031, 0.5, 0.77, 0.04, 0.05, 0.06]
    p = pairs(spark, [(1.0, x) for x in d])
    k = next(k for k in range(1, 200) if sum(x < round(k * 0.01, 9) for x in d) / len(d) > 0.683)
    want = k if direction == "passing" else k - 1
    assert validate.requirement_limit(p, direction).first()["limit"] == pytest.approx(want * 0.01)


def test_temporal_sampling_is_inclusive(spark):
    days = [0, 12, 24, 36, 60, 1461]
    rows = [(1, D(2016, 1, 1) + dt.timedelta(d)) for d in days]
    r = validate.temporal_sampling(spark.createDataFrame(rows, "frame_id int, obs_date date")).first()
    assert r["share"] == pytest.approx(3 / 5) and r["years"] == 4.0 and not r["success"]


def test_density_and_masks(spark):
    rows = [(1, D(2020, 1, d + 1), 0, c, None if (c == 0 or d == 0) else 1.0) for d in range(11) for c in (0, 1)]
    obs = spark.createDataFrame(rows, "frame_id int, obs_date date, row int, col int, value double")
    got = {r["col"]: (r["n_valid"], r["density"]) for r in cube.density(obs).collect()}
    assert got == {0: (0, 0.0), 1: (10, 1.0)}
    assert {r["col"]: r["reliable"] for r in cube.reliability_mask(obs).collect()} == {0: False, 1: True}
    assert {r["col"]: r["valid"] for r in cube.validity(obs).collect()} == {0: False, 1: True}


def test_ingest_knows_both_kinds_of_no_data(spark):
    df = spark.createDataFrame([(0.0,), (float("nan"),), (None,), (2.0,)], "value double")
    assert [r["value"] for r in cube.ingest(df).collect()] == [None, None, None, 2.0]


def test_cumulative_displacement(spark):
    e = lambda a, b, v: (1, D(2020, 1, a), D(2020, 1, b), 0, 0, v)
    rows = [e(1, 2, 1.0), e(2, 3, 2.0), e(1, 3, 10.0), e(3, 4, None), e(2, 5, 1.0), e(3, 5, 1.0), e(8, 9, 5.0)]
    p = spark.createDataFrame(rows, "frame_id int, ref_date date, sec_date date, row int, col int, value double")
    got = {r["obs_date"].day: r["value"] for r in cube.cumulative_displacement(p).collect()}
    assert got == {2: 1.0, 3: 10.0, 4: None, 5: 2.0}  # fewest hops; NULL in an edge; earliest of equal paths; no path to 9


def test_nonlinear_score_equals_numpy(spark):
    rng = np.random.default_rng(3)
    series = np.cumsum(rng.normal(size=40))
    series[0] = 0
    rows = [(1, D(2020, 1, 1) + dt.timedelta(12 * i), 0, 0, float(v) if v else None) for i, v in enumerate(series)]
    obs = spark.createDataFrame(rows, "frame_id int, obs_date date, row int, col int, value double")
    s = series[1:]
    dev = np.array([np.std(np.cumsum(s[i : i + 11]) / np.arange(1, 12)) for i in range(len(s) - 10)])
    r = velocity.nonlinear_score(obs).first()
    assert r["sigma"] == pytest.approx(np.std(dev)) and r["score"] == pytest.approx((dev < np.std(dev)).mean())
    assert velocity.nonlinear_score(obs, compat=True).first()["score"] == 0.0
    assert velocity.nonlinear_score(obs.limit(5)).first()["score"] == 0.0


def test_time_function_fit_equals_lstsq(spark):
    rng = np.random.default_rng(1)
    days = np.arange(0, 1500, 12)
    t = days / 365.25
    g = np.c_[np.ones_like(t), t, np.cos(2 * np.pi * t), np.sin(2 * np.pi * t), np.cos(4 * np.pi * t), np.sin(4 * np.pi * t), days >= 700]
    y = g @ [1, 2, 0.3, -0.2, 0.1, 0.05, 4] + rng.normal(size=len(t)) * 0.1
    start, step = D(2016, 1, 1), D(2016, 1, 1) + dt.timedelta(700 - 700 % 12 + 12 if 700 % 12 else 700)
    rows = [(1, start + dt.timedelta(int(d)), 0, c, None if c == 1 else float(v)) for d, v in zip(days, y, strict=True) for c in (0, 1)]
    obs = spark.createDataFrame(rows, "frame_id int, obs_date date, row int, col int, value double")
    got = velocity.time_function_fit(obs, str(start), [1.0, 0.5], [str(step)]).collect()
    assert len(got) == 1
    assert list(got[0])[4:] == pytest.approx(np.linalg.lstsq(g, y, rcond=None)[0].tolist(), rel=1e-6)
    base = rng.normal(size=len(t))
    more = spark.createDataFrame([(*r[:4], 0, float(v + 3 * b), float(b)) for r, v, b in zip([x for x in rows if x[3] == 0], y, base, strict=True)], "frame_id int, obs_date date, row int, col int, k int, value double, bperp double")
    got = velocity.time_function_fit(more, str(start), [1.0, 0.5], [str(step)], extra=["bperp"]).first()
    assert list(got)[4:] == pytest.approx(np.linalg.lstsq(np.c_[g, base], y + 3 * base, rcond=None)[0].tolist(), rel=1e-6)
    few = velocity.time_function_fit(obs.filter("col = 0").limit(3), str(start), [1.0]).first()
    assert few["rate"] is None


def test_velocity_zero_rules(spark):
    rows = [(1, D(2020, 1, 1) + dt.timedelta(365 * i), 0, c, v) for i in range(3) for c, v in ((0, float(i + 1)), (1, None), (2, 1.0 if i == 0 else None))]
    obs = spark.createDataFrame(rows, "frame_id int, obs_date date, row int, col int, value double")
    plain = {r["col"]: r["velocity"] for r in velocity.linear_velocity(obs).collect()}
    filled = {r["col"]: r["velocity"] for r in velocity.linear_velocity(obs, fill_zero=True).collect()}
    assert plain[0] == pytest.approx(365.25 / 365) and plain[1] is None and plain[2] is None
    assert filled[1] is None and filled[2] < 0


def test_products(spark):
    name = "/d/SAT_L3_DISP_IW_F00042_VV_20200101T000000Z_{}T000000Z_v{}_{}T000000Z.nc"
    paths = [name.format(s, v, m) for s, v, m in (("20200113", "0.9", "20200201"), ("20200125", "0.9", "20200201"), ("20200113", "0.10", "20200301"))] + ["/d/readme.txt"]
    p = catalog.parse_products(spark.createDataFrame([(x,) for x in paths], "path string"))
    assert p.count() == 3 and {r["frame_id"] for r in p.collect()} == {42}
    kept = catalog.dedupe_products(p).collect()
    assert sorted((str(r["sec_date"]), r["version"]) for r in kept) == [("2020-01-13", "0.10"), ("2020-01-25", "0.9")]
    with pytest.raises(ValueError, match="several versions"):
        catalog.assert_single_version(p)
    assert catalog.single_version(p).first()["latest"] == "0.10"


def test_ministacks_restart_when_a_reference_recurs(spark):
    rows = [(1, D(2020, 1, r), D(2020, 2, s), f"p{s}") for s, r in enumerate((1, 1, 2, 2, 1), 1)]
    p = spark.createDataFrame(rows, "frame_id int, ref_date date, sec_date date, path string")
    got = [(r["stack"], r["first"], r["last"]) for r in catalog.ministacks(p).orderBy("sec_date").collect()]
    assert got == [(1, True, False), (1, False, True), (2, True, False), (2, False, True), (3, True, True)]


def test_readers(spark, tmp_path):
    u = "ABCD 20JAN15 2020.04 58863 2088 3 -116.5 {} 0.25 10 0.5 20 0.75 0 0.001 0.002 0.003 0.1 0.2 0.3 34.1 -116.5 0.2"
    (tmp_path / "ABCD.tenv3").write_text("site YYMMMDD header\n" + u.format("5") + "\n" + u.format("x") + "\nshort\n")
    got = readers.read_gnss_daily(spark, str(tmp_path / "ABCD.tenv3")).orderBy("east").collect()
    assert len(got) == 2 and got[0]["east"] is None and got[1]["east"] == 5.25 and got[1]["obs_date"] == D(2020, 1, 15) and got[1]["up"] == 20.75
    (tmp_path / "efgh.series").write_text("head\n" + " ".join(["2020.04", *"1 2 3 4 5 6 7 8 9 0".split(), "2020", "1", "15", "12", "0", "0"]) + "\n")
    s = readers.read_gnss_daily(spark, str(tmp_path / "efgh.series"), "series").first()
    assert (s["station"], s["obs_date"], s["east"], s["corr_nu"]) == ("EFGH", D(2020, 1, 15), 1.0, 9.0)
    (tmp_path / "steps.txt").write_text("\nA 20JAN15\nA 20JAN15 1\nA 20JAN15 1 Antenna\nA 20JAN15 2 100 50.5\nB 20FEB30 2 100 50.5 6.1 us7\nC 20JAN15 3 x y\n")
    e = {r["station"]: r for r in readers.read_step_events(spark, str(tmp_path / "steps.txt")).collect()}
    assert set(e) == {"A", "B"} and e["A"]["code"] == 1 and e["A"]["magnitude"] is None and e["B"]["step_date"] is None and e["B"]["magnitude"] == 6.1
    (tmp_path / "f.geojson").write_text('{"features": [{"id": "7", "properties": {"orbit_pass": "ASCENDING"}, "geometry": {"type": "Polygon", "coordinates": [[[0, 0], [4, 0], [4, 4], [0, 4], [0, 0]]]}}]}')
    frames = readers.read_frames(spark, str(tmp_path / "f.geojson"))
    stations = spark.createDataFrame([("in", 1.0, 1.0), ("edge", 4.0, 2.0), ("corner", 0.0, 0.0), ("out", 5.0, 1.0)], "station string, lon double, lat double")
    assert [r["station"] for r in gnss.stations_in_frame(stations, frames).collect()] == ["in"]
    touch = lambda x, y: gnss.frames_touching(frames, gnss.rectangle(x, y)).count()
    assert touch((1, 2), (1, 2)) == 1 and touch((-1, 9), (-1, 9)) == 1 and touch((-1, 5), (1, 2)) == 1 and touch((5, 6), (0, 1)) == 0
    (tmp_path / "p.wkt").write_text("POINT (1 2)\nMULTIPOINT ((1.0000001 2), (3 -4.5e0))\nnothing 7 8\n")
    pts = readers.merge_points(readers.parse_points(readers.numbered_lines(spark, str(tmp_path / "p.wkt"))))
    assert sorted((r["lon"], r["lat"]) for r in pts.collect()) == [(1.0, 2.0), (3.0, -4.5)]
    readers.write_points(pts, str(tmp_path / "out"))
    readers.write_points(pts.limit(0), str(tmp_path / "out"))  # existing results stay
    assert spark.read.text(str(tmp_path / "out")).count() == 2
    (tmp_path / "s.csv").write_text("station,lat,lon\nA,1.5,2.5\n")
    assert readers.read_stations(spark, str(tmp_path / "s.csv")).first()["lat"] == 1.5


def test_cube_writer_prunes(spark, tmp_path):
    rows = [(f, "timeseries", D(2020, 1, 1), r, c, 1.0) for f in (1, 2) for r in range(4) for c in range(4)]
    obs = spark.createDataFrame(rows, "frame_id int, layer string, obs_date date, row int, col int, value double")
    readers.write_cube(obs, str(tmp_path / "c"))
    window = cube.read_cube(spark.read.parquet(str(tmp_path / "c")), 2, rows=(1, 2), cols=(0, 1))
    assert window.count() == 4
    plan = window._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(frame_id" in plan and "GreaterThanOrEqual(row,1)" in plan


def test_columns(spark):
    assert value(spark, fn.version_key(F.lit("0.10")) > fn.version_key(F.lit("0.9")))
    assert value(spark, fn.haversine_km(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(180.0))) == pytest.approx(math.pi * 6378)
    e, n = fn.utm(F.lit(0.0), F.lit(-117.0), F.lit(11))
    assert value(spark, e) == pytest.approx(500000) and value(spark, n) == pytest.approx(0, abs=1e-6)
    e, n = fn.utm(F.lit(45.0), F.lit(3.0), F.lit(31))
    assert value(spark, n) == pytest.approx(4982950.400, abs=0.01)
    assert value(spark, fn.wrap(F.lit(math.pi))) == pytest.approx(-math.pi)
    assert value(spark, fn.los(F.lit(0.0), F.lit(0.0), F.lit(1.0), F.lit(60.0), F.lit(0.0))) == pytest.approx(0.5)
    inc, _ = fn.look_angles(F.lit(0.6), F.lit(0.0))
    assert value(spark, inc) is None
    inc, _ = fn.look_angles(F.lit(0.6), F.lit(1e-9))
    assert value(spark, inc) == pytest.approx(math.degrees(math.acos(0.8)))
    assert value(spark, fn.pixel_index(F.lit(-5.0), F.lit(0.0), F.lit(30.0))) == 0


def test_nearest_valid_is_exact(spark):
    rng = np.random.default_rng(5)
    cells = {(int(r), int(c)) for r, c in rng.integers(0, 60, (40, 2))}
    valid = spark.createDataFrame([(0, r, c, 1.0) for r, c in cells] + [(0, 0, 0, None)], "frame_id int, row int, col int, value double")
    pts = [(i, 0, int(r), int(c)) for i, (r, c) in enumerate(rng.integers(-5, 65, (30, 2)))]
    got = {r["pid"]: r["dist"] for r in variogram.nearest_valid(spark.createDataFrame(pts, "pid int, frame_id int, row int, col int"), valid).collect()}
    for i, _, r, c in pts:
        assert got[i] == pytest.approx(min(math.hypot(r - a, c - b) for a, b in cells))
    far = spark.createDataFrame([(1, 9, 0, 0)], "pid int, frame_id int, row int, col int")
    assert variogram.nearest_valid(far, valid, max_ring=4).first()["dist"] is None


def test_nearest_valid_has_no_farthest_ring(spark):
    cells = [(0, 80, 80, 1.0), (0, 0, 100, 2.0), (0, -300, 0, 3.0), (0, -300, 1, 4.0), (0, 700, 700, None), (1, 5000, 9000, 5.0), (3, 63, 63, 6.0), (3, 0, 66, 7.0)]
    valid = spark.createDataFrame(cells, "frame_id int, row int, col int, value double")
    rng = np.random.default_rng(7)
    pts = [(0, 0, 0, 0), (1, 1, 0, 0), (2, 2, 0, 0), (3, 3, 0, 0)] + [(10 + i, int(i % 2), int(r), int(c)) for i, (r, c) in enumerate(rng.integers(-900, 900, (20, 2)))]
    got = {r["pid"]: (r["dist"], r["near_row"], r["near_col"], r["value"]) for r in variogram.nearest_valid(spark.createDataFrame(pts, "pid int, frame_id int, row int, col int"), valid).collect()}
    assert len(got) == len(pts) and got[2] == (None, None, None, None) and got[3] == (66.0, 0, 66, 7.0)
    for pid, f, r, c in pts:
        assert f > 1 or got[pid] == min((math.hypot(r - a, c - b), a, b, v) for g, a, b, v in cells if g == f and v is not None)


def test_variogram_fit_recovers_a_model(spark):
    h = np.linspace(0.5, 50, 200)
    p = spark.createDataFrame([(float(x), float(4 * (1 - math.exp(-x / 7)))) for x in h], "distance double, gamma double")
    r = variogram.fit_variogram(p, [0.5 * k for k in range(1, 60)]).first()
    assert r["range"] == 7.0 and r["sill"] == pytest.approx(4) and r["rmse"] == pytest.approx(0, abs=1e-6)


def test_series_stats_need_two_values(spark):
    rows = [(1, 0, 0, 1.0, 2.0), (1, 0, 0, 2.0, 4.0), (1, 0, 0, None, 4.0), (1, 0, 1, 1.0, 1.0)]
    s = {r["col"]: r for r in compare.series_stats(spark.createDataFrame(rows, "frame_id int, row int, col int, value double, other double")).collect()}
    assert s[0]["n"] == 2 and s[0]["r"] == pytest.approx(1) and s[0]["mad"] == pytest.approx(0.5) and s[1]["rmse"] is None


def test_histogram_closes_the_last_bin(spark):
    v = spark.createDataFrame([(x,) for x in (0.0, 0.05, 0.5, 1.0, 1.1, None)], "value double")
    h = {r["bin"]: r["n"] for r in compare.histogram(v, (0.0, 1.0), 4).collect()}
    assert h == {0: 1, 1: 0, 2: 1, 3: 1}


def test_metadata_flattening_ignores_list_order(spark):
    doc = lambda j: compare.flatten_json(spark.createDataFrame([(1, j)], "k int, j string"), "k", "j").select("path", "value")
    a, b = doc('{"a": {"x": [1, 2]}, "cslc_file_list": ["f"], "z": 1}'), doc('{"a": {"x": [2, 1]}, "z": 2, "new": {"d": true}}')
    flat = lambda d: d.groupBy("path").agg(F.array_join(F.sort_array(F.collect_list("value")), ",").alias("value"))
    got = {r["path"]: r["change"] for r in compare.metadata_diff(flat(a), flat(b)).collect()}
    assert got == {"z": "changed", "new.d": "added"}


def test_stitching_removes_whole_cycles(spark):
    one = [(1, r, c, 1, 0.01 * r) for r in range(10) for c in range(5)]
    two = [(2, r, c, 3, 0.01 * r - 4 * math.pi) for r in range(5, 15) for c in range(5)]
    m = stitch.stitch(spark.createDataFrame(one + two, "frame_id int, row int, col int, label int, phase double"), [1, 2])
    rows = m.collect()
    assert len(rows) == 75 and all(r["label"] == 1 and r["phase"] == pytest.approx(0.01 * r["row"], abs=1e-9) for r in rows)


def test_step_detection(spark):
    days = [(("A"), D(2020, 1, 1) + dt.timedelta(i), 1.0 if i < 30 else 3.0) for i in range(60)]
    got = gnss.detect_steps(spark.createDataFrame(days, "station string, obs_date date, east double")).collect()
    assert [(r["obs_date"], r["kind"], r["change"]) for r in got] == [(D(2020, 1, 31), "stair", 2.0)]


def test_regrid_fills_outside(spark):
    src = spark.createDataFrame([(1, 0, 0, 5.0), (1, 0, 1, 6.0)], "frame_id int, row int, col int, value double")
    tgt = spark.createDataFrame([(1, 0, c) for c in range(4)], "frame_id int, row int, col int")
    grid = lambda x: spark.createDataFrame([(1, x, 0.0, 1.0, -1.0)], "frame_id int, x_first double, y_first double, x_step double, y_step double")
    got = lambda **k: [r["value"] for r in cube.regrid_nearest(src, grid(0.0), tgt, grid(-1.0), **k).orderBy("col").collect()]
    assert got() == [None, 5.0, 6.0, None] and got(fill=0.0) == [0.0, 5.0, 6.0, 0.0]


def test_exact_quantiles_equal_percentile(spark):
    rng = np.random.default_rng(4)
    rows = [(g, float(v)) for g in range(4) for v in (rng.exponential(size=301 + g) ** 4 if g else [2.0] * 7 + [5.0])] + [(9, 1.5), (9, None), (8, None)]
    df = spark.createDataFrame(rows, "g int, v double")
    for q in (0.0, 0.5, 0.683, 1.0):
        got = {r["g"]: r["quantile"] for r in stages.quantile(df, ["g"], "v", q).collect()}
        want = {r["g"]: r["w"] for r in df.filter("v IS NOT NULL").groupBy("g").agg(F.percentile("v", F.lit(q)).alias("w")).collect()}
        assert got == pytest.approx(want)


def test_numbering_equals_a_sort(spark):
    df = spark.range(3000).withColumn("h", F.md5(F.col("id").cast("string")))
    want = [r["id"] for r in df.orderBy("h", "id").limit(70).collect()]
    assert [r["id"] for r in stages.numbered(df, "h", "id", 70).orderBy("_rn").collect()] == want


def test_stations_near_each_other_lose_no_pair(spark):
    rng = np.random.default_rng(6)
    rows = [(i, float(x), float(y), float(v), 0.0) for i, (x, y, v) in enumerate(rng.uniform(-90_000, 90_000, (80, 3)))]
    s = spark.createDataFrame(rows, "station int, x double, y double, gnss double, insar double")
    near = validate.station_pairs(s, within_km=30.0)
    assert sorted(map(tuple, near.collect())) == sorted(map(tuple, validate.station_pairs(s).filter("distance <= 30").collect()))


def test_problem_steps_bounds_and_types(spark):
    e = lambda s, d, c, t, m: (s, D(2020, 1, d), c, t, m, 10.0)
    rows = [e("a", 1, 1, "Antenna_Changed", None), e("b", 9, 1, "Antenna_Changed", None), e("c", 5, 1, "Radome", None), e("d", 5, 2, "100", 5.0), e("f", 5, 2, "100", 5.1), e("g", 10, 1, "Antenna_Changed", None)]
    steps = spark.createDataFrame(rows, "station string, step_date date, code int, type_threshold string, magnitude double, distance_km double")
    found = lambda **k: sorted(r["station"] for r in gnss.problem_steps(steps, "2020-01-01", "2020-01-09", **k).collect())
    assert found() == ["a", "b", "f"] and found(earthquakes=False) == ["a", "b"]


def test_json_of_any_depth_and_kind(spark):
    deep = "{\"a\": " * 60 + "1" + "}" * 60
    rows = [(1, deep), (2, "not json"), (3, None), (4, '{"x": {}, "y": [], "z": null}'), (5, "7"), (6, "[]")]
    got = {}
    for r in compare.flatten_json(spark.createDataFrame(rows, "k int, j string"), "k", "j").collect():
        got.setdefault(r["k"], set()).add((r["path"], r["value"]))
    assert got == {1: {(".".join("a" * 60), "1")}, 2: {("", None)}, 3: {("", None)}, 4: {("x", "{}"), ("y", "[]"), ("z", None)}, 5: {("", "7")}, 6: {("", "[]")}}


def frame_rows(f, rows, label, offset, cols=range(5)):
    return [(f, r, c, label, 0.01 * r + 0.003 * c + offset) for r in rows for c in cols]


def stitched(spark, rows, frames):
    return stitch.stitch(spark.createDataFrame(rows, "frame_id int, row int, col int, label int, phase double"), frames).collect()


def test_stitching_keeps_components_of_three_frames(spark):
    rows = frame_rows(1, range(10), 9, 0.0) + frame_rows(2, range(20, 30), 8, 1.0) + frame_rows(2, range(8, 15), 2, 0.0) + frame_rows(3, range(28, 35), 3, 1.0)
    rows += frame_rows(3, range(40, 41), 12, 0.0)  # as read, no data
    got = {(r["row"], r["col"]): r["label"] for r in stitched(spark, rows, [1, 2, 3])}
    assert set(got) == {(r, c) for r in (*range(15), *range(20, 35)) for c in range(5)}
    assert got[0, 0] == got[14, 0] == 9 and got[20, 0] == got[34, 0] == 10  # the next free label


def test_stitching_goes_backward(spark):
    two_pi = 2 * math.pi
    rows = frame_rows(1, range(10), 1, 0.0, range(4)) + frame_rows(1, range(10), 2, 3 * two_pi, range(4, 7))  # cut in two, off by cycles
    rows += frame_rows(2, range(5, 15), 1, two_pi, range(7))
    got = stitched(spark, rows, [1, 2])
    assert len(got) == 105 and {r["label"] for r in got} == {1}
    assert all(r["phase"] == pytest.approx(0.01 * r["row"] + 0.003 * r["col"], abs=1e-9) for r in got)


def test_geodesic_and_inverse_utm(spark):
    km = lambda *x: value(spark, fn.geodesic_km(*map(F.lit, x)))
    assert km(0.0, 0.0, 0.0, 1.0) == pytest.approx(111.319491, abs=1e-5) and km(0.0, 0.0, 1.0, 0.0) == pytest.approx(110.574389, abs=1e-4) and km(5.0, 5.0, 5.0, 5.0) == 0
    lat, lon = fn.latlon(F.lit(500000.0), F.lit(4982950.400), F.lit(31))
    assert value(spark, lat) == pytest.approx(45.0, abs=1e-7) and value(spark, lon) == pytest.approx(3.0)


def test_fit_refines_and_knows_the_stable_model(spark):
    h = np.linspace(0.5, 50, 200)
    p = spark.createDataFrame([(float(x), float(4 * (1 - math.exp(-((x / 7.3) ** 1.5))))) for x in h], "distance double, gamma double")
    r = variogram.fit_variogram(p, [float(k) for k in range(1, 60)], "stable", refine=3).first()
    assert r["range"] == pytest.approx(7.3, abs=1e-3) and r["sill"] == pytest.approx(4, abs=1e-3) and r["residual_std"] < 1e-3
    assert variogram.fit_variogram(p.limit(0), [1.0]).count() == 0


def test_points_given_in_other_ways(spark):
    p = readers.points_from_pairs(spark, [(2.0, 1.0), (2.0, 1.0), (4.0, 3.0)])
    assert sorted((r["lon"], r["lat"]) for r in readers.merge_points(p).collect()) == [(1.0, 2.0), (3.0, 4.0)]
    with pytest.raises(ValueError, match="above 0"):
        readers.points_by_count(p, 0)


def test_layer_writer_keeps_what_is_there(spark, tmp_path):
    layer = spark.createDataFrame([(f, r, 0, 1.0) for f in (1, 2) for r in range(100)], "frame_id int, row int, col int, value double")
    readers.write_layer(layer, str(tmp_path / "v"))
    readers.write_layer(layer.limit(0), str(tmp_path / "v"))
    assert spark.read.parquet(str(tmp_path / "v")).filter("frame_id = 2").count() == 100


def test_profiles_equal_brute_force(spark):
    rng = np.random.default_rng(8)
    cells = {(int(r), int(c)): float(v) for (r, c), v in zip(rng.integers(0, 30, (250, 2)), rng.normal(size=250), strict=True)}
    values = spark.createDataFrame([(0, r, c, v) for (r, c), v in cells.items()], "frame_id int, row int, col int, value double")
    ends = [tuple(map(float, e)) for e in rng.uniform(0, 30_000, (12, 4))]
    rows = [(i, *e, math.hypot(e[0] - e[2], e[1] - e[3]) / 1000) for i, e in enumerate(ends)]
    pairs = spark.createDataFrame(rows, "pair long, x_0 double, y_0 double, x_1 double, y_1 double, distance double")
    got = {r["pair"]: r["difference"] for r in variogram.profile_pairs(pairs, values, (1000.0, 1000.0), (3.0, 25.0), n_points=20).collect()}
    want = {}
    for i, x0, y0, x1, y1, d in rows:
        if 3 < d < 25:
            along, near = [], []
            for k in range(20):
                r, c = math.floor((y0 + k / 19 * (y1 - y0)) / 1000), math.floor((x0 + k / 19 * (x1 - x0)) / 1000)
                at = min(cells, key=lambda rc: (math.hypot(rc[0] - r, rc[1] - c), rc))
                along.append(d * k / 19)
                near.append(cells[at])
            want[i] = abs(np.polyfit(along, near, 1)[0] * d)
    assert got == pytest.approx(want)


def flat(spark, rows, **how):
    return compare.flatten_json(spark.createDataFrame(rows, "k int, j string"), "k", "j", **how)


def random_tree(rng, depth):
    kind = rng.choice("soll" if depth else "s")
    if kind == "s":
        return rng.choice([1, 2, 1.5, "1", "x", True, None, "", "é.[]"])
    if kind == "l":
        return [random_tree(rng, depth - 1) for _ in range(rng.randint(0, 4))]
    return {rng.choice(["a", "b", "a.b", "c[]", "\\", "skip_me", "é"]): random_tree(rng, depth - 1) for _ in range(rng.randint(0, 4))}


def shuffled(rng, x):
    if isinstance(x, list):
        return rng.sample([shuffled(rng, v) for v in x], len(x))
    return dict(rng.sample([(k, shuffled(rng, v)) for k, v in x.items()], len(x))) if isinstance(x, dict) else x


def canonical(x, skip):
    if isinstance(x, list):
        return ("l", *sorted((canonical(v, skip) for v in x), key=repr)) if x else ("l",)
    if isinstance(x, dict):
        kept = {k: v for k, v in x.items() if skip not in k}
        return ("o", *sorted((k, canonical(v, skip)) for k, v in kept.items())) if kept or not x else ("none",)
    return type(x).__name__, x


def plain_rows(x, path, skip):
    """(path, what tells it apart) of the leaves outside lists and the elements of the outermost lists."""
    if isinstance(x, dict) and x:
        for k, v in x.items():
            if skip not in k:
                name = re.sub(r"([\\.\[\]])", r"\\\1", k)
                yield from plain_rows(v, f"{path}.{name}" if path else name, skip)
    elif isinstance(x, list) and x:
        yield from ((f"{path}[]", canonical(v, skip)) for v in x)
    else:
        yield path, canonical(x, skip)


def test_metadata_diff_of_random_trees(spark):
    rng, pairs = random.Random(17), []
    for k in range(60):
        a = {"r": random_tree(rng, 4), "s": random_tree(rng, 3)}
        b = shuffled(rng, a)
        if k % 3:
            b["s"] = random_tree(rng, 2)
        if k % 3 == 2 and isinstance(b["r"], list) and b["r"]:
            b["r"][0] = random_tree(rng, 2)
        pairs.append((k, a, b))
    one, two = (flat(spark, [(p[0], json.dumps(p[side], ensure_ascii=False)) for p in pairs], exclude="skip") for side in (1, 2))
    got = collections.defaultdict(list)
    for r in compare.metadata_diff(one, two, by=["k"]).collect():
        got[r["k"]].append((r["path"], r["change"]))
    for k, a, b in pairs:
        x, y = (collections.Counter(plain_rows(t, "", "skip")) for t in (a, b))
        gone, new = x - y, y - x
        want = []
        for path in {p for p, _ in (*gone, *new)}:
            n, m = (sum(v for (p, _), v in c.items() if p == path) for c in (gone, new))
            want += [(path, "changed")] if (n, m) == (1, 1) else [(path, "removed")] * n + [(path, "added")] * m
        assert sorted(got[k]) == sorted(want), (a, b)


def test_metadata_diff_of_long_lists(spark):
    n = 100_000
    a, b = json.dumps({"a": list(range(n)), "b": [{"x": [i % 7, i]} for i in range(1000)]}), json.dumps({"b": [{"x": [i, i % 7]} for i in range(1000)], "a": [*range(n - 1, 0, -1), -5]})
    got = compare.metadata_diff(flat(spark, [(1, a)]), flat(spark, [(1, b)])).collect()
    assert [tuple(r) for r in got] == [("a[]", "changed", "0", "-5")]


def test_metadata_paths_are_told_apart(spark):
    got = {(r["path"], r["value"]) for r in flat(spark, [(1, '{"a.b": 1, "a": {"b": 2}, "c": [{"d": [1]}, "x", null]}')]).collect()}
    assert got == {("a\\.b", "1"), ("a.b", "2"), ("c[]", '{"d":[1]}'), ("c[]", "x"), ("c[]", None)}
    same = compare.metadata_diff(flat(spark, [(1, '{"a": [1, "1", 1]}')]), flat(spark, [(1, '{"a": ["1", 1]}')])).collect()
    assert [tuple(r) for r in same] == [("a[]", "removed", "1", None)]
    assert compare.metadata_diff(flat(spark, []), flat(spark, [])).count() == 0


def test_equal_elements_are_unfolded_once(spark, monkeypatch):
    cuts = []
    monkeypatch.setattr(compare, "cut", lambda df, cut=compare.cut: cuts.append(cut(df)) or cuts[-1])
    element = '{"k": 1, "tags": [[2], "t"]}'
    rows = [(1, f'{{"a": [{", ".join([element] * 500)}]}}'), (2, f'{{"a": [{element}, {element.replace("2", "2.0")}, 1.5]}}'), (3, '{"a": [null, {"tags": ["t", [2]], "k": 1}, []]}')]
    got = compare.flatten_json(spark.createDataFrame(rows, "k int, j string"), "k", "j").collect()
    of = lambda k: [r["digest"] for r in got if r["k"] == k]
    assert len(got) == 506 and {r["path"] for r in got} == {"a[]"}
    same = set(of(1)).pop()
    assert len(set(of(1))) == 1 and same in of(2) and same in of(3) and len(set(of(2))) == len(set(of(3))) == 3
    assert sum(df.count() for df in cuts) < 700  # each of them level by level before
