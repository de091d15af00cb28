"""Figures of all pairs, change points, ragged time functions and profiles on the sphere, against brute force."""

import datetime as dt
import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from subsidia.functions import columns as fn
from subsidia.operators import changes, pairs, validate, variogram, velocity, windows


def brute_pairs(points, edges, closed, requirement):
    out = {}
    for (g, x0, y0, u0, w0), (h, x1, y1, u1, w1) in itertools.combinations(points, 2):
        if g != h:
            continue
        d = math.sqrt((x0 - x1) * (x0 - x1) + (y0 - y1) * (y0 - y1)) / 1000
        for k in range(len(edges) - 1):
            lo, hi = edges[k], edges[k + 1]
            last = closed == "both" and k == len(edges) - 2 and d == hi
            if (lo < d <= hi) if closed == "right" else (lo <= d < hi or last):
                v = (u0 - u1) - (w0 - w1)
                a = out.setdefault((g, k), [0, 0.0, 0.0, 0])
                a[0], a[1], a[2], a[3] = a[0] + 1, a[1] + d * d, a[2] + 0.5 * v * v, a[3] + (abs(v) < requirement(d))
    return out


@pytest.mark.parametrize("closed, tile, grid", [("left", 40, True), ("right", 16384, True), ("both", 150, False)])
def test_pair_figures(spark, closed, tile, grid):
    rng = random.Random(tile)
    spot = (lambda: float(rng.randint(0, 12) * 1000)) if grid else (lambda: rng.uniform(-4000, 9000))
    points = [(rng.choice(["a", "b", None]), spot(), spot(), float(rng.randint(0, 9)), rng.choice([0.0, 0.5])) for _ in range(500)]
    points += [points[0]] * 3
    bad = [("a", None, 1.0, 1.0, 0.0), ("a", 1.0, 1.0, None, 0.0), ("a", 1.0, float("nan"), 1.0, 0.0)]
    df = spark.createDataFrame(points + bad, "g string, x double, y double, gnss double, insar double")
    edges = [0.0, 1.0, 2.5, 5.0]
    got = pairs.pair_figures(df, edges, ["g"], "gnss", "insar", closed, lambda d: 3 * (1 + np.sqrt(d)), tile).collect()
    want = brute_pairs(points, edges, closed, lambda d: 3 * (1 + math.sqrt(d)))
    assert {(r["g"], r["bin"]) for r in got} == set(want)
    for r in got:
        n, d2, g, p = want[r["g"], r["bin"]]
        assert (r["n"], r["n_pass"]) == (n, p)
        assert r["distance"] == pytest.approx(math.sqrt(d2 / n), abs=1e-9) and r["gamma"] == pytest.approx(g / n, abs=1e-9)
    assert pairs.pair_figures(df.limit(0), edges, ["g"], "gnss").count() == 0


def test_walk_settles_boxes_without_points(monkeypatch):
    rng = np.random.default_rng(0)
    p = np.column_stack([rng.uniform(0, 50_000, (4000, 2)), rng.normal(size=4000), np.zeros(4000)])
    seen = []
    plain = pairs._points
    monkeypatch.setattr(pairs, "_points", lambda a, b, *rest: seen.append(len(a) * a.shape[1] * b.shape[1]) or plain(a, b, *rest))
    boxes = pairs.Boxes(p, p[0, [0, 1, 2]], False)
    n, _, g, _ = pairs.walk(boxes, boxes, True, np.array([0.0, 25.0, 80.0]), "both", None)
    d = np.sqrt(((p[:, None, :2] - p[None, :, :2]) ** 2).sum(-1))[np.triu_indices(4000, 1)] / 1000
    assert n.tolist() == [(d < 25).sum(), (d >= 25).sum()] and sum(seen) < 0.35 * len(d)
    v = (0.5 * (p[:, None, 2] - p[None, :, 2]) ** 2)[np.triu_indices(4000, 1)]
    assert np.allclose(g, [v[d < 25].sum(), v[d >= 25].sum()])


def test_binned_test_equals_percentile(spark):
    rng = random.Random(4)
    rows = [(rng.choice([0.1, 5.09, 10.08, 50.0, 49.99999]) if k % 3 else rng.uniform(0, 55), rng.choice([None, 0.0, 5.0, rng.uniform(0, 9), 10 ** rng.uniform(-9, 9)])) for k in range(900)]
    got = {r["bin"]: r for r in validate.binned_requirement_test(spark.createDataFrame(rows, "distance double, difference double")).collect()}
    edges = validate.edges(0.1, 50.0, 10)
    for k in range(-1, 10):
        lo, hi = (edges[k], edges[k + 1]) if k >= 0 else (0.1, 50.0)
        v = [x for d, x in rows if x is not None and lo < d <= hi]
        assert (got[k]["n_total"], got[k]["n_pass"]) == (len(v), sum(x < 5 for x in v))
        assert (got[k]["quantile"] is None) if not v else got[k]["quantile"] == pytest.approx(np.quantile(v, 0.683), rel=1e-12)


def plain_change_points(x, penalty, jump, least=2):
    """The unpruned recursion with costs from the whole kernel."""
    x, n = np.asarray(x, float), len(x)
    d = (x[:, None] - x[None]) ** 2
    m = np.median(d[np.triu_indices(n, 1)])
    gram = np.exp(-np.clip(d / m if m else d, 1e-2, 1e2))
    np.fill_diagonal(gram, 1.0)
    ends = [*range(0, n, jump), n]
    best = {0: (0.0, [])}
    for b in ends[1:]:
        found = [(best[a][0] + (b - a) - gram[a:b, a:b].sum() / (b - a) + penalty, best[a][1] + [a]) for a in ends if a < b and b - a >= least and a in best]
        if found:
            best[b] = min(found, key=lambda f: f[0])
    return best[n][1][1:] if n in best else []


@pytest.mark.parametrize("seed", range(12))
def test_change_points_equal_the_unpruned_recursion(seed):
    rng = np.random.default_rng(seed)
    n = int(rng.integers(4, 160))
    x = rng.normal(size=n) * 0.3 + np.repeat(rng.normal(size=8) * (seed % 3), 20)[:n]
    for jump, penalty in ((1, 1.0), (5, 1.0), (5, 0.2), (3, 5.0)):
        assert changes.change_points(x, penalty, jump) == plain_change_points(x, penalty, jump) == changes.change_points(x, penalty, jump, prune=False)
    assert changes.median_distance(x) == pytest.approx(np.median(((x[:, None] - x[None]) ** 2)[np.triu_indices(n, 1)]), rel=1e-12)


def test_planted_breaks_are_found(spark):
    rng = np.random.default_rng(1)
    rows = []
    for station, breaks in (("a", [100, 200]), ("b", []), ("c", [55])):
        level = np.zeros(300)
        for k in breaks:
            level[k:] += 5
        rows += [(station, dt.date(2020, 1, 1) + dt.timedelta(i), float(v)) for i, v in enumerate(level + 10 + rng.normal(size=300) * 0.2)]
    rows += [("d", dt.date(2020, 1, 1), 1.0), ("e", dt.date(2020, 1, 1), None)] + [("f", dt.date(2020, 1, 1) + dt.timedelta(i), 2.0) for i in range(50)]
    obs = spark.createDataFrame(rows, "station string, obs_date date, east double")
    got = sorted((r["station"], (r["obs_date"] - dt.date(2020, 1, 1)).days) for r in changes.station_change_points(obs, penalty=3.0).collect())
    assert got == [("a", 100), ("a", 200), ("c", 55)]
    kinds = {(r["station"], (r["obs_date"] - dt.date(2020, 1, 1)).days): (r["kind"], r["change"]) for r in changes.step_features(obs, penalty=3.0, skip_first=False).collect()}
    assert kinds["a", 100][0] == "stair" and kinds["a", 100][1] == pytest.approx(0.5, abs=0.05) and ("c", 55) in kinds


def test_peaks():
    assert changes.peaks([0, 2, 2, 2, 0, 3, 1, 5], 1) == [2, 5] and changes.peaks([5, 4, 4, 6, 6], 0) == [] and changes.peaks([0, 1, 0], 2) == []


def test_ragged_steps_equal_lstsq(spark):
    rng = np.random.default_rng(3)
    start, obs, steps, want = dt.date(2020, 1, 1), [], [], {}
    for s in range(12):
        days = np.sort(rng.choice(900, 60 + s, replace=False))
        own = sorted({int(d) for d in rng.integers(30, 860, s % 5)})
        own = [k for k, after in zip(own, [*own, 900][1:], strict=True) if ((days >= k) & (days < after)).any()]  # else it can't be told from the next
        t = days / 365.25
        design = np.column_stack([np.ones(len(t)), t, np.cos(2 * np.pi * t), np.sin(2 * np.pi * t), *[(days >= k).astype(float) for k in own]])
        y = design @ rng.normal(size=design.shape[1]) + rng.normal(size=len(t)) * 0.01
        want[s] = np.linalg.lstsq(design, y, rcond=None)[0], own
        obs += [(s, start + dt.timedelta(int(d)), float(v)) for d, v in zip(days, y, strict=True)]
        steps += [(s, start + dt.timedelta(k)) for k in own]
    obs += [(50, start, 1.0), (51, start, None)]
    steps += [(0, start - dt.timedelta(5)), (0, start + dt.timedelta(2000)), (0, None), steps[0], steps[0]]
    got = {r["station"]: r for r in velocity.ragged_time_function_fit(spark.createDataFrame(obs, "station int, obs_date date, value double"), spark.createDataFrame(steps, "station int, step_date date"), "2020-01-01", [1.0], ["station"]).collect()}
    assert set(got) == {*range(12), 50} and got[50]["rate"] is None
    for s, (x, own) in want.items():
        r = got[s]
        assert np.allclose([r["offset"], r["rate"], r["cos_1"], r["sin_1"]], x[:4], atol=1e-8)
        assert [(d["step_date"] - start).days for d in r["steps"] if d["amplitude"] is not None] == own
        assert np.allclose([d["amplitude"] for d in r["steps"] if d["amplitude"] is not None], x[4:], atol=1e-8)


def haversine(lo0, la0, lo1, la1):
    a = math.sin(math.radians(la1 - la0) / 2) ** 2 + math.cos(math.radians(la0)) * math.cos(math.radians(la1)) * math.sin(math.radians(lo1 - lo0) / 2) ** 2
    return 2 * 6378 * math.asin(min(1.0, math.sqrt(a)))


@pytest.mark.parametrize("centre, spread", [((180.0, 40.0), 0.3), ((0.0, 90.0), 0.4), ((10.0, -20.0), 60.0)])
def test_nearest_on_the_sphere(spark, centre, spread):
    rng = random.Random(int(spread * 10))
    spot = lambda: ((centre[0] + rng.uniform(-1, 1) * (spread if centre[1] != 90 else 180) + 180) % 360 - 180, max(-90.0, min(90.0, centre[1] + rng.uniform(-1, 1) * spread)))
    valid = [(*spot(), float(k) if k % 9 else None) for k in range(400)]
    asked = [(k, *spot()) for k in range(150)] + [(900, 3.0, 3.0), (901, -179.99999, centre[1] * 0.99)]
    near = variogram.nearest_on_sphere(variogram.unit_vector(spark.createDataFrame(asked, "pid int, lon double, lat double")), variogram.unit_vector(spark.createDataFrame(valid, "lon double, lat double, value double")), cell_km=2.0)
    got = {r["pid"]: r for r in near.collect()}
    assert len(got) == len(asked)
    for pid, lo, la in asked:
        best = min((haversine(lo, la, x, y), v) for x, y, v in valid if v is not None)
        assert got[pid]["dist"] == pytest.approx(best[0], abs=1e-4)
        assert got[pid]["value"] == best[1] or abs(haversine(lo, la, *next((x, y) for x, y, v in valid if v == got[pid]["value"])) - best[0]) < 1e-4


def test_nearest_among_crowded_positions(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(variogram, "CROWDED", 12, raising=False)
    rng = random.Random(12)
    spot = lambda size: (179.99 + rng.random() * size, 10 + rng.random() * size)
    valid = [(*spot(0.02 if k % 3 else 1e-5), float(k)) for k in range(1500)]
    valid += [(lo, la, v + 0.5) for lo, la, v in valid[:200]] + [(None, 10.0, 1.0), (math.nan, 10.0, 2.0)]
    spark.createDataFrame(valid, "lon double, lat double, value double").write.parquet(str(tmp_path / "valid"))
    asked = [(k, *spot(0.02 if k % 2 else 2e-5)) for k in range(120)] + [(120, 0.0, -80.0)]
    plans = []
    monkeypatch.setattr(variogram, "cut", lambda df, cut=variogram.cut: plans.append(df._jdf.queryExecution().executedPlan().toString()) or cut(df))
    near = variogram.nearest_on_sphere(variogram.unit_vector(spark.createDataFrame(asked, "pid int, lon double, lat double")), variogram.unit_vector(spark.read.parquet(str(tmp_path / "valid"))))
    got = {r["pid"]: r["value"] for r in near.collect()}
    unit = lambda lo, la: np.array([math.cos(math.radians(la)) * math.cos(math.radians(lo)), math.cos(math.radians(la)) * math.sin(math.radians(lo)), math.sin(math.radians(la))])
    held = np.array([unit(lo, la) for lo, la, _ in valid[:1500]])
    assert got == {k: valid[int(((held - unit(lo, la)) ** 2).sum(axis=1).argmin())][2] for k, lo, la in asked}
    assert not any("BroadcastHashJoin" in p for p in plans)  # the table of positions went through the driver


def test_geographic_profiles_across_the_date_line(spark):
    rng = random.Random(8)
    values = [((179.5 + i * 0.02 + 180) % 360 - 180, 10 + j * 0.02, i * 0.5 + rng.uniform(-0.1, 0.1)) for i in range(51) for j in range(51)]
    ends = [(k, (179.6 + rng.random() * 0.8 + 180) % 360 - 180, 10 + rng.random(), (179.6 + rng.random() * 0.8 + 180) % 360 - 180, 10 + rng.random()) for k in range(20)]
    rows = [(k, a, b, c, d, haversine(a, b, c, d)) for k, a, b, c, d in ends]
    got = variogram.geographic_profiles(spark.createDataFrame(rows, "pair long, x_0 double, y_0 double, x_1 double, y_1 double, distance double"), spark.createDataFrame(values, "lon double, lat double, value double"), (5.0, 100.0), n_points=30).collect()
    want = {}
    for k, a, b, c, d, length in rows:
        if 5 < length < 100:
            p, q = (np.array([math.cos(math.radians(y)) * math.cos(math.radians(x)), math.cos(math.radians(y)) * math.sin(math.radians(x)), math.sin(math.radians(y))]) for x, y in ((a, b), (c, d)))
            w, near = length / 6378, []
            for i in range(30):
                f = i / 29
                at = (math.sin((1 - f) * w) * p + math.sin(f * w) * q) / math.sin(w)
                lo, la = math.degrees(math.atan2(at[1], at[0])), math.degrees(math.asin(at[2]))
                near.append(min((haversine(lo, la, x, y), v) for x, y, v in values)[1])
            want[k] = abs(np.polyfit(np.arange(30) / 29 * length, near, 1)[0] * length)
    assert {r["pair"] for r in got} == set(want) and len(want) > 5
    assert all(r["difference"] == pytest.approx(want[r["pair"]], abs=1e-6) for r in got)


def test_transient_station_test_equals_pairs(spark):
    rng = random.Random(6)
    s = spark.createDataFrame([(i, i % 3, rng.uniform(0, 60_000), rng.uniform(0, 60_000), rng.uniform(0, 9), rng.uniform(0, 9)) for i in range(240)], "station int, ifg int, x double, y double, gnss double, insar double")
    key = ["ifg", "bin", "n_total", "n_pass", "success"]
    one, two = validate.transient_station_test(s).select(key), validate.transient_requirement_test(validate.station_pairs(s, ["ifg"], within_km=50.0)).select(key)
    assert sorted(one.collect()) == sorted(two.collect()) and one.filter(F.col("bin") == -1).count() == 3


def test_geodesic_inverse_on_published_lines(spark):
    dms = lambda d, m, s: (abs(d) + m / 60 + s / 3600) * (-1 if d < 0 else 1)
    bessel, international, grs80 = (6377.397155, 1 / 299.1528128), (6378.388, 1 / 297), (6378.137, 1 / 298.257222101)
    # Test lines published with the method, and one of a national survey; metres.
    lines = [
        (dms(55, 45, 0), 0.0, -dms(33, 26, 0), dms(108, 13, 0), bessel, 14110526.170),
        (dms(37, 19, 54.95367), 0.0, dms(26, 7, 42.83946), dms(41, 28, 35.50729), international, 4085966.703),
        (dms(35, 16, 11.24862), 0.0, dms(67, 22, 14.77638), dms(137, 47, 28.31435), international, 8084823.839),
        (-dms(37, 57, 3.72030), dms(144, 25, 29.52440), -dms(37, 39, 10.15610), dms(143, 55, 35.38390), grs80, 54972.271),
    ]
    for lat1, lon1, lat2, lon2, (a, f), metres in lines:
        got = spark.range(1).select(fn.geodesic_inverse_km(*map(F.lit, (lat1, lon1, lat2, lon2)), a, f)).first()[0]
        assert got * 1000 == pytest.approx(metres, abs=0.001)
    rows = spark.createDataFrame([(0.0, 179.9999, 0.0, -179.9999), (5.0, 7.0, 5.0, 7.0), (0.0, 0.0, 0.3, 179.9), (None, 1.0, 2.0, 3.0)], "a double, b double, c double, d double")
    km = [r[0] for r in rows.select(fn.geodesic_inverse_km(*map(F.col, "abcd"))).collect()]
    assert km[0] == pytest.approx(0.0002 * math.pi / 180 * 6378.137, rel=1e-9) and km[1] == 0 and km[2] is None and km[3] is None


@pytest.mark.parametrize("before, behind", [(3, 3), (50, 50), (3, 2), (0, 0)])
def test_window_sums(spark, before, behind):
    rng = random.Random(before)
    pixels = [(f, r, c, d, float(rng.randint(-9, 9)), rng.choice([None, 1.5, 2.0])) for f in (1, 2) for d in (0, 1) for r in range(-5, 150) for c in range(0, 140, 7)]
    pixels += pixels[:3]
    points = [(k, rng.randint(1, 3), rng.randint(-60, 190), rng.randint(-60, 190)) for k in range(60)] + [(100, 1, 63, 63), (101, 1, 64, 64)]
    got = windows.window_sums(spark.createDataFrame(points, "pid int, frame_id int, row int, col int"), spark.createDataFrame(pixels, "frame_id int, row int, col int, day int, v double, w double"), ["v", "w"], before, behind, epoch=["day"]).collect()
    want = {}
    for k, f, r, c in points:
        for g, y, x, d, v, w in pixels:
            if f == g and w is not None and r - before <= y <= r + behind and c - before <= x <= c + behind:
                a = want.setdefault((k, d), [0.0, 0.0, 0])
                a[0], a[1], a[2] = a[0] + v, a[1] + w, a[2] + 1
    assert {(r["pid"], r["day"]): [r["v"], r["w"], r["n"]] for r in got} == want


def test_window_rows_do_not_depend_on_the_radius(spark):
    pixels = spark.range(40_000).selectExpr("1 as frame_id", "cast(id div 200 as int) as row", "cast(id % 200 as int) as col", "1D as v")
    points = spark.range(20).selectExpr("id as pid", "1 as frame_id", "cast(100 + id as int) as row", "100 as col")
    for radius in (3, 40):
        plan = windows.window_sums(points, pixels, ["v"], radius, radius)._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("Generate explode") == 4 and "sequence" not in plan  # rows and columns of blocks, for the counts too
        assert {r["n"] for r in windows.window_sums(points, pixels, ["v"], radius, radius).collect()} == {(2 * radius + 1) ** 2}


@pytest.mark.parametrize("tile", [7, 4096])
def test_later_within(spark, tile):
    rng = random.Random(tile)
    rows = [(rng.choice("abcdefgh") + str(rng.randint(0, 40)), round(rng.uniform(0, 9), 1), rng.choice([0.1, 0.3, 2.7])) for _ in range(150)] + [("z9", 1.0, None)]
    got = {r["station"]: (r["n"], r["p"]) for r in pairs.later_within(spark.createDataFrame(rows, "station string, gnss double, insar double"), 2.4, tile).collect()}
    want = {}
    for a, g, i in rows[:-1]:
        n = [abs((g - h) - (i - j)) < 2.4 for b, h, j in rows[:-1] if a < b]
        if n:
            x = want.get(a, (0, 0))
            want[a] = x[0] + len(n), x[1] + sum(n)
    assert got == want
    assert pairs.later_within(spark.createDataFrame([], "station string, gnss double, insar double"), 1.0).count() == 0
