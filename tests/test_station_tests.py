"""Requirement tests of all pairs of stations without a row for any pair, against the operators on pairs."""

import math
import random

import pytest
from pyspark.sql import functions as F

from subsidia.operators import pairs, validate


def stations(spark, n, spot, values):
    rng = random.Random(n)
    rows = [(k, *spot(rng), *values(rng)) for k in range(n)]
    return spark.createDataFrame([*rows, (n, 0.0, 0.0, None, 1.0)], "station int, x double, y double, gnss double, insar double")


GRID = (lambda r: (float(r.randint(0, 12) * 4990 + 100), float(r.randint(0, 3) * 4990)), lambda r: (g := r.randint(0, 9) / 10, g + r.randint(-4, 4)))
EVEN = (lambda r: (r.uniform(-9e4, 9e4), r.uniform(0, 5e4)), lambda r: (r.gauss(0, 3), r.gauss(0, 3)))


@pytest.mark.parametrize("spot, values", [GRID, EVEN])
@pytest.mark.parametrize("closed", ["left", "right"])
def test_station_requirement_test_equals_the_one_of_pairs(spark, monkeypatch, closed, spot, values):
    monkeypatch.setattr(pairs, "KEPT", 200)
    s = stations(spark, 300, spot, values)
    p = validate.station_pairs(s)
    key = lambda r: r["bin"]
    got = sorted(validate.station_requirement_test(s, closed=closed).collect(), key=key)
    want = sorted(validate.binned_requirement_test(p, closed=closed).collect(), key=key)
    for a, b in zip(got, want, strict=True):
        a, b = a.asDict(), b.asDict()
        assert a.pop("quantile") == pytest.approx(b.pop("quantile"), abs=1e-12) and a == b
    for direction in ("passing", "failing"):
        assert validate.station_requirement_limit(s, direction, closed=closed).collect() == validate.requirement_limit(p, direction, closed=closed).collect()


def test_no_stations(spark):
    s = stations(spark, 1, *EVEN)
    assert [r["n_total"] for r in validate.station_requirement_test(s).collect()] == [0] * 11
    assert validate.station_requirement_limit(s).first()["limit"] is None


@pytest.mark.parametrize("closed", ["left", "right", "both"])
def test_squares_say_what_distances_say(closed):
    edges = [-1.0, 0.0, 0.1, 5.09, 10.08, 50.0]
    for k, (edge, square) in enumerate(zip(edges, pairs.squares(edges, closed), strict=True)):
        strict = closed == "left" or (closed == "both" and k < len(edges) - 1)
        s = max(0.0, (edge * 1000) ** 2)
        for _ in range(20):
            s = math.nextafter(s, 0.0)
        for _ in range(40):
            d = math.sqrt(s) / 1000
            assert (s > square) == (d >= edge if strict else d > edge)
            s = math.nextafter(s, math.inf)


def test_met_tiles_hold_each_pair_once_in_many_small_cells(spark):
    s = stations(spark, 400, *EVEN).filter(F.col("gnss").isNotNull())
    met = pairs.met_tiles(s, 50_000.0, [], "gnss", "insar", 8)
    assert met.count() > 500  # work for many tasks
    figures = pairs.pair_figures(s, [0.0, 50.0], u="gnss", w="insar", closed="both", tile=8).first()
    assert figures["n"] == validate.station_pairs(s, within_km=50.0).count()


def test_all_pairs_are_dealt_and_ranked_where_they_are_made(spark, monkeypatch, tmp_path):
    from subsidia.plans import registry

    monkeypatch.setattr(validate, "TASK_PAIRS", 500)
    spark.range(1, 101).select(F.col("id").alias("s_suppkey"), F.col("id").cast("double").alias("s_acctbal")).coalesce(1).write.parquet(str(tmp_path / "supplier.parquet"))
    pairs_ = registry.QUERIES["j05_station_pairs"](spark, str(tmp_path))
    assert pairs_.rdd.getNumPartitions() == 10 and pairs_.count() == 4950  # one task before
    plan = registry.QUERIES["t02_order_pairs"](spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.index("Exchange hashpartitioning") > plan.index("NestedLoopJoin")


def test_a_point_is_sent_to_few_tasks_however_dense_points_are(spark, tmp_path):
    rng = random.Random(3)
    rows = [(rng.uniform(0, 59_000.0), rng.uniform(0, 59_000.0), rng.gauss(0, 1)) for _ in range(20_000)]
    spark.createDataFrame(rows, "x double, y double, v double").write.parquet(str(tmp_path / "points"))
    points = spark.read.parquet(str(tmp_path / "points"))
    sent = pairs.dealt(points, 10_000.0, [], "v", None, pairs.OWN).agg(F.sum("_n"), F.sum(F.length("_p"))).first()
    assert sent[0] <= 6 * 20_000  # tiles met each other in up to 240 copies, and were written three times
    met = pairs.met_tiles(points, 10_000.0, [], "v", None, 16).agg(F.sum(F.size("_a") + F.size("_b"))).first()
    assert met[0] > 20 * sent[0]


@pytest.mark.parametrize("closed", ["left", "right", "both"])
@pytest.mark.parametrize("grid", [True, False])
def test_boxes_settled_by_sorting_equal_brute_force(monkeypatch, closed, grid):
    import numpy as np

    for name, value in (("MANY", 400), ("STRIP", 5), ("COMPARED", 20), ("NEAR", 100)):
        monkeypatch.setattr(pairs, name, value)
    calls, crossed = [], pairs.crossed
    monkeypatch.setattr(pairs, "crossed", lambda *a: calls.append(1) or crossed(*a))
    rng, n = np.random.default_rng(5), 2_500
    p = np.column_stack([rng.integers(0, 30_000, n), rng.integers(0, 20_000, n), rng.integers(0, 50, n) / 5, np.zeros(n)])
    if not grid:
        p = p + np.column_stack([rng.random(n) + 5e5, rng.random(n) + 4e6, rng.normal(size=n), np.zeros(n)])
    edges = np.array([0.1 if closed == "right" else 0.0, 1.0, 2.0, 5.0, 5.5, 10.0])  # 3-4-5 triangles lie on the edges of the grid
    origin = np.array([*p[0, :2], p[0, 2]])
    a, b = pairs.Boxes(p[:1_000], origin, False), pairs.Boxes(p[1_000:], origin, False)
    got = sum(pairs.walk(x, y, x is y, edges, closed, None) for x, y in ((a, a), (b, b), (a, b)))
    i, j = np.triu_indices(n, 1)
    d2 = (p[i, 0] - p[j, 0]) ** 2 + (p[i, 1] - p[j, 1]) ** 2
    k = pairs.binned(np.sqrt(d2) / 1000, edges, closed)
    inside = (k >= 0) & (k < 5)
    want = [np.bincount(k[inside], w[inside], 5) for w in (np.ones(len(i)), d2, 0.5 * (p[i, 2] - p[j, 2]) ** 2)]
    assert len(calls) > 100 and (got[0] == want[0]).all()
    assert np.allclose(got[1:3], want[1:], rtol=1e-12)


@pytest.mark.parametrize("tile", [8, 60, 1 << 20])
def test_parts_of_crowded_regions_and_groups_meet_once(spark, tile):
    s = stations(spark, 300, *EVEN).filter("gnss IS NOT NULL").withColumn("g", F.when(F.col("station") % 3 > 0, F.col("station") % 3))
    found = {r["g"]: r["n"] for r in pairs.pair_figures(s, [0.0, 50.0], ["g"], "gnss", "insar", "both", tile=tile).collect()}
    for g in (None, 1, 2):
        assert found[g] == validate.station_pairs(s.filter(F.col("g").eqNullSafe(F.lit(g))), within_km=50.0).count()
    assert pairs.pair_figures(s.limit(0), [0.0, 50.0], u="gnss").count() == 0
