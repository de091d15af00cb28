"""Registered queries over cubes and layers, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from subsidia.functions import columns as fn
from subsidia.operators import cube, velocity
from subsidia.plans import fixtures as fxs
from subsidia.plans.fixtures import fx

QUERIES, SQL = {}, {}
PIX = 'frame_id, "row", col'


def query(name, sql=None):
    def add(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return add


def obs(spark, sf, version="A"):
    return cube.ingest(fxs.raw_obs(spark, sf, version)).drop("e")


def r9(*cols, digits=9):
    return [F.round(c, digits).alias(c) for c in cols]


def reference(spark, sf):
    return obs(spark, sf).select("frame_id").distinct().select("frame_id", (F.col("frame_id") * 20 + 10).alias("row"), F.lit(10).alias("col"))


REF = 'reference AS (SELECT DISTINCT frame_id, frame_id * 20 + 10 AS "row", 10 AS col FROM obs)'


@query("s06_read_cube", fx("obs") + f"""SELECT {PIX}, obs_date, round(value, 9) AS value FROM obs
WHERE frame_id = 0 AND obs_date BETWEEN DATE '2016-08-01' AND DATE '2017-03-01' AND "row" BETWEEN 2 AND 8 AND col BETWEEN 3 AND 15""")
def s06(spark, sf):
    return cube.read_cube(obs(spark, sf), 0, "timeseries", (fn.F.to_date(F.lit("2016-08-01")), F.to_date(F.lit("2017-03-01"))), (2, 8), (3, 15)).select(*cube.PIXEL, "obs_date", *r9("value"))


@query("a01_layer_mean", fx("obs") + f"SELECT {PIX}, round(avg(value), 9) AS value FROM obs GROUP BY ALL")
def a01(spark, sf):
    return cube.layer_mean(obs(spark, sf)).select(*cube.PIXEL, *r9("value"))


DENSITY = f"density AS (SELECT {PIX}, count(value) AS n_valid, (SELECT count(DISTINCT obs_date) FROM obs o WHERE o.frame_id = obs.frame_id) AS n_epochs FROM obs GROUP BY ALL)"


@query("a02_density", fx("obs") + f", {DENSITY} SELECT {PIX}, n_valid, n_epochs, round(n_valid / (n_epochs - 1), 9) AS density FROM density")
def a02(spark, sf):
    return cube.density(obs(spark, sf)).select(*cube.PIXEL, "n_valid", "n_epochs", *r9("density"))


@query("a03_reliability_mask", fx("obs") + f", {DENSITY} SELECT {PIX}, n_valid >= floor((n_epochs - 1) * 0.9::DOUBLE) AS by_count, n_valid / (n_epochs - 1) >= 0.9 AS by_density FROM density")
def a03(spark, sf):
    return cube.density(obs(spark, sf)).select(*cube.PIXEL, cube.reliable().alias("by_count"), cube.reliable(rule="density").alias("by_density"))


LAYER = 'layer AS (SELECT frame_id, "row", col, least(1.0::DOUBLE, abs(x) * 4) AS value, label, vec_id FROM cells WHERE e = 10)'


@query("a04_max_coherence_reference", fx("cells") + f""", {LAYER} SELECT frame_id, "row", col, round(value, 9) AS value FROM layer
QUALIFY row_number() OVER (PARTITION BY frame_id ORDER BY value DESC, "row", col) = 1""")
def a04(spark, sf):
    return cube.max_coherence_reference(fxs.layer(spark, sf, 10)).select(*cube.PIXEL, *r9("value"))


@query("a05_reference_check", fx("obs") + f""", {REF} SELECT r.frame_id, r."row", r.col, coalesce(bool_or(o.value IS NOT NULL), false) AS valid
FROM reference r LEFT JOIN (SELECT * FROM obs WHERE obs_date = DATE '2016-07-01' + 12 * 7) o USING (frame_id, "row", col) GROUP BY ALL""")
def a05(spark, sf):
    one = obs(spark, sf).filter(F.col("obs_date") == F.lit("2016-09-23").cast("date"))
    return cube.reference_check(one, reference(spark, sf))


@query("a06_rereference", fx("obs") + f""", {REF}, ref_at AS (SELECT o.frame_id, o.obs_date, o.value FROM obs o JOIN reference USING (frame_id, "row", col))
SELECT o.frame_id, o."row", o.col, o.obs_date, round(o.value - coalesce(a.value, 0), 9) AS value FROM obs o LEFT JOIN ref_at a ON o.frame_id = a.frame_id AND o.obs_date = a.obs_date""")
def a06(spark, sf):
    return cube.rereference(obs(spark, sf), reference(spark, sf), ["obs_date"]).select(*cube.PIXEL, "obs_date", *r9("value"))


DAYS = "date_diff('day', DATE '2000-01-01', obs_date)"


@query("a07_linear_velocity", fx("obs") + f"SELECT {PIX}, round(regr_slope(value, {DAYS}) * 365.25, 8) AS velocity FROM obs GROUP BY ALL")
def a07(spark, sf):
    return velocity.linear_velocity(obs(spark, sf)).select(*cube.PIXEL, *r9("velocity", digits=8))


@query("a07_linear_velocity_zero_filled", fx("obs") + f"SELECT {PIX}, round(nullif(regr_slope(coalesce(value, 0), {DAYS}) * 365.25, 0), 8) + 0 AS velocity FROM obs GROUP BY ALL")
def a07z(spark, sf):
    return velocity.linear_velocity(obs(spark, sf), fill_zero=True).select(*cube.PIXEL, *r9("velocity", digits=8))


@query("a07_weighted_velocity", fx("obs") + f""", w AS (SELECT *, {DAYS} / 365.25 AS t, CASE WHEN value IS NOT NULL AND least(1, abs(value) * 20) >= 0.4 THEN least(1, abs(value) * 20) ^ 2 ELSE 0 END AS w, coalesce(value, 0) AS v FROM obs)
SELECT {PIX}, round(CASE WHEN sum(w) * sum(w*t*t) - sum(w*t) ^ 2 > 1e-9 * sum(w) * sum(w*t*t) THEN (sum(w) * sum(w*t*v) - sum(w*t) * sum(w*v)) / (sum(w) * sum(w*t*t) - sum(w*t) ^ 2) END, 6) AS velocity FROM w GROUP BY ALL""")
def a07w(spark, sf):
    o = obs(spark, sf).withColumn("weight", F.least(F.lit(1.0), F.abs("value") * 20))
    return velocity.weighted_velocity(o, "weight").select(*cube.PIXEL, *r9("velocity", digits=6))


@query("a08_velocity_common_dates", fx("obs", "obs_b") + f""", dates AS (SELECT frame_id, obs_date FROM obs INTERSECT SELECT frame_id, obs_date FROM obs_b),
one AS (SELECT {PIX}, round(regr_slope(value, {DAYS}) * 365.25, 8) AS velocity FROM obs SEMI JOIN dates USING (frame_id, obs_date) GROUP BY ALL),
two AS (SELECT {PIX}, round(regr_slope(value, {DAYS}) * 365.25, 8) AS comparison_velocity FROM obs_b SEMI JOIN dates USING (frame_id, obs_date) GROUP BY ALL)
SELECT * FROM one JOIN two USING (frame_id, "row", col)""")
def a08(spark, sf):
    return velocity.velocity_common_dates(obs(spark, sf), obs(spark, sf, "B")).select(*cube.PIXEL, *r9("velocity", "comparison_velocity", digits=8))


@query("a09_time_function_fit")
def a09(spark, sf):
    return velocity.time_function_fit(obs(spark, sf), fxs.FIRST, [1.0, 0.5], ["2017-06-01"])


@query("a09_ragged_steps", fx("gnss") + """, first AS (SELECT station, (min(obs_date) + (3 + station % 20)::INT)::DATE AS step_date FROM gnss GROUP BY 1),
x AS (SELECT station, step_date, date_diff('day', DATE '2024-01-01', obs_date) / 365.25 AS t, (obs_date >= step_date)::INT::DOUBLE AS s, east AS y FROM gnss JOIN first USING (station)),
m AS (SELECT station, step_date, count(*) AS n, sum(t) AS t, sum(t * t) AS tt, sum(s) AS s, sum(s * t) AS st, sum(y) AS y, sum(t * y) AS ty, sum(s * y) AS sy FROM x GROUP BY ALL HAVING count(*) >= 3 AND sum(s) > 0 AND sum(s) < count(*)),
d AS (SELECT *, n * (tt * s - st * st) - t * (t * s - st * s) + s * (t * st - tt * s) AS det FROM m)
SELECT station, n, step_date, round((n * (ty * s - st * sy) - y * (t * s - st * s) + s * (t * sy - ty * s)) / det, 6) AS rate, round((n * (tt * sy - ty * st) - t * (t * sy - ty * s) + y * (t * st - tt * s)) / det, 6) AS amplitude FROM d""")
def a09r(spark, sf):
    """Rate and step of each station, whose step has a date of its own."""
    g = fxs.gnss(spark, sf).withColumn("value", F.col("east"))
    steps = g.groupBy("station").agg(F.min("obs_date").alias("_first")).select("station", F.date_add("_first", (3 + F.col("station") % 20).cast("int")).alias("step_date"))
    fit = velocity.ragged_time_function_fit(g, steps, "2024-01-01", [], ["station"])
    return fit.select("station", "n", F.inline("steps"), "rate").filter("amplitude IS NOT NULL").select("station", "n", "step_date", *r9("rate", "amplitude", digits=6))


@query("a10_deramp", fx("points") + """, m AS (SELECT avg(x) AS mx, avg(y) AS my, avg(v) AS mv, var_pop(x) AS xx, var_pop(y) AS yy, covar_pop(x, y) AS xy, covar_pop(x, v) AS xv, covar_pop(y, v) AS yv FROM points)
SELECT id, round(v - (mv + (xv * yy - yv * xy) / (xx * yy - xy * xy) * (x - mx) + (yv * xx - xv * xy) / (xx * yy - xy * xy) * (y - my)), 6) AS v FROM points, m""")
def a10(spark, sf):
    return velocity.deramp(fxs.velocity_points(spark, sf)).select("id", *r9("v", digits=6))


@query("a34_median_height", fx("cells") + f", {LAYER} SELECT frame_id, trunc(median(value * 1000))::INT AS height FROM layer WHERE value <> 0 GROUP BY ALL")
def a34(spark, sf):
    return cube.median_height(fxs.layer(spark, sf, 10).withColumn("value", F.col("value") * 1000))


@query("a35_mean_baseline", fx("obs") + "SELECT frame_id, obs_date, round(avg(value), 9) AS baseline FROM obs GROUP BY ALL")
def a35(spark, sf):
    return cube.mean_baseline(obs(spark, sf)).select("frame_id", "obs_date", *r9("baseline"))


@query("p06_threshold_mask", fx("cells") + f", {LAYER} SELECT {PIX}, value >= 0.6 AS mask FROM layer")
def p06(spark, sf):
    return cube.threshold_mask(fxs.layer(spark, sf, 10), 0.6)


@query("p07_apply_masks", fx("cells") + f""", {LAYER}, other AS (SELECT {PIX}, abs(x) * 4 >= 0.2 AS mask FROM cells WHERE e = 11)
SELECT l.frame_id, l."row", l.col, CASE WHEN l.value >= 0.3 AND o.mask THEN round(l.value, 9) END AS value FROM layer l LEFT JOIN other o USING (frame_id, "row", col)""")
def p07(spark, sf):
    one = fxs.layer(spark, sf, 10)
    return cube.apply_masks(one, cube.threshold_mask(one, 0.3), cube.threshold_mask(fxs.layer(spark, sf, 11), 0.2)).select(*cube.PIXEL, *r9("value"))


@query("p08_epoch_threshold_mask", fx("pair_obs") + f"SELECT {PIX}, ref_date, sec_date, round(CASE WHEN coherence < 0.5 THEN NULL ELSE value END, 9) AS value FROM pair_obs")
def p08(spark, sf):
    return cube.epoch_threshold_mask(fxs.pair_obs(spark, sf), {"coherence": 0.5}).select(*cube.PIXEL, "ref_date", "sec_date", *r9("value"))


@query("p09_recommended_mask", fx("pair_obs") + f"SELECT {PIX}, ref_date, sec_date, CASE WHEN k % 4 < 1 OR coherence < 0.6 OR coherence * 0.9 < 0.5 THEN 0 ELSE 1 END AS mask FROM pair_obs")
def p09(spark, sf):
    p = fxs.pair_obs(spark, sf)
    return p.select(*cube.PIXEL, "ref_date", "sec_date", cube.recommended_mask(F.col("k") % 4, F.col("coherence"), F.col("coherence") * 0.9).alias("mask"))


@query("p10_water_mask", fx("cells") + f", {LAYER} SELECT {PIX}, CASE WHEN vec_id % 9 * 10 = 80 THEN NULL WHEN vec_id % 9 <> 0 THEN round(value, 9) END AS value FROM layer")
def p10(spark, sf):
    one = fxs.layer(spark, sf, 10)
    return one.select(*cube.PIXEL, F.when(cube.water_mask(F.col("vec_id") % 9 * 10) == 1, F.round("value", 9)).alias("value"))


@query("p11_blank_box", fx("cells") + f""", {LAYER} SELECT {PIX}, CASE WHEN NOT ("row" >= 3 AND "row" < 9 AND col >= 5 AND col < 20) THEN round(value, 9) END AS value FROM layer""")
def p11(spark, sf):
    return cube.blank_box(fxs.layer(spark, sf, 10), (3, 9), (5, 20)).select(*cube.PIXEL, *r9("value"))


def grids(layer, x, y, d):
    return layer.select("frame_id").distinct().select("frame_id", F.lit(x).alias("x_first"), F.lit(y).alias("y_first"), F.lit(d).alias("x_step"), F.lit(-d).alias("y_step"))


@query("p12_subset_box", fx("cells") + f""", {LAYER} SELECT {PIX}, round(value, 9) AS value FROM layer WHERE "row" BETWEEN 4 AND 12 AND col BETWEEN 2 AND 9""")
def p12(spark, sf):
    one = fxs.layer(spark, sf, 10)
    return cube.subset_box(one, grids(one, -120.0, 40.0, 0.01), (39.875, 39.955), (-119.975, -119.905)).select(*cube.PIXEL, *r9("value"))


@query("p13_fractional_years", fx("obs") + "SELECT DISTINCT frame_id, obs_date, round(date_diff('day', DATE '2016-07-01', obs_date) / 365.25, 9) AS years FROM obs")
def p13(spark, sf):
    first = F.lit(fxs.FIRST).cast("date")
    return obs(spark, sf).select("frame_id", "obs_date").distinct().withColumn("years", F.round(fn.fractional_years(F.col("obs_date"), first), 9))


@query("p14_grid_xy", fx("cells") + f""", {LAYER} SELECT {PIX}, (trunc(500000.7)::BIGINT + (col + 0.5) * trunc(30.2)::BIGINT)::DOUBLE AS x, (trunc(4000000.9)::BIGINT + ("row" + 0.5) * trunc(-30.2)::BIGINT)::DOUBLE AS y FROM layer""")
def p14(spark, sf):
    one = fxs.layer(spark, sf, 10)
    return one.select(*cube.PIXEL, fn.pixel_centre(F.col("col"), F.lit(500000.7), F.lit(30.2), True).cast("double").alias("x"), fn.pixel_centre(F.col("row"), F.lit(4000000.9), F.lit(-30.2), True).cast("double").alias("y"))


@query("p21_validity", fx("obs") + f"SELECT {PIX}, coalesce(bool_or(value <> 0), false) AS valid FROM obs WHERE obs_date BETWEEN DATE '2016-08-01' AND DATE '2016-08-12' GROUP BY ALL")
def p21(spark, sf):
    o = obs(spark, sf).filter(F.col("obs_date").between(F.lit("2016-08-01").cast("date"), F.lit("2016-08-12").cast("date")))
    return cube.validity(o)


SCORE = """valid AS (SELECT *, row_number() OVER (PARTITION BY frame_id, "row", col ORDER BY obs_date) - 1 AS t, count(*) OVER (PARTITION BY frame_id, "row", col) AS n FROM obs WHERE value IS NOT NULL),
series AS (SELECT frame_id, "row", col, t - 1 AS t, n - 1 AS n, value FROM valid WHERE t >= 1),
windows AS (SELECT s.*, w FROM series s, range(0, 64) r(w) WHERE w <= n - 11 AND t >= w AND t < w + 11),
means AS (SELECT frame_id, "row", col, n, w, avg(value) OVER (PARTITION BY frame_id, "row", col, w ORDER BY t ROWS UNBOUNDED PRECEDING) AS m FROM windows),
spread AS (SELECT frame_id, "row", col, n, w, stddev_pop(m) AS d FROM means GROUP BY ALL),
sigmas AS (SELECT *, stddev_pop(d) OVER (PARTITION BY frame_id, "row", col) AS sigma FROM spread)"""


@query("w02_nonlinear_score", fx("obs") + f""", {SCORE} SELECT {PIX}, round(any_value(sigma), 7) AS sigma, round(count(*) FILTER (d < sigma) / any_value(n - 10), 7) AS score FROM sigmas GROUP BY ALL""")
def w02(spark, sf):
    return velocity.nonlinear_score(obs(spark, sf).filter("value IS NOT NULL")).select(*cube.PIXEL, *r9("sigma", "score", digits=7))


GAPS = """gaps AS (SELECT frame_id, "row", col, obs_date, CASE WHEN (vec_id + e) % 67 <> 0 THEN x * 0.1::DOUBLE END AS value FROM cells),
numbered AS (SELECT *, row_number() OVER (PARTITION BY frame_id, "row", col ORDER BY obs_date) - 2 AS t FROM gaps),
windows AS (SELECT s.*, w FROM numbered s, range(0, 53) r(w) WHERE s.t >= w AND s.t < w + 11),
means AS (SELECT frame_id, "row", col, w, avg(value) OVER (PARTITION BY frame_id, "row", col, w ORDER BY t ROWS UNBOUNDED PRECEDING) AS m FROM windows),
spread AS (SELECT frame_id, "row", col, w, CASE WHEN count(m) = count(*) THEN stddev_pop(m) END AS d FROM means GROUP BY ALL),
sigmas AS (SELECT *, CASE WHEN count(d) OVER p = count(*) OVER p THEN stddev_pop(d) OVER p END AS sigma FROM spread WINDOW p AS (PARTITION BY frame_id, "row", col))"""


@query("w02_nonlinear_score_gaps", fx("cells") + f""", {GAPS} SELECT {PIX}, round(any_value(sigma), 7) AS sigma, round(CASE WHEN any_value(sigma) IS NULL THEN 0 ELSE count(*) FILTER (d < sigma) / count(*) END, 7) AS score FROM sigmas GROUP BY ALL""")
def w02g(spark, sf):
    """Gaps stay in their places: a window that begins with one leaves the pixel without a score."""
    c = fxs._cells(spark, sf)
    return velocity.nonlinear_score(c.select(*cube.PIXEL, "obs_date", F.when((F.col("vec_id") + F.col("e")) % 67 != 0, F.col("x") * 0.1).alias("value"))).select(*cube.PIXEL, *r9("sigma", "score", digits=7))


PATHS = """edges AS (SELECT DISTINCT frame_id, ref_date, sec_date FROM pair_obs),
walk AS (SELECT frame_id, min(ref_date) AS target_date, []::DATE[] AS path FROM edges GROUP BY frame_id
  UNION ALL SELECT w.frame_id, e.sec_date, list_append(w.path, e.ref_date) FROM walk w JOIN edges e ON w.frame_id = e.frame_id AND w.target_date = e.ref_date),
best AS (SELECT * FROM walk WHERE len(path) > 0 QUALIFY row_number() OVER (PARTITION BY frame_id, target_date ORDER BY len(path), path) = 1),
paths AS (SELECT frame_id, target_date, unnest(path) AS ref_date, unnest(list_append(path[2:], target_date)) AS sec_date, len(path) AS hops FROM best)"""


@query("w03_cumulative_displacement", fx("pair_obs").replace("WITH", "WITH RECURSIVE", 1) + f""", {PATHS}
SELECT {PIX}, target_date AS obs_date, round(CASE WHEN count(value) = any_value(hops) THEN sum(value) END, 9) AS value FROM pair_obs JOIN paths USING (frame_id, ref_date, sec_date) GROUP BY ALL""")
def w03(spark, sf):
    return cube.cumulative_displacement(fxs.pair_obs(spark, sf)).select(*cube.PIXEL, "obs_date", *r9("value"))


@query("w08_first_epoch_subtract", fx("obs") + f""", late AS (SELECT * FROM obs WHERE obs_date > DATE '2016-09-01'), zero AS (SELECT {PIX}, value AS z FROM late WHERE obs_date = (SELECT min(obs_date) FROM late l WHERE l.frame_id = late.frame_id))
SELECT l.frame_id, l."row", l.col, l.obs_date, round(l.value - z, 9) AS value FROM late l LEFT JOIN zero USING (frame_id, "row", col)""")
def w08(spark, sf):
    return cube.first_epoch_subtract(obs(spark, sf), after="2016-09-01").select(*cube.PIXEL, "obs_date", *r9("value"))


@query("j10_subtract_corrections", fx("obs", "obs_b") + f""", {REF}, ref_at AS (SELECT o.frame_id, o.obs_date, o.value FROM obs_b o JOIN reference USING (frame_id, "row", col)),
corr AS (SELECT b.frame_id, b."row", b.col, b.obs_date, b.value - coalesce(a.value, 0) AS value FROM obs_b b LEFT JOIN ref_at a ON b.frame_id = a.frame_id AND b.obs_date = a.obs_date)
SELECT o.frame_id, o."row", o.col, o.obs_date, round(o.value - coalesce(c.value, 0) - coalesce(c.value, 0), 9) AS value FROM obs o LEFT JOIN corr c USING (frame_id, "row", col, obs_date)""")
def j10(spark, sf):
    b = obs(spark, sf, "B")
    return cube.subtract_corrections(obs(spark, sf), b, b, reference=reference(spark, sf)).select(*cube.PIXEL, "obs_date", *r9("value"))


@query("j11_pairwise_from_epochs", fx("pair_obs", "obs_b") + """SELECT p.frame_id, p."row", p.col, p.ref_date, p.sec_date, round(coalesce((r.value - s.value) * 2, 0), 9) AS value FROM pair_obs p
LEFT JOIN obs_b r ON p.frame_id = r.frame_id AND p."row" = r."row" AND p.col = r.col AND p.ref_date = r.obs_date
LEFT JOIN obs_b s ON p.frame_id = s.frame_id AND p."row" = s."row" AND p.col = s.col AND p.sec_date = s.obs_date""")
def j11(spark, sf):
    return cube.pairwise_from_epochs(fxs.pair_obs(spark, sf), obs(spark, sf, "B"), 2.0).select(*cube.PIXEL, "ref_date", "sec_date", *r9("value"))


@query("j13_regrid_nearest", fx("cells") + f""", {LAYER}, target AS (SELECT frame_id, "row", col, floor((7.0 + (col + 0.5) * 20.0 - 0) / 30.0)::INT AS c, floor((-11.0 + ("row" + 0.5) * -20.0 - 0) / -30.0)::INT AS r FROM layer)
SELECT t.frame_id, t."row", t.col, round(l.value, 9) AS value FROM target t LEFT JOIN layer l ON t.frame_id = l.frame_id AND t.r = l."row" AND t.c = l.col""")
def j13(spark, sf):
    one = fxs.layer(spark, sf, 10)
    grid = lambda x, y, d: one.select("frame_id").distinct().select("frame_id", F.lit(x).alias("x_first"), F.lit(y).alias("y_first"), F.lit(d).alias("x_step"), F.lit(-d).alias("y_step"))
    return cube.regrid_nearest(one, grid(0.0, 0.0, 30.0), one.select(*cube.PIXEL), grid(7.0, -11.0, 20.0)).select(*cube.PIXEL, *r9("value"))


@query("j16_expand_epoch_masks", fx("cells") + """, stacks AS (SELECT DISTINCT frame_id, s AS stack, s * 16 AS a, s * 16 + 14 AS b FROM cells, range(0, 4) t(s)),
masks AS (SELECT frame_id, "row", col, e // 16 AS stack, abs(x) * 4 >= 0.3 AS mask FROM cells WHERE e % 16 = 8)
SELECT m.frame_id, m."row", m.col, m.stack, m.mask, e AS epoch FROM masks m JOIN stacks s USING (frame_id, stack), range(0, 100) t(e) WHERE e BETWEEN a AND b + 1""")
def j16(spark, sf):
    own = [fxs.layer(spark, sf, 8 + 16 * s).select(*cube.PIXEL, F.lit(s).alias("stack"), (F.col("value") >= 0.3).alias("mask")) for s in range(4)]
    masks = own[0].unionByName(own[1]).unionByName(own[2]).unionByName(own[3])
    stacks = masks.select("frame_id", "stack").distinct().select("frame_id", "stack", (F.col("stack") * 16).alias("start_epoch"), (F.col("stack") * 16 + 14).alias("end_epoch"))
    return cube.expand_epoch_masks(masks, stacks).select(*cube.PIXEL, F.col("stack").cast("long").alias("stack"), "mask", F.col("epoch").cast("long").alias("epoch"))
