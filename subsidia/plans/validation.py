"""Registered queries of requirement validation, GNSS, variograms, comparison and stitching, with their SQL."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from subsidia.functions import columns as fn
from subsidia.operators import changes, compare, cube, gnss, pairs, stitch, validate, variogram
from subsidia.plans import fixtures as fxs
from subsidia.plans.cubes import obs, r9
from subsidia.plans.fixtures import fx

QUERIES, SQL = {}, {}
PIX = 'frame_id, "row", col'
PAIRS = """pairs AS (SELECT a.station AS station_1, b.station AS station_2, sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) / 1000 AS distance,
abs((a.gnss - b.gnss) - (a.insar - b.insar)) AS difference FROM stations a JOIN stations b ON a.station < b.station)"""


def query(name, sql=None):
    def add(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return add


def edge_rows(lo, hi, n):
    e = validate.edges(lo, hi, n)
    return "(VALUES " + ", ".join(f"({i}, {e[i]!r}::DOUBLE, {e[i + 1]!r}::DOUBLE)" for i in range(n)) + ") AS t(bin, bin_lo, bin_hi)"


def binned_sql(source):
    return f""", bins AS (SELECT * FROM {edge_rows(0.1, 50.0, 10)}),
inside AS (SELECT * FROM {source} JOIN bins ON distance > bin_lo AND distance <= bin_hi WHERE difference IS NOT NULL),
counted AS (SELECT coalesce(bin, -1) AS bin, count(*) AS n_total, count(*) FILTER (difference < 5) AS n_pass, quantile_cont(difference, 0.683) AS quantile FROM inside GROUP BY GROUPING SETS ((bin), ())),
frame AS (SELECT * FROM bins UNION ALL SELECT -1, 0.1, 50.0)
SELECT f.bin::INT AS bin, f.bin_lo, f.bin_hi, coalesce(n_total, 0) AS n_total, coalesce(n_pass, 0) AS n_pass, round(quantile, 8) AS quantile, round(n_pass / nullif(n_total, 0), 8) AS pass_ratio, coalesce(n_pass / nullif(n_total, 0) > 0.683, false) AS success
FROM frame f LEFT JOIN counted c ON f.bin = c.bin"""


def rounded_test(df):
    return df.select("bin", "bin_lo", "bin_hi", "n_total", "n_pass", *r9("quantile", "pass_ratio", digits=8), "success")


@query("a12_binned_requirement_test", fx("stations") + f", {PAIRS}" + binned_sql("pairs"))
def a12(spark, sf):
    """Station pairs against 5 mm/yr in ten distance bins."""
    return rounded_test(validate.station_requirement_test(fxs.stations(spark, sf)))


@query("j05_station_pairs", fx("stations") + f", {PAIRS} SELECT station_1, station_2, round(distance, 8) AS distance, round(difference, 8) AS difference FROM pairs")
def j05(spark, sf):
    return validate.station_pairs(fxs.stations(spark, sf)).select("station_1", "station_2", *r9("distance", "difference", digits=8))


@query("a13_sparse_flag", fx("stations") + f", {PAIRS}, k AS (SELECT station_1 AS station, count(*) AS n, count(*) FILTER (difference < 5) AS p FROM pairs GROUP BY 1) SELECT station, n, CASE WHEN n < 20 THEN 'SPARSE' WHEN p / n > 0.683 THEN 'PASSED' ELSE 'FAILED' END AS flag FROM k")
def a13(spark, sf):
    k = pairs.later_within(fxs.stations(spark, sf), 5.0)
    return k.select("station", "n", validate.sparse_flag(F.col("n"), F.col("p") / F.col("n") > 0.683).alias("flag"))


#: Points of a sample, as in production.
PRODUCTION = 1_000_000

SAMPLE = """ranked AS (SELECT *, row_number() OVER (ORDER BY md5('0|' || id), id) - 1 AS rn FROM points),
sample AS (SELECT * FROM ranked WHERE rn < {n}), sampled AS (SELECT rn // 2 AS pair, max(x) FILTER (rn % 2 = 0) AS x_0, max(y) FILTER (rn % 2 = 0) AS y_0, max(v) FILTER (rn % 2 = 0) AS v_0,
max(x) FILTER (rn % 2 = 1) AS x_1, max(y) FILTER (rn % 2 = 1) AS y_1, max(v) FILTER (rn % 2 = 1) AS v_1, count(*) AS n FROM sample GROUP BY 1),
spairs AS (SELECT pair, x_0, y_0, x_1, y_1, sqrt((x_0 - x_1) * (x_0 - x_1) + (y_0 - y_1) * (y_0 - y_1)) / 1000 AS distance, abs(v_0 - v_1) AS difference FROM sampled WHERE n = 2)"""


def unique_points(spark, sf):
    """One point an id; an order may repeat a line number."""
    return fxs.velocity_points(spark, sf).groupBy("id").agg(F.min_by(F.struct("x", "y", "v"), F.struct("x", "y", "v")).alias("p")).select("id", "p.*")


UPOINTS = "upoints AS (SELECT id, arg_min({'x': x, 'y': y, 'v': v}, {'x': x, 'y': y, 'v': v}) AS p FROM points GROUP BY id), one AS (SELECT id, p.x AS x, p.y AS y, p.v AS v FROM upoints)"
USAMPLE = UPOINTS + ", " + SAMPLE.replace("FROM points)", "FROM one)").replace("{n}", str(PRODUCTION))


def production_pairs(spark, sf):
    return validate.sample_pairs(unique_points(spark, sf), PRODUCTION)


@query("w06_sample_pairs", fx("points") + f", {USAMPLE} SELECT pair, round(distance, 8) AS distance, round(difference, 8) AS difference FROM spairs")
def w06(spark, sf):
    return production_pairs(spark, sf).select(F.col("pair").cast("long").alias("pair"), *r9("distance", "difference", digits=8))


@query("w06_pixel_requirement_test", fx("points") + f", {USAMPLE}" + binned_sql("spairs"))
def w06t(spark, sf):
    """Approach 2: random pixel pairs in the same bins."""
    return rounded_test(validate.binned_requirement_test(production_pairs(spark, sf)))


@query("a11_outlier_zscore", fx("points") + """, g AS (SELECT (id % 7)::INT AS frame_id, id, v AS value FROM points), s AS (SELECT frame_id, avg(value) AS m, stddev_pop(value) AS s FROM g GROUP BY 1)
SELECT frame_id, id, count(*) AS n, coalesce(bool_or(abs(value - m) / s > 1.5), false) AS outlier FROM g JOIN s USING (frame_id) GROUP BY ALL""")
def a11(spark, sf):
    g = fxs.velocity_points(spark, sf).select((F.col("id") % 7).cast("int").alias("frame_id"), "id", F.col("v").alias("value"))
    return validate.outlier_mask(g, "zscore", 1.5).groupBy("frame_id", "id").agg(F.count("*").alias("n"), F.bool_or("outlier").alias("outlier"))


@query("a11_outlier_modified", fx("points") + """, g AS (SELECT (id % 7)::INT AS frame_id, id, v AS value FROM points), m AS (SELECT frame_id, median(value) AS m FROM g GROUP BY 1), s AS (SELECT frame_id, m, median(abs(value - m)) AS s FROM g JOIN m USING (frame_id) GROUP BY ALL)
SELECT frame_id, id, count(*) AS n, bool_or(0.6745 * abs(value - m) / s > 1.2) AS outlier FROM g JOIN s USING (frame_id) GROUP BY ALL""")
def a11m(spark, sf):
    g = fxs.velocity_points(spark, sf).select((F.col("id") % 7).cast("int").alias("frame_id"), "id", F.col("v").alias("value"))
    return validate.outlier_mask(g, "modified", 1.2).groupBy("frame_id", "id").agg(F.count("*").alias("n"), F.bool_or("outlier").alias("outlier"))


@query("a19_requirement_limit", fx("stations") + f""", {PAIRS}, d AS (SELECT difference, count(*) OVER () AS n, row_number() OVER (ORDER BY difference) AS k FROM pairs WHERE distance > 0.1 AND distance <= 50)
SELECT round((floor(round(min(difference) / 0.01, 9)) + 1) * 0.01, 9) AS "limit" FROM d WHERE k > n * 0.683""")
def a19(spark, sf):
    return validate.station_requirement_limit(fxs.stations(spark, sf))


def ifg_stations(spark, sf):
    s = fxs.stations(spark, sf).withColumn("ifg", F.explode(F.sequence(F.lit(0), F.lit(5))))
    return s.withColumn("insar", F.col("insar") + (F.col("station") * (F.col("ifg") + 3)) % 11 * 3)


IFG = """s AS (SELECT station, x, y, gnss, insar + (station * (ifg + 3)) % 11 * 3 AS insar, ifg FROM stations, range(0, 6) r(ifg)),
ipairs AS (SELECT a.ifg, sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) / 1000 AS distance, abs((a.gnss - b.gnss) - (a.insar - b.insar)) AS difference FROM s a JOIN s b ON a.ifg = b.ifg AND a.station < b.station)"""
TRANSIENT = f""", {IFG}, bins AS (SELECT * FROM {edge_rows(0.1, 50.0, 10)}),
per AS (SELECT ifg, bin, count(*) AS n_total, count(*) FILTER (difference < 3 * (1 + sqrt(distance))) AS n_pass FROM ipairs JOIN bins ON distance >= bin_lo AND distance < bin_hi GROUP BY ALL),
result AS (SELECT * FROM per UNION ALL SELECT ifg, -1, sum(n_total)::BIGINT, sum(n_pass)::BIGINT FROM per GROUP BY ifg)"""


@query("a20_transient_requirement_test", fx("stations") + TRANSIENT + " SELECT ifg::INT AS ifg, bin::INT AS bin, n_total, n_pass, round(n_pass / n_total, 8) AS pass_ratio, n_pass / n_total > 0.683 AS success FROM result")
def a20(spark, sf):
    return validate.transient_station_test(ifg_stations(spark, sf)).select("ifg", "bin", "n_total", "n_pass", *r9("pass_ratio", digits=8), "success")


@query("a20_stack_verdict", fx("stations") + TRANSIENT + " SELECT count(*) AS n_ifg, count(*) FILTER (n_pass / n_total > 0.683) AS n_pass, round(count(*) FILTER (n_pass / n_total > 0.683) / count(*), 8) AS share, count(*) FILTER (n_pass / n_total > 0.683) / count(*) >= 0.7 AS verdict FROM result WHERE bin = -1")
def a20v(spark, sf):
    return validate.stack_verdict(validate.transient_station_test(ifg_stations(spark, sf))).select("n_ifg", "n_pass", *r9("share", digits=8), "verdict")


@query("a21_bin_variogram", fx("points") + f""", {USAMPLE}, bins AS (SELECT * FROM {edge_rows(0.0, 60.0, 20)}), j AS (SELECT bin, bin_hi, distance, 0.5 * difference * difference AS gamma FROM spairs JOIN bins ON distance >= bin_lo AND (distance < bin_hi OR (bin = 19 AND distance = bin_hi)))
SELECT bin::INT AS bin, round(avg(distance), 7) AS distance, round(avg(gamma), 7) AS gamma, count(*) AS n FROM j GROUP BY bin""")
def a21(spark, sf):
    p = production_pairs(spark, sf).withColumn("gamma", F.expr("0.5 * difference * difference"))
    return variogram.bin_variogram(p, (0.0, 60.0)).select("bin", *r9("distance", "gamma", digits=7), "n")


RANGES = [0.5 * k for k in range(1, 101)]


@query("a22_fit_variogram", fx("points") + f""", {USAMPLE}, p AS (SELECT distance, 0.5 * difference * difference AS gamma FROM spairs WHERE distance <= 50), c AS (SELECT k * 0.5::DOUBLE AS range, 1 - exp(-distance / (k * 0.5)) AS g, gamma FROM p, range(1, 101) r(k)),
s AS (SELECT range, count(*) AS n, sum(g * gamma) AS gy, sum(g * g) AS gg, sum(gamma * gamma) AS yy, sum(g) AS sg, sum(gamma) AS sy FROM c GROUP BY 1)
SELECT range, round(gy / gg, 6) AS sill, round(sqrt((yy - gy * gy / gg) / n), 6) AS rmse, round(sqrt(greatest((yy - gy * gy / gg) / n - ((sy - gy / gg * sg) / n) ^ 2, 0)), 6) AS residual_std FROM s ORDER BY yy - gy * gy / gg, range LIMIT 1""")
def a22(spark, sf):
    p = production_pairs(spark, sf).withColumn("gamma", F.expr("0.5 * difference * difference")).filter("distance <= 50")
    return variogram.fit_variogram(p, RANGES).select("range", *r9("sill", "rmse", "residual_std", digits=6))


@query("j06_pixel_pairs", fx("points") + f""", {UPOINTS}, h AS (SELECT * FROM one ORDER BY md5('0|' || id), id LIMIT 200)
SELECT a.id AS k_1, b.id AS k_2, round(sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) / 1000, 8) AS distance, round(0.5 * (a.v - b.v) * (a.v - b.v), 8) AS gamma FROM h a JOIN h b ON a.id < b.id""")
def j06(spark, sf):
    return variogram.pixel_pairs(unique_points(spark, sf), 200).select("k_1", "k_2", *r9("distance", "gamma", digits=8))


@query("j06_variogram", fx("points") + f""", {UPOINTS}, c AS (SELECT *, floor(x / 10000) AS cx, floor(y / 10000) AS cy FROM one), near AS (SELECT * EXCLUDE (cx, cy), unnest([cx - 1, cx, cx + 1]) AS cx, cy FROM c), around AS (SELECT * EXCLUDE (cy), unnest([cy - 1, cy, cy + 1]) AS cy FROM near),
d AS (SELECT sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) / 1000 AS distance, 0.5 * (a.v - b.v) * (a.v - b.v) AS gamma FROM c a JOIN around b ON a.cx = b.cx AND a.cy = b.cy AND a.id < b.id)
SELECT least(floor(distance), 9)::INT AS bin, count(*) AS n, round(sqrt(avg(distance * distance)), 7) AS distance, round(avg(gamma), 7) AS gamma FROM d WHERE distance <= 10 GROUP BY ALL""")
def j06v(spark, sf):
    """All pairs of pixels up to 10 km apart."""
    return variogram.empirical_variogram(unique_points(spark, sf), (0.0, 10.0), 10).select("bin", "n", *r9("distance", "gamma", digits=7))


@query("p16_distance", fx("stations") + """SELECT station, round(sqrt(x * x + y * y) / 1000, 8) AS plane, round(2 * 6378 * asin(sqrt(sin(radians(y / 1000 - 10) / 2) ^ 2 + cos(radians(10)) * cos(radians(y / 1000)) * sin(radians(x / 1000) / 2) ^ 2)), 6) AS sphere FROM stations""")
def p16(spark, sf):
    s, z = fxs.stations(spark, sf), F.lit(0.0)
    return s.select("station", F.round(fn.plane_km(F.col("x"), F.col("y"), z, z), 8).alias("plane"), F.round(fn.haversine_km(F.lit(10.0), z, F.col("y") / 1000, F.col("x") / 1000), 6).alias("sphere"))


def utm_sql(lat, lon, zone, source):
    """Easting and northing by the published series, coefficients worked out here to the fourth order."""
    f, a = 1 / 298.257223563, 6378137.0
    n = f / (2 - f)
    e, radius = 2 * math.sqrt(n) / (1 + n), a / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    terms = (n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16 + 41 * n**4 / 180, 13 * n**2 / 48 - 3 * n**3 / 5 + 557 * n**4 / 1440, 61 * n**3 / 240 - 103 * n**4 / 140, 49561 * n**4 / 161280)
    series = lambda c, s: " + ".join(f"{x!r}::DOUBLE * {c}({2 * j} * xi) * {s}({2 * j} * eta)" for j, x in enumerate(terms, 1))
    return f"""p AS (SELECT station, {lat} AS lat, radians({lat}) AS phi, radians({lon} - ({zone} * 6 - 183)) AS lam FROM {source}),
t AS (SELECT *, sinh(atanh(sin(phi)) - {e!r}::DOUBLE * atanh({e!r}::DOUBLE * sin(phi))) AS t FROM p), w AS (SELECT *, atan2(t, cos(lam)) AS xi, atanh(sin(lam) / sqrt(1 + t * t)) AS eta FROM t)
SELECT station, round(500000 + {0.9996 * radius!r}::DOUBLE * (eta + {series("cos", "sinh")}), 3) AS easting, round({0.9996 * radius!r}::DOUBLE * (xi + {series("sin", "cosh")}) + CASE WHEN lat < 0 THEN 1e7 ELSE 0 END, 3) AS northing FROM w"""


@query("p15_utm", fx("stations") + ", " + utm_sql("(y / 1000 - 30)", "(x / 10000 - 120)", 11, "stations"))
def p15(spark, sf):
    s = fxs.stations(spark, sf)
    e, n = fn.utm(F.col("y") / 1000 - 30, F.col("x") / 10000 - 120, F.lit(11))
    return s.select("station", F.round(e, 3).alias("easting"), F.round(n, 3).alias("northing"))


@query("p15_utm_inverse", fx("stations") + "SELECT station, round(y / 1000 - 30, 7) AS lat, round(x / 10000 - 120, 7) AS lon FROM stations")
def p15i(spark, sf):
    """To the plane and back, for points of both hemispheres."""
    lat, lon, zone = F.col("y") / 1000 - 30, F.col("x") / 10000 - 120, F.lit(11)
    s = fxs.stations(spark, sf).select("station", (lat < 0).alias("south"), *[c.alias(n) for c, n in zip(fn.utm(lat, lon, zone), ("e", "n"), strict=True)])
    lat, lon = fn.latlon(F.col("e"), F.col("n"), zone, F.col("south"))
    return s.select("station", F.round(lat, 7).alias("lat"), F.round(lon, 7).alias("lon"))


GEODESIC = """, g AS (SELECT station, atan((1 - f) * tan(radians(10))) AS b1, atan((1 - f) * tan(radians(y / 1000))) AS b2, radians(x / 1000) AS l, f FROM stations, (SELECT 1 / 298.257223563::DOUBLE AS f)),
h AS (SELECT *, 2 * asin(sqrt(least(sin((b2 - b1) / 2) ^ 2 + cos(b1) * cos(b2) * sin(l / 2) ^ 2, 1))) AS s, (b1 + b2) / 2 AS p, (b2 - b1) / 2 AS q FROM g)
SELECT station, round(6378.137 * (s - f / 2 * ((s - sin(s)) * sin(p) ^ 2 * cos(q) ^ 2 / cos(s / 2) ^ 2 + (s + sin(s)) * cos(p) ^ 2 * sin(q) ^ 2 / sin(s / 2) ^ 2)), 6) AS km FROM h"""


@query("p16_geodesic", fx("stations") + GEODESIC)
def p16g(spark, sf):
    return fxs.stations(spark, sf).select("station", F.round(fn.geodesic_km(F.lit(10.0), F.lit(0.0), F.col("y") / 1000, F.col("x") / 1000), 6).alias("km"))


VINCENTY = """, p AS (SELECT station, sin(u1) AS s1, cos(u1) AS c1, sin(u2) AS s2, cos(u2) AS c2, l FROM (SELECT station, atan((1 - 1 / 298.257223563::DOUBLE) * tan(radians(10))) AS u1, atan((1 - 1 / 298.257223563::DOUBLE) * tan(radians(y / 1000))) AS u2, radians(x / 1000) AS l FROM stations)),
r(station, s1, c1, s2, c2, l, i, t, f) AS (SELECT station, s1, c1, s2, c2, l, 0, l, 1 / 298.257223563::DOUBLE FROM p UNION ALL SELECT station, s1, c1, s2, c2, l, i + 1,
l + (1 - c) * f * az * (atan2(sine, cosine) + c * sine * (mid + c * cosine * (2 * mid * mid - 1))), f FROM (SELECT *, f / 16 * q * (4 + f * (4 - 3 * q)) AS c, CASE WHEN q > 1e-15 THEN cosine - 2 * s1 * s2 / q ELSE 0 END AS mid FROM (SELECT *, 1 - az * az AS q FROM
(SELECT *, CASE WHEN sine > 0 THEN c1 * c2 * sin(t) / sine ELSE 0 END AS az FROM (SELECT *, sqrt((c2 * sin(t)) ^ 2 + (c1 * s2 - s1 * c2 * cos(t)) ^ 2) AS sine, s1 * s2 + c1 * c2 * cos(t) AS cosine FROM r WHERE i < 24))))),
e AS (SELECT *, CASE WHEN q > 1e-15 THEN cosine - 2 * s1 * s2 / q ELSE 0 END AS mid, q * (1 / (1 - f) ^ 2 - 1) AS w FROM (SELECT *, 1 - az * az AS q FROM (SELECT *, CASE WHEN sine > 0 THEN c1 * c2 * sin(t) / sine ELSE 0 END AS az FROM (SELECT *, sqrt((c2 * sin(t)) ^ 2 + (c1 * s2 - s1 * c2 * cos(t)) ^ 2) AS sine, s1 * s2 + c1 * c2 * cos(t) AS cosine FROM r WHERE i = 24)))),
b AS (SELECT *, 1 + w / 16384 * (4096 + w * (-768 + w * (320 - 175 * w))) AS big, w / 1024 * (256 + w * (-128 + w * (74 - 47 * w))) AS small FROM e)
SELECT station, round(6378.137::DOUBLE * (1 - f) * big * (atan2(sine, cosine) - small * sine * (mid + small / 4 * (cosine * (2 * mid * mid - 1) - small / 6 * mid * (4 * sine * sine - 3) * (4 * mid * mid - 3)))), 6) AS km FROM b"""


@query("p16_geodesic_inverse", fx("stations").replace("WITH ", "WITH RECURSIVE ", 1) + VINCENTY)
def p16i(spark, sf):
    return fxs.stations(spark, sf).select("station", F.round(fn.geodesic_inverse_km(F.lit(10.0), F.lit(0.0), F.col("y") / 1000, F.col("x") / 1000), 6).alias("km"))


LOS = "-sin(radians(40)) * sin(radians(100)) * east + sin(radians(40)) * cos(radians(100)) * north + cos(radians(40)) * up"


@query("p17_los_project", fx("gnss") + f"SELECT station, obs_date, round({LOS}, 9) AS los FROM gnss")
def p17(spark, sf):
    g = fxs.gnss(spark, sf)
    return g.select("station", "obs_date", F.round(fn.los(F.col("east"), F.col("north"), F.col("up"), F.lit(40.0), F.lit(100.0)), 9).alias("los"))


@query("p18_look_angles", fx("cells") + f"""SELECT {PIX}, e, round(degrees(acos(CASE WHEN 1 - x * x - 0.16 >= 0 THEN sqrt(1 - x * x - 0.16) END)), 7) AS incidence, round(degrees(atan2(-x, 0.4)), 7) AS azimuth FROM cells""")
def p18(spark, sf):
    inc, az = fn.look_angles(F.col("x"), F.lit(0.4))
    return fxs._cells(spark, sf).select(*cube.PIXEL, "e", F.round(inc, 7).alias("incidence"), F.round(az, 7).alias("azimuth"))


@query("p19_wrap_phase", fx("components") + """SELECT frame_id, "row", col, round(phase + pi() - floor((phase + pi()) / (2 * pi())) * 2 * pi() - pi(), 7) AS wrapped, round(phase - round_even(phase / (2 * pi()), 0) * 2 * pi(), 7) AS difference FROM components""")
def p19(spark, sf):
    return fxs.components(spark, sf).select(*cube.PIXEL, F.round(fn.wrap(F.col("phase")), 7).alias("wrapped"), F.round(fn.wrapped_difference(F.col("phase")), 7).alias("difference"))


@query("p20_requirement_curve", fx("stations") + f", {PAIRS} SELECT station_1, station_2, round(3 * (1 + sqrt(distance)), 8) AS requirement FROM pairs")
def p20(spark, sf):
    return validate.station_pairs(fxs.stations(spark, sf)).select("station_1", "station_2", F.round(fn.requirement_mm(F.col("distance")), 8).alias("requirement"))


@query("a26_temporal_sampling", fx("products") + """, d AS (SELECT DISTINCT frame_id, sec_date AS obs_date FROM products), g AS (SELECT *, date_diff('day', lag(obs_date) OVER (PARTITION BY frame_id ORDER BY obs_date), obs_date) AS gap FROM d)
SELECT frame_id, round(avg((gap <= 1)::INT), 8) AS share, round(date_diff('day', min(obs_date), max(obs_date)) / 365.25, 8) AS years, avg((gap <= 1)::INT) >= 0.8 AND date_diff('day', min(obs_date), max(obs_date)) / 365.25 >= 4 AS success FROM g GROUP BY 1""")
def a26(spark, sf):
    d = fxs.products(spark, sf).select("frame_id", F.col("sec_date").alias("obs_date"))
    return validate.temporal_sampling(d, gap_days=1).select("frame_id", *r9("share", "years", digits=8), "success")


@query("a33_pass_rate_summary", fx("summary") + """, s AS (SELECT 'va1' AS approach, va1 AS label FROM summary UNION ALL SELECT 'va2', va2 FROM summary)
SELECT approach, count(*) FILTER (label = 'PASS') AS n_pass, count(*) AS n, round(100 * count(*) FILTER (label = 'PASS') / count(*))::INT AS percent FROM s WHERE label IN ('PASS', 'FAIL') GROUP BY 1""")
def a33(spark, sf):
    return validate.pass_rates(fxs.summary(spark, sf))


@query("a36_station_residuals", fx("stations") + """, s AS (SELECT station, gnss, CASE WHEN station % 9 <> 4 THEN insar END AS insar FROM stations), r AS (SELECT gnss AS g, coalesce(insar, 0) AS i FROM s WHERE station = 7)
SELECT station, round(gnss - g, 8) AS gnss, round(insar - i, 8) AS insar, round((gnss - g) - (insar - i), 8) AS residual, insar IS NOT NULL AS used FROM s, r""")
def a36(spark, sf):
    s = fxs.stations(spark, sf).withColumn("insar", F.when(F.col("station") % 9 != 4, F.col("insar")))
    return validate.station_residuals(s, 7).select("station", *r9("gnss", "insar", "residual", digits=8), "used")


@query("a23_station_completeness", fx("gnss") + """SELECT station, count(*) AS n_days, count(*) >= date_diff('day', DATE '2024-01-03', DATE '2024-01-28') * 0.8 AS complete FROM gnss WHERE obs_date BETWEEN DATE '2024-01-03' AND DATE '2024-01-28' GROUP BY 1""")
def a23(spark, sf):
    return gnss.completeness(fxs.gnss(spark, sf), "2024-01-03", "2024-01-28")


@query("a23_station_density", fx("gnss") + """SELECT station, round(count(*) / nullif(date_diff('day', min(obs_date), max(obs_date)), 0), 9) AS density, coalesce(count(*) / nullif(date_diff('day', min(obs_date), max(obs_date)), 0) > 0.9, false) AS dense FROM gnss GROUP BY 1""")
def a23d(spark, sf):
    s = fxs.gnss(spark, sf).groupBy("station").agg(F.count("*").alias("num_solution"), F.min("obs_date").alias("first_date"), F.max("obs_date").alias("last_date"))
    return gnss.solution_density(s, 0.9).select("station", *r9("density"), "dense")


@query("a23_station_coverage", fx("gnss") + """, g AS (SELECT station, count(*) AS n, date_diff('day', min(obs_date), max(obs_date)) AS span FROM gnss WHERE obs_date > DATE '2024-01-03' AND obs_date < DATE '2024-01-28' GROUP BY 1)
SELECT station, round(n / nullif(span, 0), 9) AS density, round(span / 25, 9) AS ratio, coalesce(n / nullif(span, 0) >= 0.9 AND span / 25 >= 0.85, false) AS covered FROM g""")
def a23c(spark, sf):
    return gnss.coverage(fxs.gnss(spark, sf), "2024-01-03", "2024-01-28", 0.9, 0.85).select("station", *r9("density", "ratio"), "covered")


@query("p17_mean_geometry", fx("cells") + """SELECT frame_id, round(avg(x * 300), 8) AS incidence, round(avg(x * 2000 + e), 8) AS azimuth, count(*) AS n FROM cells WHERE x * 300 > 0 AND x * 300 <= 90 AND x * 2000 + e BETWEEN -360 AND 360 GROUP BY 1""")
def p17g(spark, sf):
    angles = fxs._cells(spark, sf).select("frame_id", (F.col("x") * 300).alias("incidence"), (F.col("x") * 2000 + F.col("e")).alias("azimuth"))
    return gnss.mean_geometry(angles).select("frame_id", *r9("incidence", "azimuth", digits=8), "n")


@query("p17_projectable", fx("gnss") + """, g AS (SELECT station, obs_date, CASE WHEN station % 3 = 0 AND day(obs_date) > 3 THEN NULL ELSE east END AS east, north, up FROM gnss), k AS (SELECT * FROM g WHERE east IS NOT NULL AND north IS NOT NULL AND up IS NOT NULL)
SELECT station, count(*) AS n, round(sum(east), 8) AS east FROM k GROUP BY 1 HAVING count(DISTINCT obs_date) >= 2""")
def p17p(spark, sf):
    g = fxs.gnss(spark, sf).withColumn("east", F.when(~((F.col("station") % 3 == 0) & (F.dayofmonth("obs_date") > 3)), F.col("east")))
    return gnss.projectable(g).groupBy("station").agg(F.count("*").alias("n"), F.round(F.sum("east"), 8).alias("east"))


@query("a24_station_scatter", fx("gnss") + f""", v AS (SELECT station, {LOS} AS v, row_number() OVER (PARTITION BY station ORDER BY obs_date)::DOUBLE AS k FROM gnss WHERE {LOS} IS NOT NULL)
SELECT station, count(*) AS n, round(sqrt(greatest(regr_syy(v, k) - coalesce(regr_sxy(v, k) ^ 2 / nullif(regr_sxx(v, k), 0), 0), 0) / count(*)), 7) AS scatter, sqrt(greatest(regr_syy(v, k) - coalesce(regr_sxy(v, k) ^ 2 / nullif(regr_sxx(v, k), 0), 0), 0) / count(*)) <= 10 AS kept FROM v GROUP BY 1""")
def a24(spark, sf):
    return gnss.scatter(fxs.gnss(spark, sf)).select("station", "n", *r9("scatter", digits=7), "kept")


@query("a25_problem_steps", fx("steps") + """SELECT DISTINCT station, step_date FROM steps WHERE step_date >= DATE '2024-01-02' AND step_date <= DATE '2024-01-25'
AND ((code = 1 AND type_threshold IN ('Antenna_detached_from_monument', 'Equipment_Site_Change', 'Antenna_Changed', 'Antenna_change', 'Antenna_Code_Changed')) OR (code = 2 AND magnitude > 1 AND distance_km <= 40))""")
def a25(spark, sf):
    return gnss.problem_steps(fxs.steps(spark, sf), "2024-01-02", "2024-01-25", 1.0, 40.0)


@query("j03_exclude_stations", fx("gnss", "steps") + "SELECT DISTINCT station FROM gnss WHERE station NOT IN (SELECT station FROM steps WHERE magnitude >= 4 AND code = 2) AND station % 10 <> 3")
def j03(spark, sf):
    g = fxs.gnss(spark, sf).select("station").distinct()
    bad = fxs.steps(spark, sf).filter("magnitude >= 4 AND code = 2").select("station")
    return gnss.exclude(g, bad, g.filter("station % 10 = 3"))


@query("u03_removed_stations", fx("gnss", "steps") + "SELECT DISTINCT station FROM gnss EXCEPT SELECT station FROM steps WHERE code = 1")
def u03(spark, sf):
    g = fxs.gnss(spark, sf).select("station").distinct()
    return gnss.exclude(g, fxs.steps(spark, sf).filter("code = 1").select("station"))


def frames(spark):
    rows = [(f, "A", [(x, y), (x + 20.0, y + 3.0), (x + 24.0, y + 18.0), (x + 5.0, y + 25.0), (x, y)]) for f, (x, y) in enumerate([(0.0, 0.0), (15.0, 10.0), (30.0, 30.0), (5.0, 35.0)])]
    return spark.createDataFrame(rows, "frame_id int, orbit_pass string, ring array<struct<lon double, lat double>>")


RINGS = """frames AS (SELECT * FROM (VALUES (0, 0.0, 0.0), (1, 15.0, 10.0), (2, 30.0, 30.0), (3, 5.0, 35.0)) t(frame_id, x, y)),
sides AS (SELECT frame_id, i, x + [0, 20, 24, 5, 0][i] AS ax, y + [0, 3, 18, 25, 0][i] AS ay, x + [0, 20, 24, 5, 0][i + 1] AS bx, y + [0, 3, 18, 25, 0][i + 1] AS "by" FROM frames, range(1, 5) r(i))"""


@query("j02_stations_in_frame", fx("stations") + f""", {RINGS} SELECT frame_id, station FROM (SELECT station, x / 1000 AS lon, y / 1000 AS lat FROM stations) s, sides GROUP BY frame_id, station
HAVING sum(CASE WHEN (ay > lat) <> ("by" > lat) AND lon < (bx - ax) * (lat - ay) / ("by" - ay) + ax THEN 1 ELSE 0 END) % 2 = 1""")
def j02(spark, sf):
    s = fxs.stations(spark, sf).select("station", (F.col("x") / 1000).alias("lon"), (F.col("y") / 1000).alias("lat"))
    return gnss.stations_in_frame(s, frames(spark))


def touching_sql(corners):
    """Frames of the derived rings that meet a polygon: a corner of one inside the other, or crossing sides."""
    n = len(corners)
    sides = ", ".join(f"({i}, {corners[i][0]}, {corners[i][1]}, {corners[(i + 1) % n][0]}, {corners[(i + 1) % n][1]})" for i in range(n))
    ray = lambda s, x, y: f"sum(CASE WHEN ({s}.ay > {y}) <> ({s}.\"by\" > {y}) AND {x} < ({s}.bx - {s}.ax) * ({y} - {s}.ay) / ({s}.\"by\" - {s}.ay) + {s}.ax THEN 1 ELSE 0 END) % 2 = 1"
    turn = lambda a, b, c: f"sign(({b[0]} - {a[0]}) * ({c[1]} - {a[1]}) - ({b[1]} - {a[1]}) * ({c[0]} - {a[0]}))"
    a, b, x, u = ("f.ax", "f.ay"), ("f.bx", 'f."by"'), ("p.ax", "p.ay"), ("p.bx", 'p."by"')
    cross = f"{turn(a, b, x)} * {turn(a, b, u)} <= 0 AND {turn(x, u, a)} * {turn(x, u, b)} <= 0 AND greatest(f.ax, f.bx) >= least(p.ax, p.bx) AND least(f.ax, f.bx) <= greatest(p.ax, p.bx) AND greatest(f.ay, f.\"by\") >= least(p.ay, p.\"by\") AND least(f.ay, f.\"by\") <= greatest(p.ay, p.\"by\")"
    return f""", rings AS (SELECT station::INT AS frame_id, x / 1000 AS x, y / 1000 AS y FROM stations WHERE station % 2 = 0),
f AS (SELECT frame_id, i, x + [0, 4, 5, 1, 0][i] AS ax, y + [0, 1, 5, 4, 0][i] AS ay, x + [0, 4, 5, 1, 0][i + 1] AS bx, y + [0, 1, 5, 4, 0][i + 1] AS "by" FROM rings, range(1, 5) r(i)),
p AS (SELECT * FROM (VALUES {sides}) t(i, ax, ay, bx, "by")),
found AS (SELECT frame_id FROM f, p WHERE {cross} UNION SELECT frame_id FROM (SELECT f.frame_id, f.i FROM f, p GROUP BY f.frame_id, f.i, f.ax, f.ay HAVING {ray("p", "f.ax", "f.ay")})
UNION SELECT frame_id FROM (SELECT f.frame_id, p.i FROM f, p GROUP BY f.frame_id, p.i, p.ax, p.ay HAVING {ray("f", "p.ax", "p.ay")})) SELECT frame_id FROM found"""


AREA = [(10.0, 20.0), (30.0, 15.0), (42.0, 33.0), (25.0, 28.0), (18.0, 45.0)]


@query("j01_frames_polygon", fx("stations") + touching_sql(AREA))
def j01p(spark, sf):
    return gnss.frames_touching(station_frames(spark, sf), AREA, "ascending").select("frame_id")


@query("j01_frames_select", fx("stations") + touching_sql([(10.0, 20.0), (30.0, 20.0), (30.0, 45.0), (10.0, 45.0)]))
def j01(spark, sf):
    return gnss.frames_touching(station_frames(spark, sf), gnss.rectangle((10.0, 30.0), (20.0, 45.0)), "ASCENDING").select("frame_id")


def station_frames(spark, sf):
    s = fxs.stations(spark, sf)
    ring = F.array(*[F.struct((F.col("x") / 1000 + dx).alias("lon"), (F.col("y") / 1000 + dy).alias("lat")) for dx, dy in ((0, 0), (4, 1), (5, 5), (1, 4), (0, 0))])
    return s.select(F.col("station").cast("int").alias("frame_id"), F.when(F.col("station") % 2 == 0, "ASCENDING").otherwise("DESCENDING").alias("orbit_pass"), ring.alias("ring"))


#: Stations and points spread over all frames; a frame has 20 rows.
FRAMES = "n_frames AS (SELECT max(frame_id) + 1 AS n FROM cells)"
SPREAD = FRAMES + """, spread AS (SELECT station, (station % n)::INT AS frame_id, (station % n * 20 + station * 7 % 20)::INT AS "row", (station * 11 % 25)::INT AS col FROM stations, n_frames)"""


def over_frames(spark, sf, points, key):
    """``points`` with the frame of each: its key modulo the number of frames (one row, so joining it is no cross join of data)."""
    n = fxs.table(spark, sf, "embeddings").agg((F.expr("cast(max(vec_id) div 500 as int)") + 1).alias("n"))
    return points.crossJoin(F.broadcast(n)).withColumn("frame_id", (F.col(key) % F.col("n")).cast("int")).drop("n")


def spread(spark, sf):
    s = over_frames(spark, sf, fxs.stations(spark, sf), "station")
    return s.select("frame_id", "station", (F.col("frame_id") * 20 + F.col("station") * 7 % 20).cast("int").alias("row"), (F.col("station") * 11 % 25).cast("int").alias("col"))


LAYER0 = 'layer AS (SELECT frame_id, "row", col, least(1.0::DOUBLE, abs(x) * 4) AS value FROM cells WHERE e = 10)'


@query("j04_station_pixel_sample", fx("cells", "stations") + f""", {LAYER0}, {SPREAD} SELECT s.frame_id, station, round(median(value), 8) AS value FROM spread s JOIN layer l ON l.frame_id = s.frame_id AND l."row" BETWEEN s."row" - 2 AND s."row" + 2 AND l.col BETWEEN s.col - 2 AND s.col + 2 GROUP BY ALL""")
def j04(spark, sf):
    return gnss.sample_at_stations(spread(spark, sf), fxs.layer(spark, sf, 10), 2).select("frame_id", "station", *r9("value", digits=8))


@query("w09_align_series", fx("gnss") + """, m AS (SELECT station, median(east) AS m FROM gnss GROUP BY 1), g AS (SELECT station, obs_date, east - m AS gnss, north AS insar FROM gnss JOIN m USING (station)), s AS (SELECT station, median(insar - gnss) AS s FROM g GROUP BY 1)
SELECT station, obs_date, round(gnss, 8) AS gnss, round(insar - s, 8) AS insar FROM g JOIN s USING (station)""")
def w09(spark, sf):
    g = fxs.gnss(spark, sf)
    return gnss.align_series(g.select("station", "obs_date", F.col("east").alias("value")), g.select("station", "obs_date", F.col("north").alias("value"))).select("station", "obs_date", *r9("gnss", "insar", digits=8))


@query("w11_detect_steps", fx("gnss") + """, d AS (SELECT *, abs(east - lag(east) OVER w) AS d, avg(east) OVER (w ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING) AS b, avg(east) OVER (w ROWS BETWEEN CURRENT ROW AND 9 FOLLOWING) AS a, avg(east) OVER (w ROWS BETWEEN 10 FOLLOWING AND 19 FOLLOWING) AS nx FROM gnss WINDOW w AS (PARTITION BY station ORDER BY obs_date)),
s AS (SELECT *, stddev_pop(d) OVER (PARTITION BY station) AS sd, coalesce(lag(d) OVER w, -1) AS dl, coalesce(lead(d) OVER w, -1) AS dn FROM d WINDOW w AS (PARTITION BY station ORDER BY obs_date))
SELECT station, obs_date, round(abs(a - b) / nullif(abs(b), 0), 7) AS change, CASE WHEN abs(nx - a) / nullif(abs(a), 0) < 0.05 THEN 'stair' ELSE 'step' END AS kind FROM s WHERE d >= 2 * sd AND d > dl AND d >= dn AND abs(a - b) / nullif(abs(b), 0) > 0.1""")
def w11(spark, sf):
    return gnss.detect_steps(fxs.gnss(spark, sf)).select("station", "obs_date", *r9("change", digits=7), "kind")


@query("w11_change_points")
def w11c(spark, sf):
    """Where the east series of a station changes its level, by pruned dynamic programming."""
    return changes.station_change_points(fxs.gnss(spark, sf))


@query("w11_step_features")
def w11f(spark, sf):
    return changes.step_features(fxs.gnss(spark, sf), skip_first=False).select("station", "obs_date", "kind", *r9("change", digits=7))


def ifgs(spark):
    return spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate([("2024-01-03", "2024-01-06"), ("2024-01-10", "2024-01-15"), ("2024-01-02", "2024-01-28")])], "ifg int, a string, b string").select("ifg", F.to_date("a").alias("ref_date"), F.to_date("b").alias("sec_date"))


IFGS = """ifgs AS (SELECT * FROM (VALUES (0, DATE '2024-01-03', DATE '2024-01-06'), (1, DATE '2024-01-10', DATE '2024-01-15'), (2, DATE '2024-01-02', DATE '2024-01-28')) t(ifg, ref_date, sec_date)),
full_ AS (SELECT ifg, station, ref_date, sec_date, count(*) AS n FROM gnss JOIN ifgs ON obs_date BETWEEN ref_date AND sec_date GROUP BY ALL HAVING count(*) = date_diff('day', ref_date, sec_date) + 1),
chosen AS (SELECT *, count(*) OVER (PARTITION BY ifg) AS n_stations FROM full_ QUALIFY count(*) OVER (PARTITION BY ifg) >= 3)"""


@query("w12_transient_stations", fx("gnss") + f", {IFGS} SELECT ifg, station, n_stations FROM chosen")
def w12(spark, sf):
    return gnss.transient_stations(fxs.gnss(spark, sf), ifgs(spark))


@query("w13_transient_displacement", fx("gnss") + f""", {IFGS}, d AS (SELECT ifg, station, arg_max(up, obs_date) - arg_min(up, obs_date) AS d FROM gnss JOIN chosen USING (station) WHERE obs_date BETWEEN ref_date AND sec_date GROUP BY ALL),
r AS (SELECT ifg, arg_min(d, md5('0|' || ifg || '|' || station)) AS r FROM d GROUP BY 1) SELECT ifg, station, round(d, 8) AS displacement, round(d - r, 8) AS relative FROM d JOIN r USING (ifg)""")
def w13(spark, sf):
    g, p = fxs.gnss(spark, sf), ifgs(spark)
    return gnss.transient_displacement(g, gnss.transient_stations(g, p).drop("n_stations"), p, F.col("up")).select("ifg", "station", *r9("displacement", "relative", digits=8))


BOTH = 'both_ AS (SELECT a.frame_id, a."row", a.col, a.obs_date, a.value, b.value AS other FROM obs a JOIN obs_b b USING (frame_id, "row", col, obs_date))'


def both(spark, sf):
    return compare.common_dates(obs(spark, sf), obs(spark, sf, "B"))


@query("j07_common_date_join", fx("obs", "obs_b") + f", {BOTH} SELECT {PIX}, obs_date, round(value, 9) AS value, round(other, 9) AS other FROM both_")
def j07(spark, sf):
    return both(spark, sf).select(*cube.PIXEL, "obs_date", *r9("value", "other"))


@query("j07_common_reference_date", fx("obs", "obs_b") + "SELECT frame_id, min(obs_date) AS reference_date FROM obs SEMI JOIN obs_b USING (frame_id, obs_date) GROUP BY 1")
def j07r(spark, sf):
    return compare.common_reference_date(obs(spark, sf), obs(spark, sf, "B"))


@query("j08_version_compare", fx("obs", "obs_b") + f", {BOTH} SELECT {PIX}, obs_date, round(value, 9) AS value, round(other, 9) AS other FROM both_ WHERE value <> 0 AND other <> 0")
def j08(spark, sf):
    return compare.version_compare(obs(spark, sf), obs(spark, sf, "B")).select(*cube.PIXEL, "obs_date", *r9("value", "other"))


@query("j09_cube_difference", fx("obs", "obs_b") + f", {BOTH} SELECT frame_id, obs_date, round(avg((value - other) * 1000), 7) AS mean_mm, count(*) AS n FROM both_ WHERE value <> 0 AND other <> 0 GROUP BY ALL")
def j09(spark, sf):
    return compare.cube_difference(obs(spark, sf), obs(spark, sf, "B")).select("frame_id", "obs_date", *r9("mean_mm", digits=7), "n")


@query("a14_series_stats", fx("obs", "obs_b") + f""", {BOTH}, d AS (SELECT *, value - other AS d, median(value - other) OVER (PARTITION BY {PIX}) AS m FROM both_ WHERE value IS NOT NULL AND other IS NOT NULL)
SELECT {PIX}, count(*) AS n, round(sqrt(avg(d * d)), 8) AS rmse, round(median(abs(d - m)), 8) AS mad, round(corr(value, other), 6) AS r FROM d GROUP BY {PIX}""")
def a14(spark, sf):
    return compare.series_stats(both(spark, sf)).select(*cube.PIXEL, "n", *r9("rmse", "mad", digits=8), F.round("r", 6).alias("r"))


@query("a15_window_mean_series", fx("obs", "obs_b", "stations") + f""", {BOTH}, {SPREAD}, ok AS (SELECT * FROM both_ WHERE value <> 0 AND other <> 0), pts AS (SELECT station AS pid, frame_id AS f, "row" AS r, col AS c FROM spread SEMI JOIN ok USING (frame_id, "row", col))
SELECT pid, obs_date, round(avg(value), 8) AS value, round(avg(other), 8) AS other, count(*) AS n FROM pts JOIN ok ON frame_id = f AND "row" BETWEEN r - 3 AND r + 3 AND col BETWEEN c - 3 AND c + 3 GROUP BY ALL""")
def a15(spark, sf):
    return compare.window_mean_series(spread(spark, sf).withColumnRenamed("station", "pid"), obs(spark, sf), obs(spark, sf, "B")).select("pid", "obs_date", *r9("value", "other", digits=8), "n")


@query("a15_window_mean_series_zeroed", fx("obs", "obs_b", "stations") + f""", {SPREAD}, la AS (SELECT * FROM obs WHERE obs_date > DATE '2016-07-01'), lb AS (SELECT * FROM obs_b WHERE obs_date > DATE '2016-07-01'),
za AS (SELECT frame_id, "row", col, value AS z FROM la WHERE obs_date = (SELECT min(obs_date) FROM la l WHERE l.frame_id = la.frame_id)), zb AS (SELECT frame_id, "row", col, value AS z FROM lb WHERE obs_date = (SELECT min(obs_date) FROM lb l WHERE l.frame_id = lb.frame_id)),
ok AS (SELECT a.frame_id, a."row", a.col, a.obs_date, a.value - coalesce(za.z, 0) AS value, b.value - coalesce(zb.z, 0) AS other FROM la a JOIN lb b USING (frame_id, "row", col, obs_date) LEFT JOIN za USING (frame_id, "row", col) LEFT JOIN zb USING (frame_id, "row", col) WHERE a.value - coalesce(za.z, 0) <> 0 AND b.value - coalesce(zb.z, 0) <> 0),
pts AS (SELECT station AS pid, frame_id AS f, "row" AS r, col AS c FROM spread SEMI JOIN ok USING (frame_id, "row", col))
SELECT pid, obs_date, round(avg(value), 8) + 0.0::DOUBLE AS value, round(avg(other), 8) + 0.0::DOUBLE AS other, count(*) AS n FROM pts JOIN ok ON frame_id = f AND "row" BETWEEN r - 3 AND r + 3 AND col BETWEEN c - 3 AND c + 3 GROUP BY ALL""")
def a15z(spark, sf):
    """Series begin after the first epoch, which holds no data."""
    late = lambda v: obs(spark, sf, v).filter(F.col("obs_date") > F.lit("2016-07-01").cast("date"))
    w = compare.window_mean_series(spread(spark, sf).withColumnRenamed("station", "pid"), late("A"), late("B"), zero_first=True)
    return w.select("pid", "obs_date", *[(F.round(c, 8) + F.lit(0.0)).alias(c) for c in ("value", "other")], "n")


GRIDS = """n AS (SELECT frame_id, 20 * (frame_id + 1) AS rows FROM cells GROUP BY 1),
target AS (SELECT frame_id, r::INT AS "row", c::INT AS col, 10 + (c + 0.5) * 20 AS x, -10 - (r + 0.5) * 20 AS y FROM n, range(0, 25) t(c), LATERAL (SELECT unnest(range(0, 20 * (frame_id + 1))) AS r)),
at_ AS (SELECT *, floor(-y / 30)::INT AS ar, floor(x / 30)::INT AS ac FROM target)"""


@query("j09_snapped_difference", fx("obs", "obs_b") + f""", {GRIDS} SELECT t.frame_id, t."row", t.col, a.obs_date, round(a.value - b.value, 9) + 0.0::DOUBLE AS difference
FROM at_ t JOIN obs a ON a.frame_id = t.frame_id AND a."row" = ar AND a.col = ac JOIN obs_b b ON b.frame_id = t.frame_id AND b."row" = t."row" AND b.col = t.col AND b.obs_date = a.obs_date WHERE a.value <> 0 AND b.value <> 0""")
def j09s(spark, sf):
    """A grid of 30 m against one of 20 m that begins elsewhere."""
    a, b = obs(spark, sf), obs(spark, sf, "B")
    grid = lambda x, y, d: a.select("frame_id").distinct().select("frame_id", F.lit(x).alias("x_first"), F.lit(y).alias("y_first"), F.lit(d).alias("x_step"), F.lit(-d).alias("y_step"), (F.col("frame_id") * 20 + 20).alias("length"), F.lit(25).alias("width"))
    d = compare.snapped_difference(a, grid(0.0, 0.0, 30.0), b, grid(10.0, -10.0, 20.0))
    return d.select(*cube.PIXEL, "obs_date", (F.round("difference", 9) + F.lit(0.0)).alias("difference"))


SPAN = """, w AS (SELECT min(d) AS lo, (max(d) - min(d)) / 20 AS width, avg(d) AS mean FROM v), h AS (SELECT least(floor((d - lo) / width), 19)::INT AS bin, count(*) AS n FROM v, w GROUP BY 1)
SELECT b::INT AS bin, round(lo + b * width, 7) AS bin_lo, coalesce(n, 0) AS n"""


@query("a17_data_histogram", fx("cells") + ", v AS (SELECT x AS d FROM cells WHERE x <> 0)" + SPAN + " FROM range(0, 20) r(b) CROSS JOIN w LEFT JOIN h ON b = bin")
def a17d(spark, sf):
    """Raw counts over the span of the data."""
    return compare.histogram(fxs._cells(spark, sf).select(F.col("x").alias("value")), None, normalised=False).select("bin", *r9("bin_lo", digits=7), "n")


@query("a18_difference_histogram", fx("obs", "obs_b") + f", {BOTH}, v AS (SELECT (value - other) * 100 AS d FROM both_ WHERE value IS NOT NULL AND other IS NOT NULL)" + SPAN + ", round(mean, 7) AS mean FROM range(0, 20) r(b) CROSS JOIN w LEFT JOIN h ON b = bin")
def a18h(spark, sf):
    return compare.difference_histogram(both(spark, sf)).select("bin", *r9("bin_lo", digits=7), "n", F.round("mean", 7).alias("mean"))


@query("a16_ranges", fx("obs", "obs_b") + """, u AS (SELECT version, layer, value FROM obs UNION ALL SELECT version, layer, value FROM obs_b) SELECT version, layer, round(min(value) * 100, 7) AS low, round(max(value) * 100, 7) AS high FROM u GROUP BY GROUPING SETS ((version, layer), (layer))""")
def a16(spark, sf):
    return compare.ranges(obs(spark, sf).unionByName(obs(spark, sf, "B")), 100.0).select("version", "layer", *r9("low", "high", digits=7))


@query("a17_density_histogram", fx("cells") + """, l AS (SELECT least(1.0::DOUBLE, abs(x) * 4) AS value FROM cells), h AS (SELECT least(floor((value - 0) / 0.05), 19)::INT AS bin, count(*) AS n FROM l WHERE value <> 0 AND value BETWEEN 0 AND 1 GROUP BY 1)
SELECT b::INT AS bin, round(b * 0.05, 9) AS bin_lo, coalesce(n, 0) AS n, round(coalesce(n, 0) / (sum(n) OVER () * 0.05), 7) AS density FROM range(0, 20) r(b) LEFT JOIN h ON b = bin""")
def a17(spark, sf):
    v = fxs._cells(spark, sf).select(F.least(F.lit(1.0), F.abs("x") * 4).alias("value"))
    return compare.histogram(v, (0.0, 1.0)).select("bin", *r9("bin_lo"), "n", F.round("density", 7).alias("density"))


@query("a18_difference_summary", fx("obs", "obs_b") + f", {BOTH} SELECT frame_id, round(avg(value - other), 9) AS mean, count(*) AS n FROM both_ WHERE value IS NOT NULL AND other IS NOT NULL AND obs_date > (SELECT min(obs_date) FROM both_ b WHERE b.frame_id = both_.frame_id AND b.value IS NOT NULL AND b.other IS NOT NULL) GROUP BY 1")
def a18(spark, sf):
    return compare.difference_summary(both(spark, sf), skip_first=True).select("frame_id", *r9("mean"), "n")


@query("w10_align_second_valid", fx("obs", "obs_b") + f""", {BOTH}, s AS (SELECT {PIX}, value - other AS s FROM both_ WHERE value IS NOT NULL AND other IS NOT NULL QUALIFY row_number() OVER (PARTITION BY {PIX} ORDER BY obs_date) = 2)
SELECT {PIX}, obs_date, round(value, 9) AS value, round(other + coalesce(s, 0), 9) + 0.0::DOUBLE AS other FROM both_ LEFT JOIN s USING (frame_id, "row", col)""")
def w10(spark, sf):
    return compare.align_second_valid(both(spark, sf)).select(*cube.PIXEL, "obs_date", *r9("value"), (F.round("other", 9) + F.lit(0.0)).alias("other"))


@query("u01_common_dates", fx("obs", "obs_b") + "SELECT frame_id, obs_date FROM obs INTERSECT SELECT frame_id, obs_date FROM obs_b")
def u01(spark, sf):
    return obs(spark, sf).select("frame_id", "obs_date").intersect(obs(spark, sf, "B").select("frame_id", "obs_date"))


#: Version A has no data on pixels of the labels 0 to 2, version B on those of 8 and 9.
SPARSER = f"""land AS (SELECT {PIX}, any_value(label) AS label FROM cells GROUP BY ALL),
va AS (SELECT {PIX} FROM obs JOIN land USING (frame_id, "row", col) WHERE label > 2 GROUP BY ALL HAVING bool_or(value <> 0)), vb AS (SELECT {PIX} FROM obs_b JOIN land USING (frame_id, "row", col) WHERE label < 8 GROUP BY ALL HAVING bool_or(value <> 0)),
sizes AS (SELECT frame_id, 0 AS v, count(*) AS n FROM va GROUP BY 1 UNION ALL SELECT frame_id, 1, count(*) FROM vb GROUP BY 1), pick AS (SELECT frame_id, arg_min(v, n * 2 + v) AS v FROM sizes GROUP BY 1),
pool AS (SELECT *, 0 AS v FROM va UNION ALL SELECT *, 1 FROM vb), cand AS (SELECT p.frame_id, p."row", p.col, row_number() OVER (PARTITION BY p.frame_id ORDER BY md5('0|' || p.frame_id || '|' || p."row" || '|' || p.col), p."row", p.col) AS rank FROM pool p JOIN pick USING (frame_id, v))"""


def land(spark, sf, v="A"):
    label = fxs.layer(spark, sf, 0).select(*cube.PIXEL, "label")
    return obs(spark, sf, v).join(label, cube.PIXEL).withColumn("value", F.when(F.col("label") > 2 if v == "A" else F.col("label") < 8, F.col("value"))).drop("label")


@query("t03_candidate_points", fx("obs", "obs_b") + f", {SPARSER} SELECT {PIX}, rank::INT AS rank FROM cand WHERE rank <= 200")
def t03(spark, sf):
    return compare.candidate_points(land(spark, sf), land(spark, sf, "B"))


@query("t04_points_with_fallback", fx("obs", "obs_b", "stations") + f""", {SPARSER}, {SPREAD}, req AS (SELECT station AS pid, frame_id, "row", col FROM spread)
SELECT pid, r.frame_id, CASE WHEN a."row" IS NOT NULL THEN r."row" ELSE c."row" END AS "row", CASE WHEN a."row" IS NOT NULL THEN r.col ELSE c.col END AS col, a."row" IS NULL AS moved
FROM req r LEFT JOIN va a ON r.frame_id = a.frame_id AND r."row" = a."row" AND r.col = a.col LEFT JOIN cand c ON c.frame_id = r.frame_id AND c.rank = 1""")
def t04(spark, sf):
    req = spread(spark, sf).withColumnRenamed("station", "pid")
    return compare.points_with_fallback(req, land(spark, sf), compare.candidate_points(land(spark, sf), land(spark, sf, "B")))


@query("t04_points_moved", fx("obs", "obs_b", "stations") + f""", {SPARSER}, {SPREAD}, req AS (SELECT station AS pid, frame_id, "row", col FROM spread)
SELECT pid, a."row" IS NULL AND (abs(c."row" - r."row") * 0.0002::DOUBLE > 1e-3 OR abs(c.col - r.col) * 0.0002::DOUBLE > 1e-3) AS moved
FROM req r LEFT JOIN va a ON r.frame_id = a.frame_id AND r."row" = a."row" AND r.col = a.col LEFT JOIN cand c ON c.frame_id = r.frame_id AND c.rank = 1""")
def t04m(spark, sf):
    """A replaced point counts as moved from a thousandth of a degree on."""
    req = spread(spark, sf).withColumnRenamed("station", "pid")
    return compare.points_with_fallback(req, land(spark, sf), compare.candidate_points(land(spark, sf), land(spark, sf, "B")), step=(-0.0002, 0.0002)).select("pid", "moved")


@query("t02_order_pairs", fx("stations") + f", {PAIRS} SELECT station_1, station_2, row_number() OVER (PARTITION BY station_1 ORDER BY distance, station_2)::INT AS rank FROM pairs")
def t02(spark, sf):
    from pyspark.sql import Window

    p = validate.station_pairs(fxs.stations(spark, sf))
    return p.select("station_1", "station_2", F.row_number().over(Window.partitionBy("station_1").orderBy("distance", "station_2")).alias("rank"))


@query("j15_nearest_valid_pixel", fx("obs") + f""", {FRAMES}, pts AS (SELECT s_suppkey AS pid, (s_suppkey % n)::INT AS f, (s_suppkey % n * 20 + s_suppkey * 13 % 26 - 3)::INT AS r, (s_suppkey * 17 % 31 - 3)::INT AS c FROM supplier, n_frames), ok AS (SELECT * FROM obs WHERE e = 10 AND value IS NOT NULL)
SELECT pid, "row"::INT AS near_row, col::INT AS near_col, round(value, 8) AS value, round(sqrt((r - "row") ^ 2 + (c - col) ^ 2), 8) AS dist FROM pts JOIN ok ON frame_id = f QUALIFY row_number() OVER (PARTITION BY pid ORDER BY (r - "row") ^ 2 + (c - col) ^ 2, "row", col) = 1""")
def j15(spark, sf):
    s = over_frames(spark, sf, fxs.table(spark, sf, "supplier").select(F.col("s_suppkey").alias("pid")), "pid")
    pts = s.select("pid", "frame_id", (F.col("frame_id") * 20 + F.col("pid") * 13 % 26 - 3).cast("int").alias("row"), (F.col("pid") * 17 % 31 - 3).cast("int").alias("col"))
    valid = obs(spark, sf).filter(F.col("obs_date") == fxs._epoch_date(F.lit(10)))
    return variogram.nearest_valid(pts, valid).select("pid", "near_row", "near_col", *r9("value", "dist", digits=8))


#: Profiles of a production run, each of two points.
PROFILES = 6000


@query("w07_profile_pairs")
def w07(spark, sf):
    p = validate.sample_pairs(unique_points(spark, sf), 2 * PROFILES)
    cell = fxs.velocity_points(spark, sf).groupBy(F.floor(F.col("y") / 1000).cast("int").alias("row"), F.floor(F.col("x") / 1000).cast("int").alias("col")).agg(F.avg("v").alias("value")).withColumn("frame_id", F.lit(0))
    return variogram.profile_pairs(p, cell, (1000.0, 1000.0), (5.0, 40.0)).select(F.col("pair").cast("long").alias("pair"), *r9("distance", "difference", digits=7))


@query("w07_geographic_profiles")
def w07g(spark, sf):
    """The same over longitudes and latitudes, across the date line."""
    p = unique_points(spark, sf).select("id", ((F.col("x") / 60000 * 0.6 + 359.9) % 360 - 180).alias("x"), (F.col("y") / 60000 * 0.6 + 40).alias("y"), "v")
    ends = validate.sample_pairs(p, 2 * PROFILES, geographic=True)
    return variogram.geographic_profiles(ends, p.select(F.col("x").alias("lon"), F.col("y").alias("lat"), F.col("v").alias("value")), (0.1, 50.0)).select(F.col("pair").cast("long").alias("pair"), *r9("distance", "difference", digits=7))


PARTS = """one AS (SELECT * FROM components WHERE frame_id = 1), two AS (SELECT * FROM components WHERE frame_id = 2),
n AS (SELECT two.label AS label_2, one.label AS label_1, count(*) AS n FROM one JOIN two USING ("row", col) WHERE (one.label = 0) = (two.label = 0) GROUP BY ALL),
best AS (SELECT *, row_number() OVER (PARTITION BY label_2 ORDER BY n DESC, label_1) = 1 AS best FROM n)"""
OFFSETS = """d AS (SELECT b.label_2, b.label_1, one.phase - two.phase AS d FROM one JOIN two USING ("row", col) JOIN best b ON one.label = b.label_1 AND two.label = b.label_2 WHERE b.best),
g AS (SELECT label_2, label_1, median(d) AS m, atan2(avg(sin(d)), avg(cos(d))) AS r FROM d GROUP BY ALL), c AS (SELECT *, (floor((abs(m) + pi()) / (2 * pi())) * sign(m))::INT AS cycles FROM g),
o AS (SELECT label_2, label_1, cycles, CASE WHEN abs(m - (2 * pi() * cycles + r)) > 3.14 THEN -r ELSE r END AS rest FROM c)"""


def two_frames(spark, sf):
    c = fxs.components(spark, sf)
    part = lambda f: c.filter(F.col("frame_id") == f).select("row", "col", "label", "phase")
    return part(1), part(2)


@query("a30_component_overlap", fx("components") + f", {PARTS} SELECT label_2, label_1, n, best FROM best")
def a30(spark, sf):
    return stitch.overlaps(*two_frames(spark, sf))


@query("a31_cycle_offset", fx("components") + f", {PARTS}, {OFFSETS} SELECT label_2, label_1, cycles, round(rest, 6) AS rest, round(2 * pi() * cycles + rest, 6) AS \"offset\" FROM o")
def a31(spark, sf):
    return stitch.cycle_offsets(*two_frames(spark, sf)).select("label_2", "label_1", "cycles", *r9("rest", "offset", digits=6))


@query("a32_stitch_frames", fx("components") + f""", {PARTS}, {OFFSETS}, moved AS (SELECT t."row", t.col, coalesce(o.label_1, CASE WHEN t.label = 0 THEN 0 ELSE t.label + (SELECT max(label) FROM one) END) AS label, t.phase + coalesce(2 * pi() * o.cycles + o.rest, 0) AS phase FROM two t LEFT JOIN o ON t.label = o.label_2),
both_ AS (SELECT "row", col, label, phase FROM one UNION ALL SELECT * FROM moved) SELECT "row", col, min(label)::INT AS label, round(avg(phase), 6) AS phase FROM both_ GROUP BY ALL""")
def a32(spark, sf):
    return stitch.stitch(fxs.components(spark, sf), [1, 2]).select("row", "col", F.col("label").cast("int").alias("label"), *r9("phase", digits=6))


def offsets_sql(name, one, two):
    """CTEs: {name} has label_2 of ``two``, its partner label_1 in ``one``, and the offset."""
    return f"""{name}_n AS (SELECT b.label AS label_2, a.label AS label_1, count(*) AS n FROM {one} a JOIN {two} b USING ("row", col) WHERE (b.label = 0) = (a.label = 0) GROUP BY ALL),
{name}_d AS (SELECT label_2, label_1, a.phase - b.phase AS d FROM (SELECT * FROM {name}_n QUALIFY row_number() OVER (PARTITION BY label_2 ORDER BY n DESC, label_1) = 1) p JOIN {one} a ON a.label = p.label_1 JOIN {two} b ON b.label = p.label_2 AND a."row" = b."row" AND a.col = b.col),
{name}_g AS (SELECT label_2, label_1, median(d) AS m, atan2(avg(sin(d)), avg(cos(d))) AS r FROM {name}_d GROUP BY ALL), {name}_c AS (SELECT *, floor((abs(m) + pi()) / (2 * pi())) * sign(m) AS cycles FROM {name}_g),
{name} AS (SELECT label_2, label_1, 2 * pi() * cycles + CASE WHEN abs(m - (2 * pi() * cycles + r)) > 3.14 THEN -r ELSE r END AS off FROM {name}_c)"""


def merge_sql(name, one, two):
    return f"""{offsets_sql(name + "_f", one, two)}, {name}_new AS (SELECT label, row_number() OVER (ORDER BY label) + (SELECT max(label) FROM {one}) AS label_1 FROM (SELECT DISTINCT label FROM {two} WHERE label > 0 AND label NOT IN (SELECT label_2 FROM {name}_f))),
{name}_2 AS (SELECT t."row", t.col, coalesce(o.label_1, w.label_1, t.label) AS label, t.phase + coalesce(o.off, 0) AS phase FROM {two} t LEFT JOIN {name}_f o ON t.label = o.label_2 LEFT JOIN {name}_new w ON t.label = w.label),
{offsets_sql(name + "_b", name + "_2", one)}, {name}_1 AS (SELECT t."row", t.col, coalesce(o.label_1, t.label) AS label, t.phase + coalesce(o.off, 0) AS phase FROM {one} t LEFT JOIN (SELECT * FROM {name}_b WHERE label_1 <> label_2) o ON t.label = o.label_2),
{name} AS (SELECT "row", col, min(label) AS label, avg(phase) AS phase FROM (SELECT * FROM {name}_1 UNION ALL SELECT * FROM {name}_2) GROUP BY ALL)"""


@query("a32_stitch_three_frames", fx("components") + f""", one AS (SELECT "row", col, label, phase FROM components WHERE frame_id = (SELECT frame_id FROM components GROUP BY 1 ORDER BY max("row"), frame_id DESC LIMIT 1)),
two AS (SELECT "row", col, label, phase FROM components WHERE frame_id = (SELECT frame_id FROM components GROUP BY 1 ORDER BY max("row") DESC, frame_id LIMIT 1)),
three AS (SELECT CASE WHEN p_partkey % 3 = 0 THEN p_partkey // 50 + (SELECT greatest(1000, max(p_partkey // 50) + 1) FROM part) ELSE p_partkey // 50 END AS "row", p_partkey % 50 AS col, CASE WHEN p_partkey % 3 = 0 THEN 5 + p_partkey % 2 * 4 WHEN p_size % 4 = 0 THEN 0 WHEN p_partkey % 50 < 30 THEN p_size % 4 ELSE p_size % 4 + 5 END AS label,
p_retailprice / 100 + 6.283185307179586::DOUBLE * (p_partkey % 50 // 30) AS phase FROM part), {merge_sql("m", "three", "two")}, {merge_sql("r", "m", "one")}
SELECT "row"::INT AS "row", col::INT AS col, CASE WHEN label > 0 AND col < 45 THEN label ELSE -1 END::INT AS label, CASE WHEN label > 0 AND col < 45 AND phase <> 0 THEN round(phase, 6) END AS phase FROM r""")
def a32t(spark, sf):
    """From south to north: a frame cut in two, off by a cycle, which the others join again, and components of its own; masked in the end."""
    p, c = fxs.table(spark, sf, "part"), fxs.components(spark, sf)
    k, label, far = F.col("p_partkey"), F.col("p_size") % 4, F.col("p_partkey") % 50 >= 30
    south = max(1000, (p.agg(F.max(F.expr("p_partkey div 50"))).first()[0] or 0) + 1)  # no place is taken twice
    third = p.select(
        F.lit(3).alias("frame_id"),
        (F.expr("p_partkey div 50") + F.when(k % 3 == 0, south).otherwise(0)).cast("int").alias("row"),
        (k % 50).cast("int").alias("col"),
        F.when(k % 3 == 0, 5 + k % 2 * 4).when(label == 0, 0).when(far, label + 5).otherwise(label).cast("int").alias("label"),
        (F.col("p_retailprice") / 100 + 2 * math.pi * far.cast("int")).alias("phase"),
    )
    merged = stitch.stitch(c.unionByName(third))
    mask = merged.select("row", "col", (F.col("col") < 45).alias("keep"))
    return stitch.final_mask(merged, mask).select("row", "col", F.coalesce("label", F.lit(-1)).cast("int").alias("label"), *r9("phase", digits=6))


@query("s09_result_tables", fx("obs") + f"SELECT {PIX}, count(*) AS n, round(sum(value), 7) AS total FROM obs GROUP BY ALL")
def s09(spark, sf):
    """Writes the cube by frame and layer and reads it back."""
    import uuid

    from subsidia.sources import readers

    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    path = f"{base.rstrip('/')}/cube-{uuid.uuid4().hex}"
    readers.write_cube(obs(spark, sf), path)
    return spark.read.parquet(path).groupBy(*cube.PIXEL).agg(F.count("*").alias("n"), F.round(F.sum("value"), 7).alias("total"))


@query("s09_validation_table", fx("stations") + f", {PAIRS}" + binned_sql("pairs").replace("SELECT f.bin::INT AS bin, f.bin_lo, f.bin_hi, coalesce(n_total, 0) AS n_total, coalesce(n_pass, 0) AS n_pass, round(quantile, 8) AS quantile, round(n_pass / nullif(n_total, 0), 8) AS pass_ratio, coalesce(n_pass / nullif(n_total, 0) > 0.683, false) AS success", "SELECT printf('%.2f-%.2f', f.bin_lo, f.bin_hi) AS distance, coalesce(n_total, 0) AS n_total, coalesce(n_pass, 0) AS n_pass, round(n_pass / nullif(n_total, 0), 8) AS ratio, coalesce(n_pass / nullif(n_total, 0) > 0.683, false) AS success"))
def s09v(spark, sf):
    """Writes the validation table as CSV and reads it back."""
    import uuid

    from subsidia.sources import readers

    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    path = f"{base.rstrip('/')}/table-{uuid.uuid4().hex}"
    readers.write_validation(validate.station_requirement_test(fxs.stations(spark, sf)), path)
    back = spark.read.csv(path, header=True, schema="distance string, n_total long, n_pass long, ratio double, success boolean")
    return back.select("distance", "n_total", "n_pass", *r9("ratio", digits=8), "success")


@query("w06_sample_pairs_geographic", fx("points") + f""", {USAMPLE} SELECT pair, round(2 * 6378 * asin(sqrt(sin(radians(y_1 / 1000 - y_0 / 1000) / 2) ^ 2 + cos(radians(y_0 / 1000)) * cos(radians(y_1 / 1000)) * sin(radians(x_1 / 1000 - x_0 / 1000) / 2) ^ 2)), 6) AS distance, round(difference, 8) AS difference FROM spairs""")
def w06g(spark, sf):
    """Points by longitude and latitude."""
    p = unique_points(spark, sf).withColumn("x", F.col("x") / 1000).withColumn("y", F.col("y") / 1000)
    return validate.sample_pairs(p, PRODUCTION, geographic=True).select(F.col("pair").cast("long").alias("pair"), *r9("distance", digits=6), *r9("difference", digits=8))


@query("a22_fit_variogram_stable", SQL["a22_fit_variogram"].replace("1 - exp(-distance / (k * 0.5))", "1 - exp(-((distance / (k * 0.5)) ^ 1.5))"))
def a22_stable(spark, sf):
    p = production_pairs(spark, sf).withColumn("gamma", F.expr("0.5 * difference * difference")).filter("distance <= 50")
    return variogram.fit_variogram(p, RANGES, "stable").select("range", *r9("sill", "rmse", "residual_std", digits=6))


@query("a22_fit_bin_quantiles", fx("points") + f""", {USAMPLE}, bins AS (SELECT * FROM {edge_rows(0.1, 50.0, 10)}),
b AS (SELECT (bin_lo + bin_hi) / 2 AS distance, quantile_cont(difference, 0.683) AS gamma FROM spairs JOIN bins ON distance > bin_lo AND distance <= bin_hi GROUP BY ALL), c AS (SELECT k * 0.5::DOUBLE AS range, 1 - exp(-distance / (k * 0.5)) AS g, gamma FROM b, range(1, 101) r(k)),
s AS (SELECT range, count(*) AS n, sum(g * gamma) AS gy, sum(g * g) AS gg, sum(gamma * gamma) AS yy FROM c GROUP BY 1)
SELECT range, round(gy / gg, 6) AS sill, round(sqrt((yy - gy * gy / gg) / n), 6) AS rmse FROM s ORDER BY yy - gy * gy / gg, range LIMIT 1""")
def a22_bins(spark, sf):
    """The second fit: bin centres against the quantiles of the binned test."""
    b = validate.binned_requirement_test(production_pairs(spark, sf)).filter("bin >= 0").select(((F.col("bin_lo") + F.col("bin_hi")) / 2).alias("centre"), "quantile")
    return variogram.fit_variogram(b, RANGES, distance="centre", value="quantile").select("range", *r9("sill", "rmse", digits=6))
