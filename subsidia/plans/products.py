"""Registered queries over product catalogues, bursts, text sources and metadata, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from subsidia.functions import columns as fn
from subsidia.operators import catalog, compare
from subsidia.plans import fixtures as fxs
from subsidia.plans.fixtures import fx
from subsidia.sources import readers

QUERIES, SQL = {}, {}


def query(name, sql=None):
    def add(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return add


P = "path, frame_id, ref_date, sec_date, version"


def prods(spark, sf):
    return fxs.products(spark, sf).select("path", "frame_id", "ref_date", "sec_date", "version", "production_ts")


@query("s01_read_product_catalog", fx("products") + f"SELECT {P}, epoch(production_ts)::BIGINT AS made, 'SAT' AS project, 'VV' AS polarization FROM products")
def s01(spark, sf):
    return catalog.parse_products(prods(spark, sf).select("path")).select("path", "frame_id", "ref_date", "sec_date", "version", F.unix_timestamp("production_ts").alias("made"), "project", "polarization")


LINES = """lines AS (SELECT station, obs_date, round(east * 1e6)::BIGINT AS e, round(north * 1e6)::BIGINT AS n, round(up * 1e6)::BIGINT AS u FROM gnss)"""


@query("s02_read_gnss_daily", fx("gnss") + f", {LINES} SELECT 'S' || station AS station, obs_date, (7 + e)::DOUBLE AS east, (7 + n)::DOUBLE AS north, (7 + u)::DOUBLE AS up, 0.5::DOUBLE AS sig_e FROM lines")
def s02(spark, sf):
    g = fxs.gnss(spark, sf)
    big = lambda c: F.round(F.col(c) * 1e6).cast("long").cast("string")
    line = F.concat_ws(" ", F.concat(F.lit("S"), F.col("station").cast("string")), F.upper(F.date_format("obs_date", "yyMMMdd")), *[F.lit("0")] * 5, F.lit("7"), big("east"), F.lit("7"), big("north"), F.lit("7"), big("up"), F.lit("0"), *[F.lit("0.5")] * 6)
    lines = g.select(F.lit("f").alias("file"), F.lit(1).alias("line_no"), line.alias("value"))
    header = lines.limit(1).select("file", F.lit(0).alias("line_no"), "value")
    return readers.parse_tenv3(lines.unionByName(header)).select("station", "obs_date", "east", "north", "up", "sig_e")


@query("s03_read_step_events", fx("steps") + """SELECT 'S' || station AS station, step_date, code, CASE WHEN code = 1 THEN 'Antenna' ELSE '100' END AS type_threshold,
CASE WHEN code = 2 THEN distance_km END AS distance_km, CASE WHEN code = 2 THEN magnitude END AS magnitude FROM steps""")
def s03(spark, sf):
    s = fxs.steps(spark, sf)
    name = F.concat(F.lit("S"), F.col("station").cast("string"))
    day = F.upper(F.date_format("step_date", "yyMMMdd"))
    quake = F.concat_ws("  ", name, day, F.lit("2"), F.lit("100"), F.col("distance_km").cast("string"), F.col("magnitude").cast("string"), F.lit("us1"))
    lines = s.select(F.when(F.col("code") == 1, F.concat_ws("  ", name, day, F.lit("1"), F.lit("Antenna"))).otherwise(quake).alias("value"))
    broken = s.select(F.explode(F.array(F.lit(""), F.concat_ws(" ", name, day, F.lit("2"), F.lit("100")), F.concat_ws(" ", name, day))).alias("value"))
    return readers.parse_steps(lines.unionByName(broken)).select("station", "step_date", "code", "type_threshold", "distance_km", "magnitude")


@query("s04_read_frames", "SELECT s_suppkey::INT AS frame_id, CASE WHEN s_suppkey % 2 = 0 THEN 'ASCENDING' ELSE 'DESCENDING' END AS orbit_pass, 5 AS n_points, (s_suppkey % 360 - 180)::DOUBLE AS first_lon FROM supplier")
def s04(spark, sf):
    s = fxs.table(spark, sf, "supplier")
    x, y = F.col("s_suppkey") % 360 - 180, F.col("s_suppkey") % 120 - 60
    ring = ", ".join(["[%d, %d]"] * 5)
    args = [c for dx, dy in ((0, 0), (2, 0), (2, 2), (0, 2), (0, 0)) for c in (x + dx, y + dy)]
    feature = F.format_string('{"features": [{"id": "%d", "properties": {"orbit_pass": "%s"}, "geometry": {"type": "Polygon", "coordinates": [[' + ring + "]]}}]}", F.col("s_suppkey"), F.when(F.col("s_suppkey") % 2 == 0, "ASCENDING").otherwise("DESCENDING"), *args)
    f = readers.parse_frames(s.select(feature.alias("value")))
    return f.select("frame_id", "orbit_pass", F.size("ring").alias("n_points"), F.col("ring")[0]["lon"].alias("first_lon"))


@query("s04_read_burst_map", "SELECT DISTINCT 't' || (l_suppkey % 27) || '_' || l_linenumber AS burst_id, unnest([(l_suppkey % 4)::INT, (l_suppkey % 4 + 1)::INT]) AS frame_id FROM lineitem")
def s04b(spark, sf):
    j = F.format_string('{"T%d_%d": {"frame_ids": [%d, %d]}}', F.col("l_suppkey") % 27, F.col("l_linenumber"), F.col("l_suppkey") % 4, F.col("l_suppkey") % 4 + 1)
    return readers.parse_burst_map(fxs.table(spark, sf, "lineitem").select(j.alias("value"))).distinct()


@query("s05_read_stations", "SELECT 'S' || s_suppkey AS station, (s_suppkey % 170 - 85)::DOUBLE AS lat, s_suppkey % 360 / 2 AS lon FROM supplier")
def s05(spark, sf):
    k = F.col("s_suppkey")
    line = F.concat_ws(",", F.concat(F.lit("S"), k.cast("string")), (k % 170 - 85).cast("string"), (k % 360 / 2).cast("string"))
    return readers.parse_stations(fxs.table(spark, sf, "supplier").select(line.alias("value")))


@query("s07_layer_registry", fx("obs") + """, own AS (SELECT DISTINCT version, frame_id, layer FROM obs), layers AS (SELECT version, frame_id, unnest(['timeseries', 'velocity', 'temporal_coherence']) AS layer FROM own)
SELECT version, frame_id, layer, CASE WHEN layer = 'velocity' THEN 'velocity' ELSE 'timeseries' END AS dataset, CASE WHEN layer = 'velocity' THEN 1000 ELSE 100 END::DOUBLE AS scale, layer = 'timeseries' AS present FROM layers""")
def s07(spark, sf):
    own = fxs.raw_obs(spark, sf).select("version", "frame_id", "layer").distinct()
    layers = own.select("version", "frame_id", F.explode(F.array(*map(F.lit, ("timeseries", "velocity", "temporal_coherence")))).alias("layer"))
    return readers.layer_registry(layers.withColumn("scale", F.when(F.col("layer") == "velocity", 1000.0)), own)


@query("s07_missing_layers", fx("obs") + """, own AS (SELECT DISTINCT version, frame_id, layer FROM obs) SELECT version, frame_id, layer, 'm' AS unit, 'p/' || layer AS path FROM (SELECT version, frame_id, unnest(['timeseries', 'velocity', 'shp_counts']) AS layer FROM own) WHERE layer <> 'timeseries'""")
def s07m(spark, sf):
    own = fxs.raw_obs(spark, sf).select("version", "frame_id", "layer").distinct()
    layers = own.select("version", "frame_id", F.explode(F.array(*map(F.lit, ("timeseries", "velocity", "shp_counts")))).alias("layer"))
    return readers.missing_layers(layers.select("*", F.lit("m").alias("unit"), F.concat(F.lit("p/"), "layer").alias("path")), own).select("version", "frame_id", "layer", "unit", "path")


@query("s08_points_by_count", fx("cells") + """SELECT frame_id, "row", col FROM cells WHERE e = 10 AND abs(x) > 0.05 ORDER BY md5('3|' || frame_id || '|' || "row" || '|' || col), frame_id || '|' || "row" || '|' || col LIMIT 150""")
def s08n(spark, sf):
    valid = fxs._cells(spark, sf).filter((F.col("e") == 10) & (F.abs("x") > 0.05)).select("frame_id", "row", "col")
    return readers.points_by_count(valid, 150, seed=3)


@query("s08_merge_points", """WITH p AS (SELECT 0 AS list, s_suppkey AS k, s_suppkey % 50 / 8 AS lon, s_suppkey % 30 / 4 AS lat FROM supplier UNION ALL SELECT 1, c_custkey, c_custkey % 70 / 8, c_custkey % 40 / 4 FROM customer)
SELECT min(list)::INT AS list, lon, lat FROM p GROUP BY lon, lat""")
def s08(spark, sf):
    wkt = lambda t, k, a, b: fxs.table(spark, sf, t).select(F.col(k).alias("line_no"), F.concat(F.lit("POINT ("), (F.col(k) % a / 8).cast("string"), F.lit(" "), (F.col(k) % b / 4).cast("string"), F.lit(")")).alias("value"))
    return readers.merge_points(readers.parse_points(wkt("supplier", "s_suppkey", 50, 30)), readers.parse_points(wkt("customer", "c_custkey", 70, 40)))


@query("s10_product_listing", fx("products") + f""", wanted AS (SELECT *, regexp_replace(path, '_[^_]*_[^_]*$', '') AS key FROM products WHERE frame_id = 2 AND version = '0.9'),
last AS (SELECT max(path) AS path FROM wanted GROUP BY key) SELECT {P} FROM products SEMI JOIN last USING (path) WHERE ref_date BETWEEN DATE '1996-01-01' AND DATE '1999-12-31' AND sec_date BETWEEN DATE '1996-01-01' AND DATE '1999-12-31'""")
def s10(spark, sf):
    return catalog.product_listing(prods(spark, sf), 2, "0.9", "1996-01-01", "1999-12-31").drop("production_ts")


@query("p01_filter_products", fx("products") + f"SELECT {P} FROM products WHERE sec_date BETWEEN DATE '1997-01-01' AND DATE '1998-06-30'")
def p01(spark, sf):
    return catalog.filter_products(prods(spark, sf), "1997-01-01", "1998-06-30").drop("production_ts")


@query("p02_filter_steps", fx("steps") + "SELECT * FROM steps WHERE step_date > DATE '2024-01-05' AND step_date < DATE '2024-01-20'")
def p02(spark, sf):
    return catalog.filter_steps(fxs.steps(spark, sf), "2024-01-05", "2024-01-20")


@query("p03_single_version", fx("products") + "SELECT frame_id, count(DISTINCT version) AS n_versions, '0.10' AS latest, count(DISTINCT version) = 1 AS single FROM products GROUP BY frame_id")
def p03(spark, sf):
    return catalog.single_version(prods(spark, sf))


@query("p04_unit_scale", fx("products") + """SELECT path, round(CASE WHEN v < 4 THEN v * (-0.0554 / (4 * pi())) ELSE v END, 9) AS metres, round(v * (-4 * pi() / 0.0554), 6) AS phase FROM (SELECT path, date_diff('day', ref_date, sec_date) % 7 + 1 AS v FROM products)""")
def p04(spark, sf):
    v = F.datediff("sec_date", "ref_date") % 7 + 1
    p = prods(spark, sf).withColumn("v", v)
    version = F.when(F.col("v") < 4, "0.3").otherwise("0.10")
    return p.select("path", F.round(fn.displacement_metres(F.col("v"), version, 0.0554), 9).alias("metres"), F.round(fn.metres_to_phase(F.col("v"), 0.0554), 6).alias("phase"))


@query("p05_layer_name_by_version", fx("products") + "SELECT path, CASE WHEN d = 0 THEN 'interferometric_correlation' WHEN d = 1 THEN 'estimated_spatial_coherence' ELSE 'estimated_phase_quality' END AS layer FROM (SELECT path, date_diff('day', ref_date, sec_date) % 4 AS d FROM products)")
def p05(spark, sf):
    v = F.element_at(F.array(*map(F.lit, ("0.6", "0.7", "0.8", "0.10"))), (F.datediff("sec_date", "ref_date") % 4 + 1).cast("int"))
    return prods(spark, sf).select("path", fn.coherence_layer(v).alias("layer"))


NEWEST = f"newest AS (SELECT *, epoch(production_ts)::BIGINT AS made FROM products QUALIFY row_number() OVER (PARTITION BY frame_id, ref_date, sec_date ORDER BY production_ts DESC, path) = 1)"


@query("w01_dedupe_products", fx("products") + f", {NEWEST} SELECT {P}, made FROM newest")
def w01(spark, sf):
    return catalog.dedupe_products(prods(spark, sf)).withColumn("made", F.unix_timestamp("production_ts")).drop("production_ts")


STACKS = """marked AS (SELECT *, CASE WHEN lag(ref_date) OVER o IS NOT DISTINCT FROM ref_date THEN 0 ELSE 1 END AS new FROM newest WINDOW o AS (PARTITION BY frame_id ORDER BY sec_date, path)),
stacks AS (SELECT *, (sum(new) OVER (PARTITION BY frame_id ORDER BY sec_date, path))::INT AS stack FROM marked)"""


@query("w04_ministacks", fx("products") + f""", {NEWEST}, {STACKS} SELECT path, frame_id, ref_date, sec_date, stack,
row_number() OVER (PARTITION BY frame_id, stack ORDER BY sec_date, path) = 1 AS first, row_number() OVER (PARTITION BY frame_id, stack ORDER BY sec_date DESC, path DESC) = 1 AS last FROM stacks""")
def w04(spark, sf):
    return catalog.ministacks(catalog.dedupe_products(prods(spark, sf))).select("path", "frame_id", "ref_date", "sec_date", "stack", "first", "last")


@query("w05_independent_pairs", fx("pair_obs") + """, pairs AS (SELECT DISTINCT frame_id, ref_date, sec_date FROM pair_obs),
gaps AS (SELECT *, coalesce(date_diff('day', lag(sec_date) OVER (PARTITION BY frame_id ORDER BY sec_date, ref_date), sec_date), date_diff('day', ref_date, sec_date)) AS gap FROM pairs),
kept AS (SELECT * FROM gaps WHERE gap <= 12), marked AS (SELECT *, CASE WHEN lag(sec_date) OVER (PARTITION BY frame_id ORDER BY sec_date, ref_date) >= ref_date THEN 0 ELSE 1 END AS new FROM kept),
islands AS (SELECT *, sum(new) OVER (PARTITION BY frame_id ORDER BY sec_date, ref_date) AS island FROM marked)
SELECT frame_id, ref_date, sec_date, gap::INT AS gap FROM islands QUALIFY row_number() OVER (PARTITION BY frame_id, island ORDER BY sec_date, ref_date) % 2 = 1""")
def w05(spark, sf):
    return catalog.independent_pairs(fxs.pair_obs(spark, sf))


@query("j12_match_ancillary", fx("products") + f", {NEWEST} SELECT {P} FROM products SEMI JOIN (SELECT frame_id, ref_date, sec_date FROM newest WHERE version = '0.9') USING (frame_id, ref_date, sec_date)")
def j12(spark, sf):
    p = prods(spark, sf)
    return catalog.match_ancillary(p, catalog.dedupe_products(p).filter("version = '0.9'")).select("path", "frame_id", "ref_date", "sec_date", "version")


@query("j14_burst_to_frames", fx("bursts") + "SELECT lower(burst_id) AS burst_id, date, frame_id FROM (SELECT burst_id, date, unnest(frame_ids) AS frame_id FROM bursts) WHERE frame_id IN (1, 3)")
def j14(spark, sf):
    return catalog.burst_to_frames(fxs.bursts(spark, sf), [1, 3])




@query("a27_consistent_burst_dates", fx("bursts") + """, d AS (SELECT DISTINCT burst_id, date FROM bursts WHERE month(date) % 5 <> length(burst_id)), rich AS (SELECT * FROM d WHERE burst_id IN (SELECT burst_id FROM d GROUP BY 1 HAVING count(*) >= 3)),
common AS (SELECT date FROM rich GROUP BY date HAVING count(*) = (SELECT count(DISTINCT burst_id) FROM rich)), kept AS (SELECT * FROM rich WHERE date IN (SELECT date FROM common))
SELECT * FROM kept WHERE burst_id IN (SELECT burst_id FROM kept GROUP BY 1 HAVING count(*) >= 2)""")
def a27(spark, sf):
    return catalog.consistent_burst_dates(fxs.bursts(spark, sf).filter(F.month("date") % 5 != F.length("burst_id")))


@query("a28_most_common_frame", fx("bursts") + "SELECT frame_id, count(*) AS n FROM (SELECT unnest(frame_ids) AS frame_id FROM bursts) GROUP BY 1 ORDER BY n DESC, frame_id LIMIT 1")
def a28(spark, sf):
    return catalog.most_common_frame(fxs.bursts(spark, sf))


@query("a29_contiguous_frames", fx("products") + """SELECT q AS ref_date, q AS sec_date, min(frame_id) AS first_frame, max(frame_id) AS last_frame, count(DISTINCT frame_id) AS n_frames FROM (SELECT *, sec_date AS q FROM products) GROUP BY q
HAVING max(frame_id) - min(frame_id) = count(DISTINCT frame_id) - 1""")
def a29(spark, sf):
    return catalog.contiguous_frames(prods(spark, sf).withColumn("ref_date", F.col("sec_date")))


@query("u02_date_list", fx("products") + "SELECT frame_id, ref_date AS obs_date FROM products UNION SELECT frame_id, sec_date FROM products")
def u02(spark, sf):
    return catalog.date_list(prods(spark, sf))


@query("u04_append_bursts", fx("bursts") + """, a AS (SELECT burst_id, date, min(url) AS url FROM bursts WHERE month(date) <= 6 GROUP BY ALL), b AS (SELECT burst_id, date, max(url) AS url FROM bursts WHERE month(date) >= 6 GROUP BY ALL)
SELECT * FROM a UNION ALL SELECT * FROM b ANTI JOIN a USING (burst_id, date)""")
def u04(spark, sf):
    b = fxs.bursts(spark, sf)
    known = b.filter(F.month("date") <= 6).groupBy("burst_id", "date").agg(F.min("url").alias("url"))
    return catalog.append_bursts(known, b.filter(F.month("date") >= 6).groupBy("burst_id", "date").agg(F.max("url").alias("url")), ["burst_id", "date"])


@query("t01_order_products", fx("products") + "SELECT path, frame_id, row_number() OVER (PARTITION BY frame_id ORDER BY sec_date, path)::INT AS position FROM products")
def t01(spark, sf):
    return catalog.by_date(prods(spark, sf)).select("path", "frame_id", "position")


@query("t05_first_last_range", fx("pair_obs") + """, ends AS (SELECT frame_id, min(sec_date) AS a, max(sec_date) AS b FROM pair_obs GROUP BY 1)
SELECT frame_id, round(min(value), 9) AS low, round(max(value), 9) AS high FROM pair_obs JOIN ends USING (frame_id) WHERE sec_date IN (a, b) GROUP BY 1""")
def t05(spark, sf):
    return catalog.first_last_range(fxs.pair_obs(spark, sf)).select("frame_id", F.round("low", 9).alias("low"), F.round("high", 9).alias("high"))


@query("j17_metadata_diff", fx("meta") + """, a AS (SELECT path, value AS old FROM meta WHERE product = 0 AND length(path) % 3 <> 0), b AS (SELECT path, value AS new FROM meta WHERE product = 1 AND right(path, 1) <> '7')
SELECT path, CASE WHEN old IS NULL THEN 'added' WHEN new IS NULL THEN 'removed' ELSE 'changed' END AS change, old, new FROM a FULL JOIN b USING (path) WHERE old IS DISTINCT FROM new""")
def j17(spark, sf):
    m = fxs.meta(spark, sf)
    return compare.metadata_diff(m.filter((F.col("product") == 0) & (F.length("path") % 3 != 0)), m.filter((F.col("product") == 1) & (F.right("path", F.lit(1)) != "7")))


@query("j17_version_strings", fx("products") + """, p AS (SELECT frame_id AS product, max(version) AS sas_version, min(version) AS dolphin_version, 'c' || frame_id % 2 AS compass_version, '0.2' AS isce3_version, NULL::VARCHAR AS s1read_version FROM products GROUP BY frame_id),
r AS (SELECT product, path, value FROM p, LATERAL (SELECT unnest(['sas_version', 'dolphin_version', 'compass_version', 'isce3_version', 's1read_version']) AS path, unnest([sas_version, dolphin_version, compass_version, isce3_version, s1read_version]) AS value))
SELECT a.path, 'changed' AS change, a.value AS old, b.value AS new FROM r a JOIN r b USING (path) WHERE a.product = 1 AND b.product = 2 AND a.value IS DISTINCT FROM b.value""")
def j17v(spark, sf):
    p = fxs.products(spark, sf).groupBy(F.col("frame_id").alias("product")).agg(F.max("version").alias("sas_version"), F.min("version").alias("dolphin_version"))
    p = p.select("*", F.concat(F.lit("c"), (F.col("product") % 2).cast("string")).alias("compass_version"), F.lit("0.2").alias("isce3_version"), F.lit(None).cast("string").alias("s1read_version"))
    r = compare.version_rows(p, "product")
    return compare.metadata_diff(r.filter("product = 1"), r.filter("product = 2"))


@query("j17_metadata_diff_lists", """WITH runs AS (SELECT user_id, event_id % 2 AS side, event_type AS t, event_id % 3 AS m, json_extract_string(props, '$.k')::INT % 10 AS k FROM events),
n AS (SELECT user_id, '{"k":' || k || ',"tags":[[' || m || '],"' || t || '"]}' AS old, '{"k":' || k || ',"tags":["' || t || '",[' || m || ']]}' AS new, count(*) FILTER (side = 0) - count(*) FILTER (side = 1) AS n FROM runs GROUP BY ALL),
held AS (SELECT * FROM n WHERE n <> 0 AND user_id IN (SELECT user_id FROM runs WHERE side = 0) AND user_id IN (SELECT user_id FROM runs WHERE side = 1)),
per AS (SELECT user_id, coalesce(sum(n) FILTER (n > 0), 0) = 1 AND coalesce(sum(n) FILTER (n < 0), 0) = -1 AS one, max(old) FILTER (n > 0) AS o, max(new) FILTER (n < 0) AS w FROM held GROUP BY 1)
SELECT user_id, 'config.run\\.s[]' AS path, 'changed' AS change, o AS old, w AS new FROM per WHERE one
UNION ALL SELECT user_id, 'config.run\\.s[]', CASE WHEN n > 0 THEN 'removed' ELSE 'added' END, CASE WHEN n > 0 THEN old END, CASE WHEN n < 0 THEN new END FROM (SELECT *, unnest(range(abs(n)::BIGINT)) FROM held JOIN per USING (user_id) WHERE NOT one)""")
def j17l(spark, sf):
    """Lists of objects that hold lists: per user the even events against the odd ones, spelled in another order, as if of two products."""
    e, k = fxs.table(spark, sf, "events"), F.get_json_object("props", "$.k").cast("int") % 10
    one = F.format_string('{"k": %d, "tags": [[%d], "%s"]}', k, F.col("event_id") % 3, "event_type")
    two = F.format_string('{"tags": ["%s", [%d]], "k": %d}', "event_type", F.col("event_id") % 3, k)
    side = F.col("event_id") % 2
    docs = e.groupBy("user_id", side.alias("side")).agg(F.concat(F.lit('{"config": {"run.s": ['), F.array_join(F.collect_list(F.when(side == 0, one).otherwise(two)), ", "), F.lit("]}}")).alias("j"))
    held = e.groupBy("user_id").agg(F.bool_or(side == 0).alias("a"), F.bool_or(side == 1).alias("b")).filter("a AND b").select("user_id")
    flat = compare.flatten_json(docs.join(held, "user_id").select(F.struct("user_id", "side").alias("doc"), "j"), "doc", "j")
    part = lambda k: flat.filter(F.col("doc.side") == k).select("doc.user_id", "path", "value", "digest")
    return compare.metadata_diff(part(0), part(1), by=["user_id"])


@query("j17_flatten_metadata", "SELECT event_id, 'a.b[]' AS path, unnest([event_id::VARCHAR, 'x']) AS value FROM events UNION ALL SELECT event_id, 'props.k', json_extract_string(props, '$.k') FROM events")
def j17f(spark, sf):
    e = fxs.table(spark, sf, "events").select("event_id", F.format_string('{"a": {"b": [%d, "x"]}, "props": %s}', "event_id", "props").alias("j"))
    return compare.flatten_json(e, "event_id", "j").drop("digest")
