"""Domain tables derived from the benchmark tables, in Spark and in SQL, with integer and string arithmetic only."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FIRST = "2016-07-01"
EPOCHS = 64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _epoch_date(e):
    return F.date_add(F.lit(FIRST).cast("date"), (e * 12).cast("int"))


def _cells(spark, sf_dir):
    v = table(spark, sf_dir, "embeddings").select("vec_id", "label", F.posexplode("embedding").alias("e", "x"))
    return v.select(
        F.expr("cast(vec_id div 500 as int)").alias("frame_id"), F.expr("cast(vec_id div 25 as int)").alias("row"), (F.col("vec_id") % 25).cast("int").alias("col"),
        "e", _epoch_date(F.col("e")).alias("obs_date"), "vec_id", "label", F.col("x").cast("double").alias("x"),
    )


def raw_obs(spark, sf_dir, version="A") -> DataFrame:
    """Observation cube before the no-data rule: 0 and NULL are both no data."""
    value = F.when(F.col("e") == 0, 0.0).when((F.col("vec_id") + F.col("e")) % 11 == 0, None).otherwise(F.col("x") * 0.1)
    c = _cells(spark, sf_dir)
    if version == "B":
        c, value = c.filter("e % 7 <> 3"), value + F.col("label") * 0.01
    return c.select(F.lit(version).alias("version"), "frame_id", F.lit("timeseries").alias("layer"), "obs_date", "row", "col", value.alias("value"), "e")


def pair_obs(spark, sf_dir) -> DataFrame:
    """Interferogram pairs: every epoch from the one before, some from two before, every eighth also from eight before."""
    c = _cells(spark, sf_dir).filter("e > 0")
    back = F.when(F.col("e") % 4 == 0, 2).otherwise(1)
    edges = F.when(F.col("e") % 8 == 0, F.array(back, F.lit(8))).otherwise(F.array(back))
    c = c.withColumn("back", F.explode(edges)).filter("e >= back")
    value = F.when((F.col("vec_id") + F.col("e")) % 11 != 0, F.col("x") * 0.1 * F.col("back"))
    return c.select("frame_id", _epoch_date(F.col("e") - F.col("back")).alias("ref_date"), F.col("obs_date").alias("sec_date"), "row", "col", value.alias("value"), F.least(F.lit(1.0), F.abs("x") * 4).alias("coherence"), (F.col("vec_id") * 7 + F.col("e")).alias("k"))


def layer(spark, sf_dir, epoch: int, version: str = "A") -> DataFrame:
    """One layer of the grid: the elements of one position, absolute, at most 1."""
    return _cells(spark, sf_dir).filter(F.col("e") == epoch).select(F.lit(version).alias("version"), "frame_id", "row", "col", F.least(F.lit(1.0), F.abs("x") * 4).alias("value"), "label", "vec_id")


def stations(spark, sf_dir) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    gnss = F.col("s_acctbal") / 1000
    return s.select(F.col("s_suppkey").alias("station"), (F.col("s_suppkey") * 7919 % 60000).cast("double").alias("x"), (F.col("s_suppkey") * 104729 % 60000).cast("double").alias("y"), gnss.alias("gnss"), (gnss + (F.col("s_suppkey") * 31 % 13 - 6)).alias("insar"))


def velocity_points(spark, sf_dir) -> DataFrame:
    v = table(spark, sf_dir, "lineitem")
    return v.select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"), (F.col("l_orderkey") * 37 % 60000).cast("double").alias("x"), ((F.col("l_partkey") * 911 + F.col("l_linenumber") * 17) % 60000).cast("double").alias("y"), ((F.col("l_quantity") - 25) / 5).alias("v"))


def products(spark, sf_dir) -> DataFrame:
    """Product catalogue: per frame the latest date of an earlier quarter is the reference."""
    o = table(spark, sf_dir, "orders").select((F.col("o_custkey") % 5).cast("int").alias("frame_id"), F.col("o_orderdate").cast("date").alias("sec_date"), F.col("o_orderkey").alias("k"))
    quarters = o.groupBy("frame_id", F.trunc("sec_date", "quarter").alias("q")).agg(F.max("sec_date").alias("last"))
    firsts = o.groupBy("frame_id").agg(F.min("sec_date").alias("first"))
    from pyspark.sql import Window

    before = F.lag("last").over(Window.partitionBy("frame_id").orderBy("q"))
    refs = quarters.withColumn("before", before).join(firsts, "frame_id").select("frame_id", "q", F.coalesce("before", "first").alias("ref_date"))
    p = o.withColumn("q", F.trunc("sec_date", "quarter")).join(refs, ["frame_id", "q"]).filter("ref_date <> sec_date")
    version = F.concat(F.lit("0."), (F.col("k") % 3 + 8).cast("string"))
    made = F.timestamp_seconds(F.unix_timestamp(F.col("sec_date").cast("timestamp")) + F.col("k"))
    stamp = lambda d: F.concat(F.date_format(d, "yyyyMMdd"), F.lit("T000000Z"))
    path = F.concat_ws("_", F.lit("SAT"), F.lit("L3"), F.lit("DISP"), F.lit("IW"), F.concat(F.lit("F"), F.lpad(F.col("frame_id").cast("string"), 5, "0")), F.lit("VV"), stamp("ref_date"), stamp("sec_date"), F.concat(F.lit("v"), version), F.date_format(made, "yyyyMMdd'T'HHmmss'Z'"))
    return p.select(F.concat(F.lit("/data/"), path, F.lit(".nc")).alias("path"), "frame_id", "ref_date", "sec_date", version.alias("version"), made.alias("production_ts"))


def gnss(spark, sf_dir) -> DataFrame:
    e = table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("double")
    return e.groupBy(F.col("user_id").alias("station"), F.to_date("ts").alias("obs_date")).agg((F.avg("value") / 1000).alias("east"), (F.avg(F.col("value") * (F.col("event_id") % 7)) / 1000).alias("north"), (F.avg(k) / 1000).alias("up"))


#: What steps of the derived log are said to be; five of them spoil a series.
STEP_TYPES = ("Antenna_Changed", "Receiver_Changed", "Antenna_change", "Radome_Changed", "Equipment_Site_Change", "Antenna_Code_Changed", "Antenna_detached_from_monument")


def steps(spark, sf_dir) -> DataFrame:
    e = table(spark, sf_dir, "events").filter("event_type = 'error'")
    return e.select(F.col("user_id").alias("station"), F.to_date("ts").alias("step_date"), (1 + F.col("event_id") % 2).cast("int").alias("code"), (F.col("value") / 20).alias("magnitude"), F.col("value").alias("distance_km"), F.element_at(F.array(*map(F.lit, STEP_TYPES)), F.expr("cast(event_id div 2 % 7 + 1 as int)")).alias("type_threshold"))


def bursts(spark, sf_dir) -> DataFrame:
    b = table(spark, sf_dir, "lineitem").select((F.col("l_suppkey") % 27).alias("b"), F.trunc("l_shipdate", "month").alias("date"), (F.col("l_orderkey") % 50).alias("u"))
    return b.select(F.concat(F.lit("T"), F.col("b").cast("string")).alias("burst_id"), "date", F.concat(F.lit("url"), F.col("u").cast("string")).alias("url"), F.array((F.col("b") % 4).cast("int"), (F.col("b") % 4 + 1).cast("int")).alias("frame_ids"))


def components(spark, sf_dir) -> DataFrame:
    """Two frames that overlap: the second has other labels and phases off by whole cycles."""
    p = table(spark, sf_dir, "part").select(F.expr("cast(p_partkey div 50 as int)").alias("row"), F.col("p_partkey").cast("int").alias("k"), (F.col("p_partkey") % 50).cast("int").alias("col"), (F.col("p_size") % 4).cast("int").alias("label"), (F.col("p_retailprice") / 100).alias("phase"))
    a = p.filter("k % 5 <> 0").select(F.lit(1).alias("frame_id"), "row", "col", "label", "phase")
    shifted = F.when(F.col("label") == 0, 0).otherwise(F.col("label") % 3 + 1)
    b = p.filter("k % 7 <> 0").select(F.lit(2).alias("frame_id"), "row", "col", shifted.cast("int").alias("label"), (F.col("phase") - F.lit(6.283185307179586) * F.col("label") + 0.1).alias("phase"))
    return a.unionByName(b)


def meta(spark, sf_dir) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select((F.col("event_id") % 2).alias("product"), F.concat(F.lit("props."), F.expr("event_id div 2").cast("string")).alias("path"), F.col("props").alias("value"))


def summary(spark, sf_dir) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    name = lambda x: F.element_at(F.array(F.lit("PASS"), F.lit("FAIL"), F.lit("NA")), (x % 3 + 1).cast("int"))
    return c.select(F.col("c_nationkey").alias("frame"), name(F.col("c_custkey")).alias("va1"), name(F.col("c_custkey") * 7).alias("va2"))


_EPOCH = "DATE '2016-07-01' + (12 * ({}))::INT"

SQL = {
    "cells": """SELECT (vec_id // 500)::INT AS frame_id, (vec_id // 25)::INT AS "row", (vec_id % 25)::INT AS col, e::INT AS e,
        DATE '2016-07-01' + (12 * e)::INT AS obs_date, vec_id, label, embedding[e + 1]::DOUBLE AS x
        FROM embeddings, range(0, 64) r(e) WHERE e < len(embedding)""",
    "raw_obs": """SELECT 'A' AS version, frame_id, 'timeseries' AS layer, obs_date, "row", col,
        CASE WHEN e = 0 THEN 0.0::DOUBLE WHEN (vec_id + e) % 11 = 0 THEN NULL ELSE x * 0.1::DOUBLE END AS value, e FROM cells""",
    "raw_obs_b": """SELECT 'B' AS version, frame_id, 'timeseries' AS layer, obs_date, "row", col,
        CASE WHEN e = 0 THEN 0.0::DOUBLE WHEN (vec_id + e) % 11 = 0 THEN NULL ELSE x * 0.1::DOUBLE END + label * 0.01::DOUBLE AS value, e FROM cells WHERE e % 7 <> 3""",
    "obs": "SELECT * REPLACE (nullif(value, 0) AS value) FROM raw_obs",
    "obs_b": "SELECT * REPLACE (nullif(value, 0) AS value) FROM raw_obs_b",
    "pair_obs": """SELECT frame_id, DATE '2016-07-01' + (12 * (e - back))::INT AS ref_date, obs_date AS sec_date, "row", col,
        CASE WHEN (vec_id + e) % 11 <> 0 THEN x * 0.1::DOUBLE * back END AS value, least(1.0::DOUBLE, abs(x) * 4) AS coherence, vec_id * 7 + e AS k
        FROM (SELECT *, unnest(CASE WHEN e % 8 = 0 THEN [CASE WHEN e % 4 = 0 THEN 2 ELSE 1 END, 8] ELSE [CASE WHEN e % 4 = 0 THEN 2 ELSE 1 END] END) AS back FROM cells WHERE e > 0) WHERE e >= back""",
    "stations": """SELECT s_suppkey AS station, (s_suppkey * 7919 % 60000)::DOUBLE AS x, (s_suppkey * 104729 % 60000)::DOUBLE AS y,
        s_acctbal / 1000 AS gnss, s_acctbal / 1000 + (s_suppkey * 31 % 13 - 6) AS insar FROM supplier""",
    "points": """SELECT l_orderkey * 10 + l_linenumber AS id, (l_orderkey * 37 % 60000)::DOUBLE AS x,
        ((l_partkey * 911 + l_linenumber * 17) % 60000)::DOUBLE AS y, (l_quantity - 25) / 5 AS v FROM lineitem""",
    "products": """SELECT '/data/SAT_L3_DISP_IW_F' || lpad(frame_id::VARCHAR, 5, '0') || '_VV_' || strftime(ref_date, '%Y%m%d') || 'T000000Z_' || strftime(sec_date, '%Y%m%d') || 'T000000Z_v' || version || '_' || strftime(production_ts, '%Y%m%dT%H%M%SZ') || '.nc' AS path,
        frame_id, ref_date, sec_date, version, production_ts FROM (
          SELECT o.frame_id, coalesce(r.before, r.first) AS ref_date, o.sec_date, '0.' || (k % 3 + 8) AS version, o.sec_date::TIMESTAMP + to_seconds(k) AS production_ts
          FROM (SELECT (o_custkey % 5)::INT AS frame_id, o_orderdate::DATE AS sec_date, o_orderkey AS k FROM orders) o
          JOIN (SELECT frame_id, q, lag(last) OVER (PARTITION BY frame_id ORDER BY q) AS before, min(first) OVER (PARTITION BY frame_id) AS first
                FROM (SELECT (o_custkey % 5)::INT AS frame_id, date_trunc('quarter', o_orderdate) AS q, max(o_orderdate::DATE) AS last, min(o_orderdate::DATE) AS first FROM orders GROUP BY ALL)) r
            ON o.frame_id = r.frame_id AND date_trunc('quarter', o.sec_date) = r.q
        ) WHERE ref_date <> sec_date""",
    "gnss": """SELECT user_id AS station, ts::DATE AS obs_date, avg(value) / 1000 AS east, avg(value * (event_id % 7)) / 1000 AS north,
        avg(json_extract_string(props, '$.k')::DOUBLE) / 1000 AS up FROM events GROUP BY ALL""",
    "steps": """SELECT user_id AS station, ts::DATE AS step_date, (1 + event_id % 2)::INT AS code, value / 20 AS magnitude, value AS distance_km,
        ['Antenna_Changed', 'Receiver_Changed', 'Antenna_change', 'Radome_Changed', 'Equipment_Site_Change', 'Antenna_Code_Changed', 'Antenna_detached_from_monument'][event_id // 2 % 7 + 1] AS type_threshold FROM events WHERE event_type = 'error'""",
    "bursts": """SELECT 'T' || (l_suppkey % 27) AS burst_id, date_trunc('month', l_shipdate)::DATE AS date, 'url' || (l_orderkey % 50) AS url,
        [(l_suppkey % 27 % 4)::INT, (l_suppkey % 27 % 4 + 1)::INT] AS frame_ids FROM lineitem""",
    "components": """SELECT 1 AS frame_id, (p_partkey // 50)::INT AS "row", (p_partkey % 50)::INT AS col, (p_size % 4)::INT AS label, p_retailprice / 100 AS phase FROM part WHERE p_partkey % 5 <> 0
        UNION ALL SELECT 2, (p_partkey // 50)::INT, (p_partkey % 50)::INT, CASE WHEN p_size % 4 = 0 THEN 0 ELSE p_size % 4 % 3 + 1 END::INT,
        p_retailprice / 100 - 6.283185307179586::DOUBLE * (p_size % 4) + 0.1 FROM part WHERE p_partkey % 7 <> 0""",
    "meta": "SELECT event_id % 2 AS product, 'props.' || (event_id // 2) AS path, props AS value FROM events",
    "summary": """SELECT c_nationkey AS frame, ['PASS', 'FAIL', 'NA'][c_custkey % 3 + 1] AS va1, ['PASS', 'FAIL', 'NA'][c_custkey * 7 % 3 + 1] AS va2 FROM customer""",
}

_NEEDS = {"raw_obs": ["cells"], "raw_obs_b": ["cells"], "obs": ["raw_obs"], "obs_b": ["raw_obs_b"], "pair_obs": ["cells"]}


def fx(*names: str) -> str:
    """The WITH clause of the named fixtures and what they need."""
    order: list[str] = []

    def add(n):
        for x in _NEEDS.get(n, []):
            add(x)
        if n not in order:
            order.append(n)

    for n in names:
        add(n)
    return "WITH " + ",\n".join(f"{n} AS ({SQL[n]})" for n in order) + "\n"
