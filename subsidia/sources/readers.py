"""Readers and writers: GNSS series, step logs, frame polygons, station lists, points as WKT, result tables.

Parsers work on DataFrames of lines, so that any text source can feed them; the ``read_*`` functions add ``spark.read.text``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from subsidia.functions.columns import hash_order
from subsidia.functions.stages import numbered

SITES = T.StructType([T.StructField(n, T.StringType()) for n in ("site", "calval_location", "reference_lalo", "gps_ref_site_name")])
STATIONS = T.StructType([T.StructField("station", T.StringType()), T.StructField("lat", T.DoubleType()), T.StructField("lon", T.DoubleType())])


def _without_first(lines: DataFrame) -> DataFrame:
    """Lines of each file but the first. ``lines``: file, line_no, value."""
    return lines.filter("line_no > 0")


def numbered_lines(spark: SparkSession, paths) -> DataFrame:
    """(file, line_no, value) of text files; station files are small, so each is one row that is split."""
    whole = spark.read.text(paths, wholetext=True).select(F.col("_metadata.file_path").alias("file"), "value")
    return whole.select("file", F.posexplode(F.split("value", "\r?\n")).alias("line_no", "value"))


def parse_tenv3(lines: DataFrame) -> DataFrame:
    """Daily solutions of 23 columns; the first line of a file is its header. Short lines are left out."""
    c = F.split(F.trim("value"), r"\s+")
    kept = _without_first(lines).filter(F.size(c) >= 20)
    num = lambda i: F.get(c, F.lit(i)).try_cast("double")
    return kept.select(
        F.lit("tenv3").alias("source"), c[0].alias("station"), F.to_date(F.initcap(F.lower(c[1])), "yyMMMdd").alias("obs_date"),
        (num(7) + num(8)).alias("east"), (num(9) + num(10)).alias("north"), (num(11) + num(12)).alias("up"),
        num(14).alias("sig_e"), num(15).alias("sig_n"), num(16).alias("sig_u"), num(17).alias("corr_en"), num(18).alias("corr_eu"), num(19).alias("corr_nu"),
    )


def parse_series(lines: DataFrame) -> DataFrame:
    """Daily solutions of 17 columns; the station is the file's name before its first dot."""
    c = F.split(F.trim("value"), r"\s+")
    kept = _without_first(lines).filter(F.size(c) >= 17)
    num = lambda i: F.get(c, F.lit(i)).try_cast("double")
    day = F.make_date(num(11).cast("int"), num(12).cast("int"), num(13).cast("int"))
    name = F.upper(F.regexp_extract("file", r"([^/.]+)\.[^/]*$", 1))
    return kept.select(F.lit("series").alias("source"), name.alias("station"), day.alias("obs_date"), *[num(i).alias(n) for i, n in enumerate(("east", "north", "up", "sig_e", "sig_n", "sig_u", "corr_en", "corr_eu", "corr_nu"), 1)])


def read_gnss_daily(spark: SparkSession, paths, source: str = "tenv3") -> DataFrame:
    lines = numbered_lines(spark, paths)
    return parse_tenv3(lines) if source == "tenv3" else parse_series(lines)


def parse_steps(lines: DataFrame) -> DataFrame:
    """Step events: code 1 (equipment) has at least 4 fields, code 2 (earthquake) at least 7, other lines are left out.

    Dates and numbers that can't be read are NULL.
    """
    c = F.split(F.trim("value"), r"\s+")
    code = F.get(c, F.lit(2)).try_cast("int")
    kept = lines.filter((F.size(c) >= 3) & (((code == 1) & (F.size(c) >= 4)) | ((code == 2) & (F.size(c) >= 7))))
    quake = code == 2
    num = lambda i: F.when(quake, F.get(c, F.lit(i)).try_cast("double"))
    day = F.to_date(F.try_to_timestamp(F.initcap(F.lower(c[1])), F.lit("yyMMMdd")))
    return kept.select(c[0].alias("station"), day.alias("step_date"), code.alias("code"), F.get(c, F.lit(3)).alias("type_threshold"), num(4).alias("distance_km"), num(5).alias("magnitude"), F.when(quake, F.get(c, F.lit(6))).alias("event_id"))


def read_step_events(spark: SparkSession, paths) -> DataFrame:
    return parse_steps(spark.read.text(paths))


def parse_frames(documents: DataFrame) -> DataFrame:
    """(frame_id, orbit_pass, ring) of the features of GeoJSON collections (``value``); the id of a feature is its frame."""
    schema = "struct<features array<struct<id string, properties struct<orbit_pass string>, geometry struct<type string, coordinates array<array<array<double>>>>>>>"
    f = documents.select(F.explode(F.from_json("value", schema)["features"]).alias("f"))
    ring = F.transform(F.col("f.geometry.coordinates")[0], lambda p: F.struct(p[0].alias("lon"), p[1].alias("lat")))
    return f.select(F.col("f.id").try_cast("int").alias("frame_id"), F.col("f.properties.orbit_pass").alias("orbit_pass"), ring.alias("ring"))


def read_frames(spark: SparkSession, paths) -> DataFrame:
    return parse_frames(spark.read.text(paths, wholetext=True))


def parse_burst_map(documents: DataFrame) -> DataFrame:
    """(burst_id, frame_id) of JSON maps from burst id to ``frame_ids`` (``value``)."""
    m = documents.select(F.explode(F.from_json("value", "map<string, struct<frame_ids array<int>>>")).alias("burst_id", "b"))
    return m.select(F.lower("burst_id").alias("burst_id"), F.explode("b.frame_ids").alias("frame_id"))


def read_burst_map(spark: SparkSession, paths) -> DataFrame:
    return parse_burst_map(spark.read.text(paths, wholetext=True))


def read_sites(spark: SparkSession, paths) -> DataFrame:
    return spark.read.csv(paths, header=True, schema=SITES)


def parse_stations(lines: DataFrame) -> DataFrame:
    """(station, lat, lon) of comma-separated lines (``value``); what can't be read is NULL."""
    return lines.select(F.from_csv("value", "station string, lat double, lon double").alias("s")).select("s.*")


def read_stations(spark: SparkSession, paths) -> DataFrame:
    return spark.read.csv(paths, header=True, schema=STATIONS)


def parse_points(lines: DataFrame) -> DataFrame:
    """(line_no, position, lon, lat) of POINT and MULTIPOINT texts (``value``); WKT has the longitude first."""
    number = r"-?\d+(?:\.\d+)?(?:[eE][+-]?\d+)?"
    pairs = F.regexp_extract_all("value", F.lit(rf"{number}\s+{number}"), F.lit(0))
    p = lines.filter(F.rlike("value", F.lit(r"(?i)^\s*(MULTI)?POINT"))).select("line_no", F.posexplode(pairs).alias("position", "p"))
    xy = F.split("p", r"\s+")
    return p.select("line_no", "position", xy[0].cast("double").alias("lon"), xy[1].cast("double").alias("lat"))


def merge_points(*lists: DataFrame) -> DataFrame:
    """Points of all lists, the first of each place (6 decimals) in the order of the lists."""
    both = None
    for i, p in enumerate(lists):
        one = p.select(F.lit(i).alias("list"), "line_no", "position", "lon", "lat")
        both = one if both is None else both.unionByName(one)
    place = [F.round("lon", 6).alias("_x"), F.round("lat", 6).alias("_y")]
    return both.groupBy(*place).agg(F.min_by(F.struct("list", "lon", "lat"), F.struct("list", "line_no", "position")).alias("p")).select("p.*")


def write_points(points: DataFrame, path: str) -> None:
    """One POINT a line; left alone if the target exists."""
    wkt = F.concat(F.lit("POINT ("), F.col("lon").cast("string"), F.lit(" "), F.col("lat").cast("string"), F.lit(")"))
    points.select(wkt.alias("value")).write.mode("ignore").text(path)


def write_cube(obs: DataFrame, path: str, mode: str = "ignore") -> None:
    """Parquet by frame and layer, sorted so that a window of rows and columns prunes row groups."""
    obs.repartition("frame_id", "layer", F.expr("row div 64")).sortWithinPartitions("frame_id", "layer", "row", "col", "obs_date").write.mode(mode).partitionBy("frame_id", "layer").parquet(path)


def write_table(rows: DataFrame, path: str, mode: str = "ignore") -> None:
    """A result table as CSV with a header; existing results stay."""
    rows.write.mode(mode).csv(path, header=True)


def layer_registry(layers: DataFrame, available: DataFrame) -> DataFrame:
    """Registered layers (version, frame_id, layer, scale; path and unit if given) with dataset and whether the cube has them.

    Velocity layers keep dataset ``velocity``, others ``timeseries``; a missing scale is 100.
    """
    found = available.select("version", "frame_id", "layer").distinct().withColumn("_f", F.lit(True))
    dataset = F.when(F.contains("layer", F.lit("velocity")), "velocity").otherwise("timeseries")
    more = [c for c in ("path", "unit") if c in layers.columns]
    return layers.join(found, ["version", "frame_id", "layer"], "left").select("version", "frame_id", "layer", *more, dataset.alias("dataset"), F.coalesce("scale", F.lit(100.0)).alias("scale"), F.coalesce("_f", F.lit(False)).alias("present"))


def missing_layers(layers: DataFrame, available: DataFrame) -> DataFrame:
    """The registered layers that the cube lacks."""
    return layers.join(available, ["version", "frame_id", "layer"], "left_anti")


def points_from_pairs(spark: SparkSession, pairs: list[tuple[float, float]]) -> DataFrame:
    """Points given as (latitude, longitude), in the form of ``parse_points``."""
    return spark.createDataFrame([(0, i, float(lon), float(lat)) for i, (lat, lon) in enumerate(pairs)], "line_no int, position int, lon double, lat double")


def points_by_count(valid: DataFrame, n: int, seed: int = 0) -> DataFrame:
    """``n`` (above 0) of the valid pixels (frame_id, row, col), in hash order."""
    if n <= 0:
        raise ValueError(f"a number of points must be above 0, not {n}")
    hashed = valid.withColumn("_h", hash_order(seed, "frame_id", "row", "col")).withColumn("_k", F.concat_ws("|", "frame_id", "row", "col"))
    return numbered(hashed, "_h", "_k", n).select(*valid.columns)


def write_validation(tests: DataFrame, path: str, mode: str = "ignore") -> None:
    """A binned test as CSV with the columns of a validation table, bins in order and the total last."""
    shown = tests.orderBy((F.col("bin") < 0).cast("int"), "bin").select(
        F.format_string("%.2f-%.2f", "bin_lo", "bin_hi").alias("distance[km]"), F.col("n_total").alias("total_count[#]"), F.col("n_pass").alias("passed_req.[#]"), F.col("pass_ratio").alias("passed_pc"), F.col("success").alias("success_fail")
    )
    write_table(shown.coalesce(1), path, mode)  # a dozen rows


def write_layer(layer: DataFrame, path: str, mode: str = "ignore") -> None:
    """A velocity or a mask (pixel and its columns) as Parquet by frame, sorted by pixel; existing results stay."""
    layer.repartition("frame_id", F.expr("row div 64")).sortWithinPartitions("frame_id", "row", "col").write.mode(mode).partitionBy("frame_id").parquet(path)
