"""Product catalogues: parsing of names, de-duplication, mini-stacks, selection of pairs and frames."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from subsidia.functions.columns import version_key


def parse_products(paths: DataFrame) -> DataFrame:
    """One row a product, from the parts of its file name (10 parts with the production time); other names are left out."""
    name = F.regexp_replace(F.regexp_extract("path", r"([^/]+)$", 1), r"\.[A-Za-z0-9]+$", "")
    p = F.split(name, "_")
    day = lambda i: F.to_date(F.substring(p[i], 1, 8), "yyyyMMdd")
    kept = paths.filter(F.size(p) == 10)
    return kept.select(
        "path", p[0].alias("project"), p[1].alias("level"), p[2].alias("product"), p[3].alias("mode"), F.regexp_extract(p[4], r"(\d+)", 1).cast("int").alias("frame_id"),
        p[5].alias("polarization"), day(6).alias("ref_date"), day(7).alias("sec_date"), F.regexp_replace(p[8], "^v", "").alias("version"),
        F.to_timestamp(p[9], "yyyyMMdd'T'HHmmss'Z'").alias("production_ts"),
    )


def product_listing(products: DataFrame, frame_id: int, version: str, start: str, end: str) -> DataFrame:
    """The latest product (in name order) of each name without its last two parts, with both dates in [start, end]."""
    key = F.regexp_replace("path", r"_[^_]*_[^_]*$", "")
    wanted = products.filter((F.col("frame_id") == frame_id) & (F.col("version") == version))
    last = wanted.groupBy(key.alias("key")).agg(F.max("path").alias("path"))
    s, e = F.lit(start).cast("date"), F.lit(end).cast("date")
    return products.join(last, "path", "left_semi").filter(F.col("ref_date").between(s, e) & F.col("sec_date").between(s, e))


def filter_products(products: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """By the secondary date only, both bounds inclusive."""
    if start:
        products = products.filter(F.col("sec_date") >= F.lit(start).cast("date"))
    if end:
        products = products.filter(F.col("sec_date") <= F.lit(end).cast("date"))
    return products


def filter_steps(steps: DataFrame, start: str, end: str) -> DataFrame:
    """Steps strictly inside the period."""
    return steps.filter((F.col("step_date") > F.lit(start).cast("date")) & (F.col("step_date") < F.lit(end).cast("date")))


def single_version(products: DataFrame) -> DataFrame:
    """Per frame: the number of versions and whether there is just one."""
    return products.groupBy("frame_id").agg(F.countDistinct("version").alias("n_versions"), F.max_by("version", version_key(F.col("version"))).alias("latest")).withColumn("single", F.col("n_versions") == 1)


def assert_single_version(products: DataFrame) -> DataFrame:
    """The products, or an error if they mix versions."""
    found = sorted(r["version"] for r in products.select("version").distinct().limit(10).collect())
    if len(found) > 1:
        raise ValueError(f"products of several versions: {', '.join(found)}")
    return products


def dedupe_products(products: DataFrame) -> DataFrame:
    """The newest production of each pair of dates in a frame; of equal times the first path."""
    newest = Window.partitionBy("frame_id", "ref_date", "sec_date").orderBy(F.desc("production_ts"), "path")
    return products.withColumn("_n", F.row_number().over(newest)).filter("_n = 1").drop("_n")


def ministacks(products: DataFrame) -> DataFrame:
    """Runs of products (by secondary date) with one reference date: adds stack, first, last and mask (the last one)."""
    order = Window.partitionBy("frame_id").orderBy("sec_date", "path")
    new = F.when(F.lag("ref_date").over(order).eqNullSafe(F.col("ref_date")), 0).otherwise(1)
    p = products.withColumn("_new", new).withColumn("stack", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0)).cast("int"))
    inside = Window.partitionBy("frame_id", "stack")
    up, down = F.row_number().over(inside.orderBy("sec_date", "path")), F.row_number().over(inside.orderBy(F.desc("sec_date"), F.desc("path")))
    return p.withColumn("first", up == 1).withColumn("last", down == 1).withColumn("mask", F.col("last")).drop("_new")


def independent_pairs(pairs: DataFrame, gap_days: int = 12) -> DataFrame:
    """Pairs (ifg by end date) whose gap to the pair before is at most ``gap_days``; of a chain that shares dates every second goes."""
    order = Window.partitionBy("frame_id").orderBy("sec_date", "ref_date")
    gap = F.coalesce(F.datediff("sec_date", F.lag("sec_date").over(order)), F.datediff("sec_date", "ref_date"))
    p = pairs.select("frame_id", "ref_date", "sec_date").distinct().withColumn("gap", gap).filter(F.col("gap") <= gap_days)
    new = F.when(F.lag("sec_date").over(order) > F.col("ref_date"), 0).when(F.lag("sec_date").over(order) == F.col("ref_date"), 0).otherwise(1)
    p = p.withColumn("_new", new).withColumn("island", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    at = F.row_number().over(Window.partitionBy("frame_id", "island").orderBy("sec_date", "ref_date"))
    return p.withColumn("_at", at).filter("_at % 2 = 1").select("frame_id", "ref_date", "sec_date", "gap")


def match_ancillary(ancillary: DataFrame, products: DataFrame) -> DataFrame:
    """Only ancillary layers whose pair of dates has a displacement product."""
    return ancillary.join(products, ["frame_id", "ref_date", "sec_date"], "left_semi")


def date_list(products: DataFrame) -> DataFrame:
    """All reference and secondary dates of each frame."""
    return products.select("frame_id", F.col("ref_date").alias("obs_date")).union(products.select("frame_id", "sec_date")).distinct()


def consistent_burst_dates(bursts: DataFrame, least: int = 3, least_common: int = 2) -> DataFrame:
    """Bursts with at least ``least`` dates, the dates that all of them have, then bursts that keep ``least_common`` of these.

    Repeated rows of a burst and date count once.
    """
    d = bursts.select("burst_id", "date").distinct()
    rich = d.join(d.groupBy("burst_id").count().filter(F.col("count") >= least), "burst_id", "left_semi")
    n = rich.agg(F.countDistinct("burst_id").alias("n"))
    common = rich.groupBy("date").agg(F.count("*").alias("c")).join(F.broadcast(n), F.col("c") == F.col("n"), "left_semi")
    kept = rich.join(common, "date", "left_semi")
    return kept.join(kept.groupBy("burst_id").count().filter(F.col("count") >= least_common), "burst_id", "left_semi")


def burst_to_frames(bursts: DataFrame, frame_ids: list[int] | None = None) -> DataFrame:
    """One row a burst and frame, burst ids in lower case."""
    b = bursts.select(F.lower("burst_id").alias("burst_id"), "date", F.explode("frame_ids").alias("frame_id"))
    return b.filter(F.col("frame_id").isin(frame_ids)) if frame_ids is not None else b


def most_common_frame(bursts: DataFrame) -> DataFrame:
    """The frame with the most bursts, the smallest id of equals."""
    return burst_to_frames(bursts).groupBy("frame_id").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "frame_id").limit(1)


def contiguous_frames(products: DataFrame) -> DataFrame:
    """Pairs of dates whose frame numbers follow one another without a gap: first and last frame."""
    g = products.groupBy("ref_date", "sec_date").agg(F.min("frame_id").alias("first_frame"), F.max("frame_id").alias("last_frame"), F.countDistinct("frame_id").alias("n_frames"))
    return g.filter(F.col("last_frame") - F.col("first_frame") == F.col("n_frames") - 1)


def append_bursts(known: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Known records and those new ones whose key isn't known; one row a key."""
    both = known.withColumn("_o", F.lit(0)).unionByName(new.withColumn("_o", F.lit(1)))
    rest = [c for c in known.columns if c not in keys]
    order = F.struct("_o", *rest)
    return both.groupBy(*keys).agg(F.min_by(F.struct(*rest), order).alias("r")).select(*keys, "r.*") if rest else both.select(*keys).distinct()


def by_date(products: DataFrame) -> DataFrame:
    """Adds the position of each product of a frame in the order of secondary date, then path."""
    return products.withColumn("position", F.row_number().over(Window.partitionBy("frame_id").orderBy("sec_date", "path")))


def first_last_range(layers: DataFrame) -> DataFrame:
    """The common scale of the first and last pair of each frame: min and max of both."""
    ends = layers.groupBy("frame_id").agg(F.min("sec_date").alias("a"), F.max("sec_date").alias("b"))
    at = layers.join(ends, "frame_id").filter((F.col("sec_date") == F.col("a")) | (F.col("sec_date") == F.col("b")))
    return at.groupBy("frame_id").agg(F.min("value").alias("low"), F.max("value").alias("high"))
