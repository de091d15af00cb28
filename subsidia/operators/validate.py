"""Requirement validation: pairs of stations and pixels, binned tests, outliers, screening of sampling."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from subsidia.functions.columns import hash_order, haversine_km, plane_km, requirement_mm
from subsidia.functions.stages import beside, cut, numbered, quantile
from subsidia.operators.pairs import pair_figures, ranked_differences


#: Pairs of a task where all pairs are the result: few enough to be sorted in memory.
TASK_PAIRS = 2_000_000


def station_pairs(stations: DataFrame, group: list[str] | None = None, within_km: float | None = None) -> DataFrame:
    """All unordered pairs of stations: distance in km and the absolute double difference GNSS against InSAR.

    With ``within_km`` only pairs up to that distance: stations meet in square cells of that width and their neighbours, by an
    equi-join, so pairs grow with the density of stations. Without it all pairs of a ``group`` are the result, which is quadratic; those
    of a whole table are dealt by station_1 in tasks of about ``TASK_PAIRS``, each against a copy of the stations.
    """
    keys = group or []
    if within_km is not None:
        cell = lambda c: F.floor(F.col(c) / (within_km * 1000)).cast("long")
        around = lambda c: F.explode(F.array(*[cell(c) + d for d in (-1, 0, 1)]))
        near = stations.withColumn("_cx", cell("x")).withColumn("_cy", cell("y"))
        far = stations.withColumn("_cx", around("x")).withColumn("_cy", around("y"))
        keys, stations = [*keys, "_cx", "_cy"], near
    else:
        far = stations
    a = stations.select(*keys, *[F.col(c).alias(f"{c}_1") for c in ("station", "x", "y", "gnss", "insar")])
    b = far.select(*keys, *[F.col(c).alias(f"{c}_2") for c in ("station", "x", "y", "gnss", "insar")])
    less = F.col("station_1") < F.col("station_2")
    if keys:
        pairs = a.join(b, keys).filter(less)
    else:
        tasks = max(stations.sparkSession.sparkContext.defaultParallelism, -(-stations.count() ** 2 // (2 * TASK_PAIRS)))
        pairs = a.repartition(tasks, "station_1").join(F.broadcast(b), less)
    pairs = pairs.select(*(group or []), F.col("station_1"), F.col("station_2"), plane_km(F.col("x_1"), F.col("y_1"), F.col("x_2"), F.col("y_2")).alias("distance"), F.abs((F.col("gnss_1") - F.col("gnss_2")) - (F.col("insar_1") - F.col("insar_2"))).alias("difference"))
    return pairs if within_km is None else pairs.filter(F.col("distance") <= within_km)


def edges(lo: float, hi: float, n: int) -> list[float]:
    """n + 1 edges, spaced as a linear sequence of floats has them."""
    return [lo + i * ((hi - lo) / n) for i in range(n)] + [hi]


def bins(spark: SparkSession, lo: float, hi: float, n: int) -> DataFrame:
    e = edges(lo, hi, n)
    return spark.createDataFrame([(i, e[i], e[i + 1]) for i in range(n)], "bin int, bin_lo double, bin_hi double")


def bin_of(distance: Column, lo: float, hi: float, n: int, closed: str = "right") -> Column:
    """The number of the bin of ``bins`` that holds a distance, NULL outside: a division, corrected by one at the bins' own edges."""
    at = F.array(*[F.lit(e) for e in edges(lo, hi, n)])
    guess = F.least(F.greatest(F.floor((distance - lo) / ((hi - lo) / n)), F.lit(0)), F.lit(n - 1)).cast("int")
    start, end = F.get(at, guess), F.get(at, guess + 1)
    low, high = (distance <= start, distance > end) if closed == "right" else (distance < start, distance >= end)
    inside = (distance > lo) & (distance <= hi) if closed == "right" else (distance >= lo) & (distance < hi)
    return F.when(inside, guess - low.cast("int") + high.cast("int"))


def binned_requirement_test(pairs: DataFrame, requirement: float = 5.0, bounds: tuple[float, float] = (0.1, 50.0), n_bins: int = 10, threshold: float = 0.683, closed: str = "right", empty: float | None = None) -> DataFrame:
    """Per distance bin (closed on the ``closed`` side) and in total (bin -1): n_total, n_pass (difference < requirement), pass_ratio, quantile
    (of the differences, at ``threshold``), success (ratio > threshold; an empty bin fails, unless ``empty`` gives it a ratio).

    Differences of NULL are left out; the total covers the bins only. The bin table has a fixed, small size. Pairs are counted by bin
    and by the difference's order of magnitude in one pass; a second one looks at the few magnitudes that hold a quantile.
    """
    table = bins(pairs.sparkSession, *bounds, n_bins)
    inside = pairs.filter("difference IS NOT NULL").select(bin_of(F.col("distance"), *bounds, n_bins, closed).alias("bin"), F.col("difference").cast("double").alias("_d")).filter("bin IS NOT NULL")
    inside = inside.withColumn("_m", F.when(F.col("_d") > 0, F.floor(F.log2("_d") * 256)).otherwise(-(2**40)))  # never falls as the difference grows
    magnitudes = inside.groupBy("bin", "_m").agg(F.count("*").alias("_c"), F.count_if(F.col("_d") < requirement).alias("_p"))
    magnitudes = magnitudes.withColumn("_g", F.explode(F.array("bin", F.lit(-1))))  # each bin, and the total
    group, upto = Window.partitionBy("_g"), Window.partitionBy("_g").orderBy("_m")
    at = (F.col("_n") - 1) * F.lit(float(threshold))
    low, high = F.floor(at), F.least(F.floor(at) + 1, F.col("_n") - 1)
    of = magnitudes.groupBy("_g", "_m").agg(F.sum("_c").alias("_c"), F.sum("_p").alias("_p"))
    ranked = of.withColumns({"_n": F.sum("_c").over(group), "_to": F.sum("_c").over(upto)})
    held = ranked.filter((F.col("_to") > low) & (F.col("_to") - F.col("_c") <= high)).select("_g", "_m", "_n", (F.col("_to") - F.col("_c")).alias("_before"))
    values = inside.groupBy("bin", "_m", "_d").agg(F.count("*").alias("_c"))
    values = values.withColumn("_g", F.explode(F.array("bin", F.lit(-1)))).join(F.broadcast(held), ["_g", "_m"])  # at most two magnitudes a bin
    values = values.groupBy("_g", "_n", "_d").agg(F.sum("_c").alias("_c"), F.min("_before").alias("_before"))
    values = values.withColumn("_to", F.min("_before").over(group) + F.sum("_c").over(Window.partitionBy("_g").orderBy("_d")))
    ends = values.groupBy("_g", "_n").agg(F.min(F.when(F.col("_to") > low, F.col("_d"))).alias("_a"), F.min(F.when(F.col("_to") > high, F.col("_d"))).alias("_b"))
    quantiles = ends.select(F.col("_g").alias("bin"), (F.col("_a") + (F.col("_b") - F.col("_a")) * (at - F.floor(at))).alias("quantile"))
    counted = of.groupBy(F.col("_g").alias("bin")).agg(F.sum("_c").alias("n_total"), F.sum("_p").alias("n_pass")).join(quantiles, "bin")
    return _judged(table, counted, bounds, threshold, empty)


def station_requirement_test(stations: DataFrame, requirement: float = 5.0, bounds: tuple[float, float] = (0.1, 50.0), n_bins: int = 10, threshold: float = 0.683, closed: str = "right", empty: float | None = None) -> DataFrame:
    """``binned_requirement_test`` of all pairs of stations (x, y, gnss, insar), without rows for the pairs."""
    spark = stations.sparkSession
    share = lambda n: (n - 1) * float(threshold)
    found = ranked_differences(stations, edges(*bounds, n_bins), lambda n: [math.floor(share(n)), min(math.floor(share(n)) + 1, n - 1)], "gnss", "insar", closed, requirement)
    rows = [(g, n, p, a + (b - a) * (share(n) - math.floor(share(n)))) for g, (n, p, (a, b)) in found.items()]
    counted = spark.createDataFrame(rows, "bin int, n_total long, n_pass long, quantile double")  # a row a bin
    return _judged(bins(spark, *bounds, n_bins), counted, bounds, threshold, empty)


def _judged(table: DataFrame, counted: DataFrame, bounds: tuple[float, float], threshold: float, empty: float | None) -> DataFrame:
    frame = table.unionByName(table.sparkSession.createDataFrame([(-1, bounds[0], bounds[1])], table.schema))
    out = frame.join(counted, "bin", "left").withColumn("n_total", F.coalesce("n_total", F.lit(0))).withColumn("n_pass", F.coalesce("n_pass", F.lit(0)))
    ratio = F.when(F.col("n_total") > 0, F.col("n_pass") / F.col("n_total")).otherwise(F.lit(empty).cast("double"))
    return out.withColumn("pass_ratio", ratio).withColumn("success", F.coalesce(F.col("pass_ratio") > threshold, F.lit(False)))


def sparse_flag(count: Column, passed: Column, min_points: int = 20) -> Column:
    return F.when(count < min_points, "SPARSE").when(passed, "PASSED").otherwise("FAILED")


def sample_pairs(points: DataFrame, num_samples: int, seed: int = 0, key: str = "id", geographic: bool = False) -> DataFrame:
    """Pairs of a random sample without replacement: pair, distance (km), difference (absolute).

    Points are ordered by a hash; the first ``num_samples`` are paired in turn and an odd one out is dropped. The sample is the
    operator's purpose and its size a parameter; ties of the hash go by key. Points are numbered within buckets of the hash.
    ``geographic`` takes x and y as longitude and latitude, with distances along great circles.
    """
    chosen = points.filter("v IS NOT NULL").withColumn("_h", hash_order(seed, key))
    ranked = numbered(chosen, "_h", key, num_samples).withColumn("pair", F.expr("_rn div 2"))
    side = lambda c, odd: F.max(F.when(F.col("_rn") % 2 == odd, F.col(c))).alias(f"{c}_{odd}")
    both = ranked.groupBy("pair").agg(F.count("*").alias("_n"), *[side(c, k) for c in ("x", "y", "v") for k in (0, 1)]).filter("_n = 2")
    x0, y0, x1, y1 = (F.col(c) for c in ("x_0", "y_0", "x_1", "y_1"))
    distance = haversine_km(y0, x0, y1, x1) if geographic else plane_km(x0, y0, x1, y1)
    return both.select("pair", "x_0", "y_0", "x_1", "y_1", distance.alias("distance"), F.abs(F.col("v_0") - F.col("v_1")).alias("difference"))


def outlier_mask(layer: DataFrame, method: str = "zscore", threshold: float = 3.0, by: list[str] | None = None) -> DataFrame:
    """Adds outlier: z-score by population deviation, or 0.6745 |v - median| / MAD (``modified``), above ``threshold``.

    Only valid values count; no data is no outlier. With MAD 0 every value off the median is one.
    """
    by = by or ["frame_id"]
    valid = layer.filter("value IS NOT NULL")
    if method == "zscore":
        s = valid.groupBy(*by).agg(F.avg("value").alias("_m"), F.stddev_pop("value").alias("_s"))
        test = F.abs(F.col("value") - F.col("_m")) / F.nullif("_s", F.lit(0.0)) > threshold
    else:
        m = beside(quantile(valid, by, "value", 0.5, "_m"))
        s = m.join(quantile(valid.join(m, by).withColumn("_o", F.abs(F.col("value") - F.col("_m"))), by, "_o", 0.5, "_s"), by)
        off = F.abs(F.col("value") - F.col("_m"))
        test = F.when(F.col("_s") == 0, off > 0).otherwise(0.6745 * off / F.col("_s") > threshold)
    return layer.join(beside(s), by, "left").withColumn("outlier", F.coalesce(test, F.lit(False))).drop("_m", "_s")


def requirement_limit(pairs: DataFrame, direction: str = "passing", bounds: tuple[float, float] = (0.1, 50.0), threshold: float = 0.683, step: float = 0.01, compat: bool = False, closed: str = "right") -> DataFrame:
    """The smallest requirement (in steps) that the pairs pass, or the largest that they fail.

    A requirement passes if more than ``threshold`` of the differences lie below it, so it lies just above one order statistic,
    and the step that holds this one is all that matters: differences are counted by step, and the steps' counts are summed.
    ``compat`` returns the value one step further, as a loop that tests before it steps does. ``closed`` names the closed side of the range.
    """
    d = F.col("distance")
    held = (d > bounds[0]) & (d <= bounds[1]) if closed == "right" else (d >= bounds[0]) & (d < bounds[1])
    counts = pairs.filter(held & F.col("difference").isNotNull()).groupBy(_step(step).alias("k")).agg(F.count("*").alias("c"))
    steps = Window.orderBy("k")  # one row a step of a hundredth: thousands, whatever the number of pairs
    summed = counts.withColumn("upto", F.sum("c").over(steps)).withColumn("n", F.sum("c").over(steps.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    at = summed.filter(F.col("upto") > F.col("n") * threshold).agg(F.min("k").alias("k"))
    return _limit(at, direction, step, compat)


def station_requirement_limit(stations: DataFrame, direction: str = "passing", bounds: tuple[float, float] = (0.1, 50.0), threshold: float = 0.683, step: float = 0.01, compat: bool = False, closed: str = "right") -> DataFrame:
    """``requirement_limit`` of all pairs of stations (x, y, gnss, insar), without rows for the pairs."""
    found = ranked_differences(stations, list(bounds), lambda n: [min(math.floor(n * threshold), n - 1)], "gnss", "insar", closed)
    at = stations.sparkSession.createDataFrame([(found[-1][2][0] if found else None,)], "difference double")
    return _limit(at.select(_step(step).alias("k")), direction, step, compat)


def _step(step: float) -> Column:
    return F.floor(F.round(F.col("difference") / step, 9))


def _limit(at: DataFrame, direction: str, step: float, compat: bool) -> DataFrame:
    k = F.col("k") + 1
    value = k if direction == "passing" else k - 1
    return at.select(F.round((value + (1 if direction == "passing" else -1) * int(compat)) * step, 9).alias("limit"))


def transient_requirement_test(pairs: DataFrame, bounds: tuple[float, float] = (0.1, 50.0), n_bins: int = 10, threshold: float = 0.683, compat: bool = False) -> DataFrame:
    """Per interferogram (ifg) and distance bin (left-closed), with the total as bin -1: n_total, n_pass, pass_ratio, success.

    A difference passes below the requirement at its distance. ``compat`` leaves the last bin out of the total.
    """
    inside = pairs.filter("difference IS NOT NULL").withColumn("bin", bin_of(F.col("distance"), *bounds, n_bins, "left")).filter("bin IS NOT NULL")
    per = inside.groupBy("ifg", "bin").agg(F.count("*").alias("n_total"), F.count_if(F.col("difference") < requirement_mm(F.col("distance"))).alias("n_pass"))
    return _with_total(per, n_bins - int(compat), threshold)


def transient_station_test(stations: DataFrame, bounds: tuple[float, float] = (0.1, 50.0), n_bins: int = 10, threshold: float = 0.683, compat: bool = False) -> DataFrame:
    """``transient_requirement_test`` of all pairs of an interferogram's stations (ifg, x, y, gnss, insar), without rows for the pairs."""
    import numpy as np

    found = pair_figures(stations, edges(*bounds, n_bins), ["ifg"], "gnss", "insar", "left", lambda d: 3 * (1 + np.sqrt(d)))
    return _with_total(found.select("ifg", "bin", F.col("n").alias("n_total"), "n_pass"), n_bins - int(compat), threshold)


def _with_total(per: DataFrame, n_bins: int, threshold: float) -> DataFrame:
    total = per.filter(F.col("bin") < n_bins).groupBy("ifg").agg(F.lit(-1).alias("bin"), F.sum("n_total").alias("n_total"), F.sum("n_pass").alias("n_pass"))
    out = per.unionByName(total).withColumn("pass_ratio", F.col("n_pass") / F.col("n_total"))
    return out.withColumn("success", F.col("pass_ratio") > threshold)


def stack_verdict(results: DataFrame, share: float = 0.7, use_mean: bool = False, n_bins: int = 10, threshold: float = 0.683) -> DataFrame:
    """One row: interferograms, how many pass, their share and the verdict. ``use_mean`` judges by the mean ratio of the bins,
    which an empty bin leaves without a verdict."""
    if use_mean:
        per = results.filter("bin >= 0").groupBy("ifg").agg(F.avg("pass_ratio").alias("r"), F.count("*").alias("n")).select("ifg", (F.coalesce((F.col("n") == n_bins) & (F.col("r") > threshold), F.lit(False))).alias("success"))
    else:
        per = results.filter("bin = -1").select("ifg", "success")
    out = per.agg(F.count("*").alias("n_ifg"), F.count_if("success").alias("n_pass"))
    return out.withColumn("share", F.col("n_pass") / F.nullif("n_ifg", F.lit(0))).withColumn("verdict", F.coalesce(F.col("share") >= share, F.lit(False)))


def temporal_sampling(dates: DataFrame, gap_days: int = 12, share: float = 0.8, years: float = 4.0) -> DataFrame:
    """Per frame: share of gaps of at most ``gap_days``, span in years, and whether both criteria hold (both inclusive)."""
    d = dates.select("frame_id", "obs_date").distinct()
    gap = F.datediff("obs_date", F.lag("obs_date").over(Window.partitionBy("frame_id").orderBy("obs_date")))
    s = d.withColumn("gap", gap).groupBy("frame_id").agg(F.avg((F.col("gap") <= gap_days).cast("double")).alias("share"), (F.datediff(F.max("obs_date"), F.min("obs_date")) / 365.25).alias("years"))
    return s.withColumn("success", F.coalesce((F.col("share") >= share) & (F.col("years") >= years), F.lit(False)))


def pass_rates(summary: DataFrame, approaches: tuple[str, ...] = ("va1", "va2")) -> DataFrame:
    """PASS of PASS and FAIL in whole percent for each approach; other labels don't count."""
    stacked = F.explode(F.array(*[F.struct(F.lit(a).alias("approach"), F.col(a).alias("label")) for a in approaches])).alias("s")
    s = summary.select(stacked).select("s.*").filter(F.col("label").isin("PASS", "FAIL"))
    return s.groupBy("approach").agg(F.count_if(F.col("label") == "PASS").alias("n_pass"), F.count("*").alias("n"), F.round(100 * F.count_if(F.col("label") == "PASS") / F.count("*")).cast("int").alias("percent"))


def station_residuals(stations: DataFrame, reference) -> DataFrame:
    """GNSS less InSAR, both relative to the reference station; stations without InSAR are not used (used = False).

    A reference without InSAR leaves InSAR as it is.
    """
    ref = stations.filter(F.col("station") == reference).select(F.col("gnss").alias("_g"), F.coalesce("insar", F.lit(0.0)).alias("_i"))
    s = stations.crossJoin(F.broadcast(ref.limit(1)))
    s = s.withColumn("gnss", F.col("gnss") - F.col("_g")).withColumn("insar", F.col("insar") - F.col("_i"))
    return s.select("station", "gnss", "insar", (F.col("gnss") - F.col("insar")).alias("residual"), F.col("insar").isNotNull().alias("used"))
