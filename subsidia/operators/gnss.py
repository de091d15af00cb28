"""GNSS stations: parsing, screening, sampling of rasters at stations, alignment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from subsidia.functions.columns import los, point_in_ring
from subsidia.operators.windows import window_sums


def stations_in_frame(stations: DataFrame, frames: DataFrame) -> DataFrame:
    """(frame_id, station): stations strictly inside a frame's ring.

    Stations and frames meet in cells of one degree, so the join is an equi-join; the box, then the ring decide.
    """
    box = frames.select("frame_id", "ring", *[f(F.transform("ring", lambda p, c=None: p["lon"])).alias(n) for f, n in ((F.array_min, "lon0"), (F.array_max, "lon1"))], *[f(F.transform("ring", lambda p, c=None: p["lat"])).alias(n) for f, n in ((F.array_min, "lat0"), (F.array_max, "lat1"))])
    degree = lambda c: F.floor(c).cast("int")
    spread = lambda a, b: F.explode(F.sequence(degree(a), degree(b)))
    cells = box.withColumn("_cx", spread("lon0", "lon1")).withColumn("_cy", spread("lat0", "lat1"))
    near = stations.withColumn("_cx", degree("lon")).withColumn("_cy", degree("lat")).join(cells, ["_cx", "_cy"])
    near = near.filter(F.col("lon").between(F.col("lon0"), F.col("lon1")) & F.col("lat").between(F.col("lat0"), F.col("lat1")))
    return near.filter(point_in_ring(F.col("lon"), F.col("lat"), F.col("ring"))).select("frame_id", "station")


def rectangle(lon: tuple[float, float], lat: tuple[float, float]) -> list[tuple[float, float]]:
    return [(lon[0], lat[0]), (lon[1], lat[0]), (lon[1], lat[1]), (lon[0], lat[1])]


def frames_touching(frames: DataFrame, polygon: list[tuple[float, float]], orbit_pass: str | None = None) -> DataFrame:
    """Frames (of one orbit pass) that meet a polygon of (lon, lat) corners: a corner of one inside the other, or crossing edges."""
    corners = [(float(x), float(y)) for x, y in polygon]
    if corners[0] == corners[-1]:
        corners = corners[:-1]
    if orbit_pass is not None:
        frames = frames.filter(F.upper("orbit_pass") == orbit_pass.upper())
    area = F.array(*[F.struct(F.lit(x).alias("lon"), F.lit(y).alias("lat")) for x, y in [*corners, corners[0]]])
    holds = F.lit(False)
    for x, y in corners:
        holds = holds | point_in_ring(F.lit(float(x)), F.lit(float(y)), F.col("ring"))
    inside = F.exists("ring", lambda p: point_in_ring(p["lon"], p["lat"], area))
    sides = F.zip_with(F.slice("ring", F.lit(1), F.size("ring") - 1), F.slice("ring", F.lit(2), F.size("ring") - 1), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    crossing = F.lit(False)
    for (x1, y1), (x2, y2) in zip(corners, corners[1:] + corners[:1], strict=True):
        crossing = crossing | F.exists(sides, _crosses(x1, y1, x2, y2))
    return frames.filter(inside | holds | crossing)


def _crosses(x1, y1, x2, y2):
    def side(px, py, qx, qy, rx, ry):
        return F.signum((qx - px) * (ry - py) - (qy - py) * (rx - px))

    def test(e):
        ax, ay, bx, by = e["a"]["lon"], e["a"]["lat"], e["b"]["lon"], e["b"]["lat"]
        x, y, u, v = (F.lit(float(k)) for k in (x1, y1, x2, y2))
        overlap = (F.greatest(ax, bx) >= F.least(x, u)) & (F.least(ax, bx) <= F.greatest(x, u)) & (F.greatest(ay, by) >= F.least(y, v)) & (F.least(ay, by) <= F.greatest(y, v))
        return overlap & (side(ax, ay, bx, by, x, y) * side(ax, ay, bx, by, u, v) <= 0) & (side(x, y, u, v, ax, ay) * side(x, y, u, v, bx, by) <= 0)

    return test


def exclude(stations: DataFrame, *rejected: DataFrame) -> DataFrame:
    """Stations on none of the lists (of station, or of frame_id and station)."""
    for r in rejected:
        stations = stations.join(r, [c for c in ("frame_id", "station") if c in r.columns], "left_anti")
    return stations


def completeness(obs: DataFrame, start: str, end: str, ratio: float = 0.8) -> DataFrame:
    """Per station: days with a solution in the period (inclusive), and whether they reach the share of its length."""
    s, e = F.lit(start).cast("date"), F.lit(end).cast("date")
    n = obs.filter(F.col("obs_date").between(s, e)).groupBy("station").agg(F.count("*").alias("n_days"))
    return n.withColumn("complete", F.col("n_days") >= F.datediff(e, s) * ratio)


def solution_density(stations: DataFrame, threshold: float = 0.3) -> DataFrame:
    """Stations with density (solutions over the days from first to last) and dense: whether it is above the threshold."""
    days = F.datediff("last_date", "first_date")
    return stations.withColumn("density", F.col("num_solution") / F.nullif(days, F.lit(0))).withColumn("dense", F.coalesce(F.col("density") > threshold, F.lit(False)))


def coverage(obs: DataFrame, start: str, end: str, density: float = 0.8, ratio: float = 0.8) -> DataFrame:
    """Per station, from the days strictly inside the period: density (days over their span), ratio (span over the period), and
    covered: whether both reach their thresholds."""
    s, e = F.lit(start).cast("date"), F.lit(end).cast("date")
    span = F.datediff(F.max("obs_date"), F.min("obs_date"))
    g = obs.filter((F.col("obs_date") > s) & (F.col("obs_date") < e)).groupBy("station").agg((F.count("*") / F.nullif(span, F.lit(0))).alias("density"), (span / F.nullif(F.datediff(e, s), F.lit(0))).alias("ratio"))
    return g.withColumn("covered", F.coalesce((F.col("density") >= density) & (F.col("ratio") >= ratio), F.lit(False)))


def mean_geometry(angles: DataFrame) -> DataFrame:
    """Per frame the mean incidence and azimuth of the pixels where both are physical: incidence in (0, 90], azimuth in [-360, 360]."""
    real = (F.col("incidence") > 0) & (F.col("incidence") <= 90) & F.col("azimuth").between(-360, 360)
    return angles.filter(real).groupBy("frame_id").agg(F.avg("incidence").alias("incidence"), F.avg("azimuth").alias("azimuth"), F.count("*").alias("n"))


def projectable(obs: DataFrame, least: int = 2) -> DataFrame:
    """The series of stations with at least ``least`` epochs whose three components are all finite, less their other epochs."""
    finite = F.lit(True)
    for c in ("east", "north", "up"):
        finite = finite & F.coalesce(~F.isnan(c) & (F.abs(c) < float("inf")), F.lit(False))
    kept = obs.filter(finite)
    return kept.join(kept.groupBy("station").agg(F.countDistinct("obs_date").alias("_n")).filter(F.col("_n") >= least).select("station"), "station", "left_semi")


def scatter(obs: DataFrame, incidence: float = 40.0, azimuth: float = 100.0, threshold: float = 10.0) -> DataFrame:
    """Deviation of each station's LOS series from its linear trend over the sample number (not time), in the series' unit."""
    order = Window.partitionBy("station").orderBy("obs_date")
    o = obs.withColumn("_v", los(F.col("east"), F.col("north"), F.col("up"), F.lit(incidence), F.lit(azimuth))).filter("_v IS NOT NULL")
    o = o.withColumn("_k", F.row_number().over(order).cast("double"))
    g = o.groupBy("station").agg(F.count("*").alias("n"), F.regr_syy("_v", "_k").alias("_yy"), F.regr_sxy("_v", "_k").alias("_xy"), F.regr_sxx("_v", "_k").alias("_xx"))
    left = F.greatest(F.col("_yy") - F.coalesce(F.col("_xy") * F.col("_xy") / F.nullif("_xx", F.lit(0.0)), F.lit(0.0)), F.lit(0.0))
    return g.select("station", "n", F.sqrt(left / F.col("n")).alias("scatter")).withColumn("kept", F.col("scatter") <= threshold)


# Equipment steps that spoil a series, as step logs name them.
PROBLEM_TYPES = ("Antenna_detached_from_monument", "Equipment_Site_Change", "Antenna_Changed", "Antenna_change", "Antenna_Code_Changed")


def problem_steps(steps: DataFrame, start: str, end: str, magnitude: float = 5.0, distance_km: float | None = None, types: tuple[str, ...] = PROBLEM_TYPES, earthquakes: bool = True) -> DataFrame:
    """Stations and days with an equipment step of one of ``types``, or an earthquake above a magnitude (and within a distance).

    Both bounds of the period are inside. ``earthquakes`` = False leaves equipment only.
    """
    inside = F.col("step_date").between(F.lit(start).cast("date"), F.lit(end).cast("date"))
    quake = F.lit(earthquakes) & (F.col("code") == 2) & (F.col("magnitude") > magnitude)
    if distance_km is not None:
        quake = quake & (F.col("distance_km") <= distance_km)
    return steps.filter(inside & (((F.col("code") == 1) & F.col("type_threshold").isin(*types)) | quake)).select("station", "step_date").distinct()


def sample_at_stations(stations: DataFrame, layer: DataFrame, radius: int = 0, how: str = "median", asymmetric: bool = False) -> DataFrame:
    """The layer around each station (frame_id, station, row, col): median or mean of a window of pixels; stations without any drop out.

    Means come from summed-area tables; for medians the window is exploded to pixels, so that join is an equi-join. ``asymmetric``
    leaves the window's last row and column out.
    """
    behind = radius - int(asymmetric and radius > 0)
    if how == "mean":
        at = stations.select(F.struct("frame_id", "station").alias("pid"), "frame_id", "row", "col")
        sums = window_sums(at, layer.select("frame_id", "row", "col", "value"), ["value"], radius, behind)
        return sums.select("pid.frame_id", "pid.station", (F.col("value") / F.col("n")).alias("value"))
    offsets = F.sequence(F.lit(-radius), F.lit(behind))
    cells = stations.select("frame_id", "station", "row", "col").withColumn("dr", F.explode(offsets)).withColumn("dc", F.explode(offsets))
    cells = cells.select("frame_id", "station", (F.col("row") + F.col("dr")).alias("row"), (F.col("col") + F.col("dc")).alias("col"))
    return cells.join(layer.select("frame_id", "row", "col", "value"), ["frame_id", "row", "col"]).groupBy("frame_id", "station").agg(F.median("value").alias("value")).filter("value IS NOT NULL")


def align_series(gnss: DataFrame, insar: DataFrame) -> DataFrame:
    """(station, obs_date, gnss, insar): GNSS less its median, InSAR less the median of their differences on common dates."""
    g = gnss.join(gnss.groupBy("station").agg(F.median("value").alias("_m")), "station").select("station", "obs_date", (F.col("value") - F.col("_m")).alias("gnss"))
    both = insar.select("station", "obs_date", F.col("value").alias("insar")).join(g, ["station", "obs_date"])
    shift = both.groupBy("station").agg(F.coalesce(F.median(F.col("insar") - F.col("gnss")), F.lit(0.0)).alias("_s"))
    return both.join(shift, "station").select("station", "obs_date", "gnss", (F.col("insar") - F.col("_s")).alias("insar"))


def detect_steps(obs: DataFrame, value: str = "east", window: int = 10, threshold: float = 0.1) -> DataFrame:
    """Jumps of a series: local peaks of the absolute day-to-day change from two deviations on, whose means before and after differ.

    kind: ``step``, or ``stair`` where the window after next stays within half the threshold.
    """
    w = Window.partitionBy("station").orderBy("obs_date")
    o = obs.filter(F.col(value).isNotNull()).withColumn("_d", F.abs(F.col(value) - F.lag(value).over(w)))
    o = o.withColumn("_sd", F.stddev_pop("_d").over(Window.partitionBy("station")))
    mean = lambda a, b: F.avg(value).over(w.rowsBetween(a, b))
    o = o.withColumn("_before", mean(-window, -1)).withColumn("_after", mean(0, window - 1)).withColumn("_next", mean(window, 2 * window - 1))
    peak = (F.col("_d") >= 2 * F.col("_sd")) & (F.col("_d") > F.coalesce(F.lag("_d").over(w), F.lit(-1.0))) & (F.col("_d") >= F.coalesce(F.lead("_d").over(w), F.lit(-1.0)))
    o = o.withColumn("_peak", peak)
    change = F.abs(F.col("_after") - F.col("_before")) / F.nullif(F.abs("_before"), F.lit(0.0))
    later = F.abs(F.col("_next") - F.col("_after")) / F.nullif(F.abs("_after"), F.lit(0.0))
    found = o.filter(F.col("_peak") & (change > threshold))
    return found.select("station", "obs_date", change.alias("change"), F.when(later < threshold / 2, "stair").otherwise("step").alias("kind"))


def transient_stations(obs: DataFrame, pairs: DataFrame, least: int = 3) -> DataFrame:
    """(ifg, station): stations with a solution on every day of an interferogram (ifg, ref_date, sec_date), where at least ``least`` have."""
    inside = obs.select("station", "obs_date").distinct().join(_days(pairs), "obs_date")
    full = inside.groupBy("ifg", "station", "ref_date", "sec_date").agg(F.count("*").alias("n")).filter(F.col("n") == F.datediff("sec_date", "ref_date") + 1)
    return full.withColumn("n_stations", F.count("*").over(Window.partitionBy("ifg"))).filter(F.col("n_stations") >= least).select("ifg", "station", "n_stations")


def _days(pairs: DataFrame) -> DataFrame:
    """A row for each day of an interferogram (tens of days), so that series meet it by day."""
    return pairs.withColumn("obs_date", F.explode(F.sequence("ref_date", "sec_date")))


def transient_displacement(obs: DataFrame, selected: DataFrame, pairs: DataFrame, value: Column, seed: int = 0) -> DataFrame:
    """(ifg, station, displacement, relative): last less first position inside the pair, also relative to one station chosen by hash."""
    from subsidia.functions.columns import hash_order

    o = obs.join(_days(selected.join(pairs, "ifg")), ["station", "obs_date"]).withColumn("_v", value)
    d = o.groupBy("ifg", "station").agg((F.max_by("_v", "obs_date") - F.min_by("_v", "obs_date")).alias("displacement"))
    ref = d.withColumn("_h", hash_order(seed, "ifg", "station")).groupBy("ifg").agg(F.min_by("displacement", "_h").alias("_ref"))
    return d.join(ref, "ifg").select("ifg", "station", "displacement", (F.col("displacement") - F.col("_ref")).alias("relative"))
