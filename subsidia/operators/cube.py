"""Cubes and layers: series along date graphs, referencing, masks, reliability, corrections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subsidia.functions.columns import pixel_index
from subsidia.functions.stages import quantile

PIXEL = ["frame_id", "row", "col"]


def ingest(obs: DataFrame) -> DataFrame:
    """Applies the no-data rule: 0 and NaN become NULL."""
    return obs.withColumn("value", F.when(F.isnan("value") | (F.col("value") == 0), None).otherwise(F.col("value")))


def read_cube(obs: DataFrame, frame_id=None, layer=None, dates=None, rows=None, cols=None) -> DataFrame:
    """A window of a cube. Every bound is a plain comparison, so it reaches partitions and row groups."""
    for column, value in (("frame_id", frame_id), ("layer", layer)):
        if value is not None:
            obs = obs.filter(F.col(column) == value)
    for column, bounds in (("obs_date", dates), ("row", rows), ("col", cols)):
        if bounds is not None:
            obs = obs.filter(F.col(column).between(F.lit(bounds[0]), F.lit(bounds[1])))
    return obs


def layer_mean(obs: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Mean over time of each pixel, NULLs skipped."""
    return obs.groupBy(*(by or PIXEL)).agg(F.avg("value").alias("value"))


def density(obs: DataFrame) -> DataFrame:
    """Valid epochs over all epochs but the first, which is zero everywhere: n_valid, n_epochs, density.

    The number of epochs is one per frame; it is counted from distinct dates, without a window over the cube.
    """
    epochs = obs.groupBy("frame_id").agg(F.countDistinct("obs_date").alias("n_epochs"))
    valid = obs.groupBy(*PIXEL).agg(F.count("value").alias("n_valid"))
    return valid.join(epochs, "frame_id").withColumn("density", F.col("n_valid") / F.nullif(F.col("n_epochs") - 1, F.lit(0)))


def reliability_mask(obs: DataFrame, ratio: float = 0.9, rule: str = "count") -> DataFrame:
    """Pixels with enough valid epochs. ``count``: at least floor((n - 1) * ratio); ``density``: share from ``ratio`` on."""
    return density(obs).select(*PIXEL, reliable(ratio, rule).alias("reliable"))


def reliable(ratio: float = 0.9, rule: str = "count") -> Column:
    """The rule over the columns of ``density``; both rules can be read from one pass."""
    kept = F.col("n_valid") >= F.floor((F.col("n_epochs") - 1) * ratio) if rule == "count" else F.col("density") >= ratio
    return F.coalesce(kept, F.lit(False))


def threshold_mask(layer: DataFrame, threshold: float) -> DataFrame:
    """value >= threshold; no data is False."""
    return layer.select(*PIXEL, F.coalesce(F.col("value") >= threshold, F.lit(False)).alias("mask"))


def apply_masks(layer: DataFrame, *masks: DataFrame) -> DataFrame:
    """NULL where any mask is False or missing. Masks: pixel and mask."""
    for i, m in enumerate(masks):
        layer = layer.join(m.select(*PIXEL, F.col("mask").alias(f"_m{i}")), PIXEL, "left")
    kept = F.lit(True)
    for i in range(len(masks)):
        kept = kept & F.coalesce(F.col(f"_m{i}"), F.lit(False))
    return layer.withColumn("value", F.when(kept, F.col("value"))).drop(*[f"_m{i}" for i in range(len(masks))])


def epoch_threshold_mask(pairs: DataFrame, layers: dict[str, float], zero: str | None = None, equal: bool = False) -> DataFrame:
    """Masks pairs by the layers of the same pair: NULL below the threshold, or 0 for the layer named ``zero``.

    ``equal`` masks where the layer equals the threshold instead.
    """
    value = F.col("value")
    for name, threshold in layers.items():
        hit = F.col(name) == threshold if equal else F.col(name) < threshold
        value = F.when(hit, F.lit(0.0) if name == zero else F.lit(None)).otherwise(value)
    return pairs.withColumn("value", value)


def recommended_mask(component: Column, temporal: Column, spatial: Column) -> Column:
    """1, or 0 where the component is below 1, temporal coherence below 0.6 or spatial coherence below 0.5."""
    return F.when((component < 1) | (temporal < 0.6) | (spatial < 0.5), 0).otherwise(1)


def water_mask(cover: Column) -> Column:
    """Land cover class 80 is water."""
    return F.when(cover == 80, 0).when(cover != 0, 1)


def blank_box(layer: DataFrame, rows: tuple[int, int], cols: tuple[int, int]) -> DataFrame:
    """NULL inside a half-open rectangle."""
    inside = (F.col("row") >= rows[0]) & (F.col("row") < rows[1]) & (F.col("col") >= cols[0]) & (F.col("col") < cols[1])
    return layer.withColumn("value", F.when(~inside, F.col("value")))


def subset_box(layer: DataFrame, grid: DataFrame, lat: tuple[float, float] | None = None, lon: tuple[float, float] | None = None) -> DataFrame:
    """The pixels between two latitudes and two longitudes. ``grid``: one row a frame with x_first, y_first, x_step, y_step in degrees.

    Bounds are turned into pixel indices (cut towards zero), so the filter on row and col is a comparison with two numbers a frame.
    """
    at = lambda value, first, step: pixel_index(F.lit(float(value)), F.col(first), F.col(step))
    j = layer.join(grid.select("frame_id", "x_first", "y_first", "x_step", "y_step"), "frame_id")
    for bounds, column, first, step in ((lat, "row", "y_first", "y_step"), (lon, "col", "x_first", "x_step")):
        if bounds is not None:
            a, b = (at(v, first, step) for v in bounds)
            j = j.filter(F.col(column).between(F.least(a, b), F.greatest(a, b)))
    return j.select(*layer.columns)


def max_coherence_reference(coherence: DataFrame) -> DataFrame:
    """The pixel of each frame with the highest coherence; the first in row order of equals."""
    order = F.struct(F.col("value"), -F.col("row"), -F.col("col"))
    return coherence.filter("value IS NOT NULL").groupBy("frame_id").agg(F.max_by(F.struct("row", "col", "value"), order).alias("p")).select("frame_id", "p.row", "p.col", "p.value")


def reference_check(masked: DataFrame, reference: DataFrame) -> DataFrame:
    """Reference points (frame_id, row, col) with valid: whether the masked layer has a value there."""
    at = masked.select(*PIXEL, "value")
    return reference.select(*PIXEL).join(at, PIXEL, "left").select(*PIXEL, F.col("value").isNotNull().alias("valid"))


def rereference(obs: DataFrame, reference: DataFrame, epoch: list[str], skip_invalid: bool = False) -> DataFrame:
    """Subtracts the value at each frame's reference pixel, epoch by epoch.

    A NULL reference counts as 0. With ``skip_invalid`` such an epoch stays as it is and only valid pixels are touched.
    """
    at = obs.join(reference.select(*PIXEL), PIXEL, "left_semi").select("frame_id", *epoch, F.col("value").alias("_ref"))
    joined = obs.join(at, ["frame_id", *epoch], "left")
    shift = F.coalesce("_ref", F.lit(0.0))
    value = F.col("value") - shift
    if skip_invalid:
        value = F.when(F.col("value") != 0, value).otherwise(F.col("value"))
    return joined.withColumn("value", value).drop("_ref")


def shortest_paths(edges: DataFrame) -> DataFrame:
    """(frame_id, target_date, ref_date, sec_date): the edges of the path with the fewest hops from each frame's first date.

    Of equal paths the one with the earliest dates holds. A frame has some hundreds of acquisitions, so its graph is searched
    in one task; frames are searched in parallel. Dates without a path have no rows.
    """

    def search(pdf):
        import pandas as pd

        after: dict = {}
        for r, s in sorted(set(zip(pdf["ref_date"], pdf["sec_date"], strict=True))):
            after.setdefault(r, []).append(s)
        first = min([*pdf["ref_date"], *pdf["sec_date"]])
        best, level = {first: ()}, [first]
        while level:
            found: dict = {}
            for r in level:
                for s in after.get(r, []):
                    path = (*best[r], (r, s))
                    if s not in best and (s not in found or path < found[s]):
                        found[s] = path
            best |= found
            level = sorted(found)
        rows = [(pdf["frame_id"].iloc[0], t, r, s) for t, path in best.items() for r, s in path]
        return pd.DataFrame(rows, columns=["frame_id", "target_date", "ref_date", "sec_date"])

    return edges.select("frame_id", "ref_date", "sec_date").distinct().groupBy("frame_id").applyInPandas(search, "frame_id int, target_date date, ref_date date, sec_date date")


def cumulative_displacement(pairs: DataFrame, paths: DataFrame | None = None) -> DataFrame:
    """Displacement of each pixel at each date: the sum of the pairs along the path from the first date.

    NULL if any pair of the path is NULL or missing, and where there is no path. The paths of a frame form a tree, since the best
    path to a date goes on from the best path to its last reference date. So only the last pair of each path counts, a pair is
    used once, and a pixel's dates are summed up along the tree, from parent to child, in batches of pixels.
    """
    paths = shortest_paths(pairs) if paths is None else paths
    tree = paths.filter(F.col("sec_date") == F.col("target_date"))
    first = paths.groupBy("frame_id").agg(F.min("ref_date").alias("_first"))
    tree = tree.join(first, "frame_id").select("frame_id", "ref_date", "sec_date", (F.col("ref_date") == F.col("_first")).alias("_root"))
    edge = F.struct(F.unix_date("sec_date").alias("t"), F.when(~F.col("_root"), F.unix_date("ref_date")).alias("p"), F.col("value").alias("v"))
    own = pairs.join(tree, ["frame_id", "ref_date", "sec_date"]).groupBy(*PIXEL).agg(F.sort_array(F.collect_list(edge)).alias("e"))
    flat = own.select(*PIXEL, *[F.col(f"e.{c}").alias(c) for c in ("t", "p", "v")])

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for i in range(0, batch.num_rows, 512):
                yield pa.RecordBatch.from_arrays(_summed(batch.slice(i, 512)), names=[*PIXEL, "obs_date", "value"])

    return flat.mapInArrow(run, "frame_id int, row int, col int, obs_date date, value double")


def _summed(batch):
    """Columns of sums along the trees: one row a pixel and date. Dates of the batch are columns of a matrix, taken in order."""
    import numpy as np
    import pyarrow as pa

    t, p, v = (c.flatten() for c in batch.columns[3:])
    row = np.repeat(np.arange(batch.num_rows), batch.column(3).value_lengths().to_numpy(zero_copy_only=False))
    root, p = p.is_null().to_numpy(zero_copy_only=False), p.fill_null(0).to_numpy()
    days, at = np.unique(t.to_numpy(), return_inverse=True)
    parent = np.searchsorted(days, p).clip(0, max(0, len(days) - 1))
    known = root | (days[parent] == p) if len(days) else root
    value = v.to_numpy(zero_copy_only=False).astype(float)
    total = np.full((batch.num_rows, len(days)), np.nan)
    order = np.argsort(at, kind="stable")  # a parent is earlier than its child
    ends = np.searchsorted(at[order], np.arange(len(days) + 1))
    for k in range(len(days)):
        i = order[ends[k] : ends[k + 1]]
        before = np.where(root[i], 0.0, np.where(known[i], total[row[i], parent[i]], np.nan))
        total[row[i], k] = before + value[i]
    sums = total[row, at]
    index = pa.array(row)
    return [*(c.take(index) for c in batch.columns[:3]), t.cast(pa.int32()).view(pa.date32()), pa.array(sums, mask=np.isnan(sums))]


def subtract_corrections(obs: DataFrame, *corrections: DataFrame, reference: DataFrame | None = None) -> DataFrame:
    """Subtracts layers (pixel, obs_date, value) in order; a missing correction counts as 0. Corrections are referenced first."""
    for c in corrections:
        if reference is not None:
            c = rereference(c, reference, ["obs_date"])
        obs = obs.join(c.select(*PIXEL, "obs_date", F.col("value").alias("_c")), [*PIXEL, "obs_date"], "left").withColumn("value", F.col("value") - F.coalesce("_c", F.lit(0.0))).drop("_c")
    return obs


def pairwise_from_epochs(pairs: DataFrame, epochs: DataFrame, scale: float = 1.0) -> DataFrame:
    """(reference - secondary) * scale of an epoch layer for each pair; 0 where either date is missing."""
    ref = epochs.select(*PIXEL, F.col("obs_date").alias("ref_date"), F.col("value").alias("_r"))
    sec = epochs.select(*PIXEL, F.col("obs_date").alias("sec_date"), F.col("value").alias("_s"))
    joined = pairs.select(*PIXEL, "ref_date", "sec_date").join(ref, [*PIXEL, "ref_date"], "left").join(sec, [*PIXEL, "sec_date"], "left")
    return joined.withColumn("value", F.coalesce((F.col("_r") - F.col("_s")) * scale, F.lit(0.0))).drop("_r", "_s")


def expand_epoch_masks(masks: DataFrame, ministacks: DataFrame) -> DataFrame:
    """Every epoch of a mini-stack gets its mask. ``ministacks``: frame_id, stack, start_epoch, end_epoch; ``masks``: frame_id,
    stack, pixel and mask. A mask covers the epochs start .. end + 1, one later than its products."""
    spans = ministacks.select("frame_id", "stack", F.explode(F.sequence("start_epoch", F.col("end_epoch") + 1)).alias("epoch"))
    return masks.join(spans, ["frame_id", "stack"])


def median_height(heights: DataFrame) -> DataFrame:
    """Per frame the median of the heights, 0 being no data, cut to a whole number."""
    return quantile(heights.filter("value <> 0"), ["frame_id"], "value", 0.5).select("frame_id", F.col("quantile").cast("int").alias("height"))


def mean_baseline(obs: DataFrame) -> DataFrame:
    """Spatial mean of each epoch."""
    return obs.groupBy("frame_id", "obs_date").agg(F.avg("value").alias("baseline"))


def first_epoch_subtract(obs: DataFrame, after=None, before=None, fill_zero: bool = False) -> DataFrame:
    """Zero at the first epoch. Bounds keep the dates strictly inside and zero the first of those.

    A first epoch without data leaves the pixel without data; ``fill_zero`` takes it as 0, which it is where a series begins.

    The first epoch is one grouped minimum per frame, joined back; no window over the cube.
    """
    if after is not None:
        obs = obs.filter(F.col("obs_date") > F.lit(after))
    if before is not None:
        obs = obs.filter(F.col("obs_date") < F.lit(before))
    first = obs.groupBy("frame_id").agg(F.min("obs_date").alias("obs_date"))
    zero = obs.join(first, ["frame_id", "obs_date"]).select(*PIXEL, F.col("value").alias("_z"))
    base = F.coalesce("_z", F.lit(0.0)) if fill_zero else F.col("_z")
    return obs.join(zero, PIXEL, "left").withColumn("value", F.col("value") - base).drop("_z")


def validity(obs: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Whether a pixel has any valid value, 0 being no data."""
    return obs.groupBy(*(by or PIXEL)).agg(F.coalesce(F.bool_or(F.col("value") != 0), F.lit(False)).alias("valid"))


def regrid_nearest(source: DataFrame, source_grid: DataFrame, target: DataFrame, target_grid: DataFrame, fill: float | None = None) -> DataFrame:
    """A layer on another grid: each target pixel takes the source pixel that holds its centre, without interpolation.

    Grids: one row a frame with x_first, y_first, x_step, y_step. Pixels outside the source get ``fill`` (NULL; 0 for masks).
    """
    s = source_grid.select("frame_id", *[F.col(c).alias(f"s_{c}") for c in ("x_first", "y_first", "x_step", "y_step")])
    t = target.join(target_grid, "frame_id").join(s, "frame_id")
    x = F.col("x_first") + (F.col("col") + 0.5) * F.col("x_step")
    y = F.col("y_first") + (F.col("row") + 0.5) * F.col("y_step")
    t = t.withColumn("_c", F.floor((x - F.col("s_x_first")) / F.col("s_x_step")).cast("int")).withColumn("_r", F.floor((y - F.col("s_y_first")) / F.col("s_y_step")).cast("int"))
    s = source.select("frame_id", F.col("row").alias("_r"), F.col("col").alias("_c"), "value")
    return t.join(s, ["frame_id", "_r", "_c"], "left").select(*PIXEL, F.coalesce("value", F.lit(fill)).alias("value") if fill is not None else F.col("value"))

