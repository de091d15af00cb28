"""Stitching of frames: overlaps of connected components, whole-cycle offsets, merging."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from subsidia.functions.stages import cut, quantile


def usable(label: str = "label"):
    """Labels of a frame as read: NULL, below 0 and from 10 on are no data; 0 is the background.

    Only frames are read so: merged frames number their components on, beyond 10.
    """
    return (F.col(label) >= 0) & (F.col(label) < 10)


def overlaps(one: DataFrame, two: DataFrame) -> DataFrame:
    """(label_2, label_1, n): pixels that components share in the overlap of two frames, and whether label_1 is the best partner.

    Background goes with background only. Of equal counts the smaller label holds.
    """
    a = one.select("row", "col", F.col("label").alias("label_1"))
    b = two.select("row", "col", F.col("label").alias("label_2"))
    n = a.join(b, ["row", "col"]).filter((F.col("label_1") == 0) == (F.col("label_2") == 0)).groupBy("label_2", "label_1").agg(F.count("*").alias("n"))
    return n.withColumn("best", F.row_number().over(Window.partitionBy("label_2").orderBy(F.desc("n"), "label_1")) == 1)


def cycle_offsets(one: DataFrame, two: DataFrame, method: str = "cycles") -> DataFrame:
    """Per component of the second frame and its best partner: cycles of 2 pi, the rest (circular mean), and the offset.

    ``mean`` takes the median difference as it is, without a rest.
    """
    best = overlaps(one, two).filter("best").select("label_2", "label_1")
    a = one.select("row", "col", F.col("label").alias("label_1"), F.col("phase").alias("p1"))
    b = two.select("row", "col", F.col("label").alias("label_2"), F.col("phase").alias("p2"))
    d = a.join(b, ["row", "col"]).join(best, ["label_1", "label_2"]).select("label_2", "label_1", (F.col("p1") - F.col("p2")).alias("d"))
    d = cut(d)  # read four times
    g = d.groupBy("label_2", "label_1").agg(F.avg(F.sin("d")).alias("_s"), F.avg(F.cos("d")).alias("_c")).join(quantile(d, ["label_2", "label_1"], "d", 0.5, "median"), ["label_2", "label_1"])
    if method == "mean":
        return g.select("label_2", "label_1", F.lit(0).alias("cycles"), F.lit(0.0).alias("rest"), F.col("median").alias("offset"))
    cycles = (F.floor((F.abs("median") + math.pi) / (2 * math.pi)) * F.signum("median")).cast("int")
    rest = F.atan2("_s", "_c")
    g = g.withColumn("cycles", cycles).withColumn("rest", rest)
    g = g.withColumn("rest", F.when(F.abs(F.col("median") - (2 * math.pi * F.col("cycles") + F.col("rest"))) > 3.14, -F.col("rest")).otherwise(F.col("rest")))
    return g.select("label_2", "label_1", "cycles", "rest", (2 * math.pi * F.col("cycles") + F.col("rest")).alias("offset"))


def shifted(frame: DataFrame, offsets: DataFrame, other) -> DataFrame:
    """The frame's components moved by their offset and renamed to their partner; those without one get the label ``other``."""
    off = offsets.select(F.col("label_2").alias("label"), "label_1", "offset")
    moved = frame.join(off, "label", "left")
    return moved.select("row", "col", F.coalesce("label_1", other).alias("label"), (F.col("phase") + F.coalesce("offset", F.lit(0.0))).alias("phase"))


def merge(one: DataFrame, two: DataFrame, method: str = "cycles") -> DataFrame:
    """Two frames as one, in the overlap with the mean of the phases and the smaller label.

    Forward, the second is shifted onto the first, and its components take their partners' labels; those without a partner keep
    their phase and get the next labels after the first's, in their own order. Backward, components of the first whose best partner in
    the shifted second has another label (it joined two of them) are shifted onto that and take its label.
    """
    top = one.agg(F.coalesce(F.max("label"), F.lit(0)).alias("top")).first()["top"]
    offsets = cut(cycle_offsets(one, two, method))
    alone = two.select("label").distinct().filter("label > 0").join(offsets.select(F.col("label_2").alias("label")), "label", "left_anti")
    named = alone.select("label", (F.row_number().over(Window.orderBy("label")) + F.lit(top)).alias("label_1"), F.lit(0.0).alias("offset"))  # a frame has less than ten labels
    second = cut(shifted(two, offsets.select("label_2", "label_1", "offset").unionByName(named.withColumnRenamed("label", "label_2")), F.col("label")))
    first = one
    if not overlaps(second, one).filter("best AND label_1 <> label_2").isEmpty():
        first = shifted(one, cycle_offsets(second, one, method).filter("label_1 <> label_2"), F.col("label"))
    return first.unionByName(second).groupBy("row", "col").agg(F.min("label").alias("label"), F.avg("phase").alias("phase"))


def south_to_north(components: DataFrame) -> list[int]:
    """The frames in order of their southern border, the southernmost first; rows are counted southward. Of equal ones the smaller id comes first."""
    borders = components.filter(usable()).groupBy("frame_id").agg(F.max("row").alias("south"))
    return [r["frame_id"] for r in borders.orderBy(F.desc("south"), "frame_id").collect()]  # a handful of frames


def stitch(components: DataFrame, frames: list[int] | None = None, method: str = "cycles", north_first: bool = False) -> DataFrame:
    """Frames of one pair, merged from south to north (``north_first``: the other way), or in the order given; a handful, so the
    fold is a short plan. Without any usable pixel the result is empty."""
    if frames is None:
        frames = south_to_north(components)
        frames = frames[::-1] if north_first else frames
    parts = [components.filter((F.col("frame_id") == f) & usable()).select("row", "col", "label", "phase") for f in frames]
    merged = parts[0] if parts else components.select("row", "col", "label", "phase").limit(0)
    for i, p in enumerate(parts[1:], 2):
        merged = merge(merged, p, method)
        if i < len(parts):
            merged = cut(merged)
    return merged


def final_mask(merged: DataFrame, mask: DataFrame | None = None) -> DataFrame:
    """What is left of a stitched frame: the background (label 0), phases of 0, and pixels that ``mask`` (row, col, keep) doesn't keep or
    doesn't have, become NULL in both label and phase; a phase of 0 keeps its label."""
    m = merged.join(mask.select("row", "col", "keep"), ["row", "col"], "left") if mask is not None else merged.withColumn("keep", F.lit(True))
    held = F.coalesce("keep", F.lit(False)) & (F.col("label") > 0)
    return m.select("row", "col", F.when(held, F.col("label")).alias("label"), F.when(held & (F.col("phase") != 0), F.col("phase")).alias("phase"))
