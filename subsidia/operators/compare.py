"""Comparison of two versions of a product: series, histograms, points, metadata."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from subsidia.functions.columns import hash_order
from subsidia.functions.stages import beside, cut
from subsidia.operators.cube import PIXEL, first_epoch_subtract, validity
from subsidia.operators.windows import window_sums


def common_dates(a: DataFrame, b: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Inner join of two cubes on pixel and date: value and other."""
    by = by or [*PIXEL, "obs_date"]
    return a.select(*by, "value").join(b.select(*by, F.col("value").alias("other")), by)


def common_reference_date(a: DataFrame, b: DataFrame) -> DataFrame:
    """Per frame the earliest date of both, or else the first date of the primary version."""
    side = lambda rows, b: rows.select("frame_id", "obs_date", F.lit(b).alias("_b"))
    dates = side(a, False).unionByName(side(b, True)).groupBy("frame_id", "obs_date").agg(F.bool_or(~F.col("_b")).alias("_in_a"), F.bool_or("_b").alias("_in_b"))
    first = F.coalesce(F.min(F.when(F.col("_in_b") & F.col("frame_id").isNotNull(), F.col("obs_date"))), F.min("obs_date"))
    return dates.filter("_in_a").groupBy("frame_id").agg(first.alias("reference_date"))


def version_compare(a: DataFrame, b: DataFrame) -> DataFrame:
    """Jointly valid values of both versions at the same pixels and dates."""
    return common_dates(a, b).filter((F.col("value") != 0) & (F.col("other") != 0))


def cube_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Mean difference of each common epoch in mm, 0 being no data."""
    d = version_compare(a, b).withColumn("d", (F.col("value") - F.col("other")) * 1000)
    return d.groupBy("frame_id", "obs_date").agg(F.avg("d").alias("mean_mm"), F.count("*").alias("n"))


def common_grid(a: DataFrame, b: DataFrame) -> DataFrame:
    """Per frame the grid of the extent that two grids share, with the finer step of both: x_first, y_first, x_step, y_step, length, width.

    Grids: one row a frame with x_first, y_first, x_step (above 0), y_step (below 0), length and width.
    """
    side = lambda g, p: g.select("frame_id", *[F.col(c).alias(f"{p}_{c}") for c in ("x_first", "y_first", "x_step", "y_step", "length", "width")])
    j = side(a, "a").join(side(b, "b"), "frame_id")
    end = lambda p, first, step, n: F.col(f"{p}_{first}") + F.col(f"{p}_{step}") * F.col(f"{p}_{n}")
    left, right = F.greatest("a_x_first", "b_x_first"), F.least(end("a", "x_first", "x_step", "width"), end("b", "x_first", "x_step", "width"))
    top, bottom = F.least("a_y_first", "b_y_first"), F.greatest(end("a", "y_first", "y_step", "length"), end("b", "y_first", "y_step", "length"))
    step = F.least("a_x_step", "b_x_step", F.abs("a_y_step"), F.abs("b_y_step"))
    g = j.select("frame_id", left.alias("x_first"), top.alias("y_first"), step.alias("x_step"), (-step).alias("y_step"), F.floor((top - bottom) / step).cast("int").alias("length"), F.floor((right - left) / step).cast("int").alias("width"))
    return g.filter("length > 0 AND width > 0")


def snapped_difference(a: DataFrame, a_grid: DataFrame, b: DataFrame, b_grid: DataFrame) -> DataFrame:
    """value - other of two cubes at common epochs on their common grid, each pixel taking the nearest of either; 0 is no data."""
    g = common_grid(a_grid, b_grid)
    at = g.withColumn("row", F.explode(F.sequence(F.lit(0), F.col("length") - 1))).withColumn("col", F.explode(F.sequence(F.lit(0), F.col("width") - 1)))
    for cube_grid, p in ((a_grid, "a"), (b_grid, "b")):
        at = at.join(cube_grid.select("frame_id", *[F.col(c).alias(f"_{c}") for c in ("x_first", "y_first", "x_step", "y_step")]), "frame_id")
        x, y = F.col("x_first") + (F.col("col") + 0.5) * F.col("x_step"), F.col("y_first") + (F.col("row") + 0.5) * F.col("y_step")
        at = at.withColumn(f"{p}_row", F.floor((y - F.col("_y_first")) / F.col("_y_step")).cast("int")).withColumn(f"{p}_col", F.floor((x - F.col("_x_first")) / F.col("_x_step")).cast("int")).drop("_x_first", "_y_first", "_x_step", "_y_step")
    at = at.select(*PIXEL, "a_row", "a_col", "b_row", "b_col")
    one = a.select("frame_id", "obs_date", F.col("row").alias("a_row"), F.col("col").alias("a_col"), "value")
    two = b.select("frame_id", "obs_date", F.col("row").alias("b_row"), F.col("col").alias("b_col"), F.col("value").alias("other"))
    j = at.join(one, ["frame_id", "a_row", "a_col"]).join(two, ["frame_id", "b_row", "b_col", "obs_date"]).filter("value <> 0 AND other <> 0")
    return j.select(*PIXEL, "obs_date", (F.col("value") - F.col("other")).alias("difference"))


def series_stats(pairs: DataFrame, by: list[str] | None = None) -> DataFrame:
    """rmse, mad (of the differences) and Pearson's r of value and other; all NULL with fewer than two common values."""
    by = by or PIXEL
    d = pairs.filter("value IS NOT NULL AND other IS NOT NULL").withColumn("d", F.col("value") - F.col("other"))
    g = d.groupBy(*by).agg(F.count("*").alias("n"), F.sqrt(F.avg(F.expr("d * d"))).alias("rmse"), F.median("d").alias("_m"), F.corr("value", "other").alias("r"))
    mad = d.join(g.select(*by, "_m"), by).groupBy(*by).agg(F.median(F.abs(F.col("d") - F.col("_m"))).alias("mad"))
    enough = F.col("n") >= 2
    return g.join(mad, by).select(*by, "n", *[F.when(enough, F.col(c)).alias(c) for c in ("rmse", "mad", "r")])


def window_mean_series(points: DataFrame, a: DataFrame, b: DataFrame, radius: int = 3, zero_first: bool = False) -> DataFrame:
    """Per point and date the means of both versions over the jointly valid pixels around it.

    Points (pid, frame_id, row, col) whose centre is never jointly valid are left out. ``zero_first`` subtracts each version's first
    epoch first, as displacement series need it and counts, coherences and similarities don't.
    """
    if zero_first:
        a, b = first_epoch_subtract(a, fill_zero=True), first_epoch_subtract(b, fill_zero=True)
    both = version_compare(a, b)
    centre = points.join(both.select(*PIXEL).distinct(), PIXEL, "left_semi")
    sums = window_sums(centre, both, ["value", "other"], radius, radius, epoch=["obs_date"])
    return sums.select("pid", "obs_date", (F.col("value") / F.col("n")).alias("value"), (F.col("other") / F.col("n")).alias("other"), "n")


def ranges(layers: DataFrame, scale: float = 1.0) -> DataFrame:
    """Minimum and maximum of each layer per version, and of both versions together (version NULL)."""
    return layers.groupingSets([["version", "layer"], ["layer"]], "version", "layer").agg((F.min("value") * scale).alias("low"), (F.max("value") * scale).alias("high"))


def histogram(values: DataFrame, bounds: tuple[float, float] | None, n_bins: int = 20, normalised: bool = True, column: str = "value") -> DataFrame:
    """Counts and density of valid values in equal bins; left-closed, the last one closed; empty bins have 0.

    Without ``bounds`` the bins span the valid values, one row that is looked up first; a single value has half a unit on either side.
    """
    v = values.filter(F.col(column) != 0)
    if bounds is None:
        lo, hi = v.agg(F.min(column), F.max(column)).first()
        lo, hi = (0.0, 1.0) if lo is None else (lo - 0.5, hi + 0.5) if lo == hi else (lo, hi)
    else:
        lo, hi = bounds
    width = (hi - lo) / n_bins
    v = v.filter(F.col(column).between(lo, hi))
    k = F.least(F.floor((F.col(column) - lo) / width), F.lit(n_bins - 1)).cast("int")
    counted = v.groupBy(k.alias("bin")).agg(F.count("*").alias("n"))
    frame = values.sparkSession.range(n_bins).select(F.col("id").cast("int").alias("bin"))
    total = counted.agg(F.sum("n").alias("total"))
    out = frame.join(counted, "bin", "left").crossJoin(total).withColumn("n", F.coalesce("n", F.lit(0)))
    density = F.col("n") / F.nullif(F.col("total") * width, F.lit(0.0))
    return out.select("bin", (lo + F.col("bin") * width).alias("bin_lo"), "n", *([density.alias("density")] if normalised else []))


def difference_histogram(pairs: DataFrame, n_bins: int = 20, scale: float = 100.0, skip_first: bool = False) -> DataFrame:
    """Raw counts of (value - other) * scale in bins that span them, with their mean on each row; a difference of 0 counts too."""
    p = _common(pairs, skip_first).select(((F.col("value") - F.col("other")) * scale).alias("d")).filter("d IS NOT NULL")
    lo, hi, mean = p.agg(F.min("d"), F.max("d"), F.avg("d")).first()
    lo, hi = (0.0, 1.0) if lo is None else (lo - 0.5, hi + 0.5) if lo == hi else (lo, hi)
    width = (hi - lo) / n_bins
    counted = p.groupBy(F.least(F.floor((F.col("d") - lo) / width), F.lit(n_bins - 1)).cast("int").alias("bin")).agg(F.count("*").alias("n"))
    frame = pairs.sparkSession.range(n_bins).select(F.col("id").cast("int").alias("bin"))
    return frame.join(counted, "bin", "left").select("bin", (lo + F.col("bin") * width).alias("bin_lo"), F.coalesce("n", F.lit(0)).alias("n"), F.lit(mean).cast("double").alias("mean"))


def difference_summary(pairs: DataFrame, skip_first: bool = False) -> DataFrame:
    """Mean and count of value - other, with or without each frame's first epoch."""
    return _common(pairs, skip_first).groupBy("frame_id").agg(F.avg(F.col("value") - F.col("other")).alias("mean"), F.count("*").alias("n"))


def _common(pairs: DataFrame, skip_first: bool) -> DataFrame:
    """Jointly valid rows, with or without each frame's first epoch."""
    p = pairs.filter("value IS NOT NULL AND other IS NOT NULL")
    if not skip_first:
        return p
    return p.join(p.groupBy("frame_id").agg(F.min("obs_date").alias("_f")), "frame_id").filter("obs_date > _f").drop("_f")


def align_second_valid(pairs: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Shifts the other series so that both agree at the second common valid date; no shift with fewer than two."""
    by = by or PIXEL
    valid = pairs.filter("value IS NOT NULL AND other IS NOT NULL")
    second = valid.withColumn("_n", F.row_number().over(Window.partitionBy(*by).orderBy("obs_date"))).filter("_n = 2").select(*by, (F.col("value") - F.col("other")).alias("_s"))
    return pairs.join(second, by, "left").withColumn("other", F.col("other") + F.coalesce("_s", F.lit(0.0))).drop("_s")


def candidate_points(a: DataFrame, b: DataFrame, limit: int = 200, seed: int = 0) -> DataFrame:
    """Up to ``limit`` valid pixels per frame, in hash order, from the version with the smaller footprint (the primary if equal)."""
    va, vb = validity(a).filter("valid").withColumn("v", F.lit(0)), validity(b).filter("valid").withColumn("v", F.lit(1))
    both = va.unionByName(vb)
    chosen = both.groupBy("frame_id", "v").agg(F.count("*").alias("n")).groupBy("frame_id").agg(F.min(F.struct("n", "v")).alias("s")).select("frame_id", F.col("s.v").alias("v"))
    pool = both.join(chosen, ["frame_id", "v"]).withColumn("_h", hash_order(seed, *PIXEL))
    return pool.withColumn("rank", F.row_number().over(Window.partitionBy("frame_id").orderBy("_h", "row", "col"))).filter(F.col("rank") <= limit).select(*PIXEL, "rank")


def points_with_fallback(requested: DataFrame, obs: DataFrame, candidates: DataFrame, step: tuple[float, float] | None = None, least: float = 1e-3) -> DataFrame:
    """Requested pixels (pid, pixel), invalid ones replaced by the frame's first candidate: row, col and moved.

    With ``step``, the size of a pixel in degrees (latitude, longitude), a point counts as moved only if that is by more than ``least``
    degrees in either.
    """
    first = candidates.groupBy("frame_id").agg(F.min_by(F.struct("row", "col"), "rank").alias("_c"))
    v = requested.join(validity(obs), PIXEL, "left").withColumn("valid", F.coalesce("valid", F.lit(False))).join(first, "frame_id", "left")
    pick = lambda c: F.when(F.col("valid"), F.col(c)).otherwise(F.col(f"_c.{c}")).alias(c)
    moved = ~F.col("valid")
    if step is not None:
        far = [F.abs(F.col(f"_c.{c}") - F.col(c)) * abs(size) > least for c, size in zip(("row", "col"), step, strict=True)]
        moved = moved & F.coalesce(far[0] | far[1], F.lit(False))
    return v.select("pid", "frame_id", pick("row"), pick("col"), moved.alias("moved"))


# The fields of a product's metadata that hold software versions.
VERSION_FIELDS = ("sas_version", "dolphin_version", "compass_version", "isce3_version", "s1read_version")


def version_rows(products: DataFrame, key: str, fields: tuple[str, ...] = VERSION_FIELDS) -> DataFrame:
    """(key, path, value): the version strings of each product as rows, to be compared by ``metadata_diff`` like any other path."""
    return products.select(key, F.explode(F.array(*[F.struct(F.lit(f).alias("path"), F.col(f).alias("value")) for f in fields])).alias("r")).select(key, "r.*")


def metadata_diff(a: DataFrame, b: DataFrame, exclude: str = "cslc_file_list", by: list[str] | None = None) -> DataFrame:
    """Flattened metadata (path, value) of two products, or of many (``by``): added, removed and changed paths. Paths that hold
    ``exclude`` don't count.

    The rows of a path are a multiset: what both sides have equally often is no difference, in whatever order. Rows are equal by their
    ``digest``, as ``flatten_json`` gives it, or else by value. If one row is left on either side, the path is changed; otherwise each
    row left is removed or added. Counts are joined, never rows with rows, so a list of n elements makes n rows at most.
    """
    by = by or []

    def counted(rows: DataFrame, name: str) -> DataFrame:
        same = F.col("digest") if "digest" in rows.columns else F.coalesce(F.concat(F.lit("="), "value"), F.lit(""))
        held = rows.filter(~F.contains("path", F.lit(exclude))).groupBy(*by, "path", same.alias("_same"))
        return held.agg(F.count("*").alias(f"_n_{name}"), F.min("value").alias(f"_{name}"))

    both = counted(a, "a").join(counted(b, "b"), [*by, "path", "_same"], "full")
    n = F.coalesce("_n_a", F.lit(0)) - F.coalesce("_n_b", F.lit(0))
    left = both.select(*by, "path", n.alias("_n"), F.when(n > 0, F.col("_a")).otherwise(F.col("_b")).alias("_v")).filter("_n <> 0")
    single = lambda sign: (F.sum(F.greatest(F.col("_n") * sign, F.lit(0))) == 1)
    old, new = F.max(F.when(F.col("_n") > 0, F.col("_v"))), F.max(F.when(F.col("_n") < 0, F.col("_v")))
    paths = left.groupBy(*by, "path").agg((single(1) & single(-1)).alias("_one"), old.alias("old"), new.alias("new"))
    changed = paths.filter("_one").select(*by, "path", F.lit("changed").alias("change"), "old", "new")
    gone = F.col("_n") > 0
    rest = left.join(paths.filter("NOT _one").select(*by, "path"), [*by, "path"]).withColumn("_k", F.explode(F.sequence(F.lit(1), F.abs("_n").cast("int"))))
    return changed.unionByName(rest.select(*by, "path", F.when(gone, "removed").otherwise("added").alias("change"), F.when(gone, F.col("_v")).alias("old"), F.when(~gone, F.col("_v")).alias("new")))


def flatten_json(documents: DataFrame, key: str, json: str, exclude: str | None = None) -> DataFrame:
    """(key, path, value, digest) of every leaf of a JSON text outside lists and of every element of its outermost lists.

    All elements of a list have its path with ``[]`` at the end, so their order doesn't count. An element's value is its own JSON text;
    its digest is that of the tree below it, in which the order of lists doesn't count either. Keys with ``exclude`` in them are left
    out with all below, within elements too. In paths a backslash stands before ``.``, ``[``, ``]`` and backslashes of a key.

    Trees are unfolded level by level, to any depth; a level is one pass over what is still nested. An empty object or list is a leaf
    (``{}``, ``[]``). A text that is no JSON, or NULL, has one row with an empty path and no value. Texts may be repeated.

    Equal elements are unfolded once: those of texts without numbers but integers, where an element's text says all about its tree.
    """
    spark = documents.sparkSession
    plain = F.coalesce(~F.rlike(json, F.lit("[0-9][.eE]")), F.lit(False))
    todo = cut(documents.select(key, F.lit("").alias("path"), F.monotonically_increasing_id().cast("string").alias("id"), plain.alias("_plain"), F.try_parse_json(json).alias("v")))
    out, elements = None, None
    union = lambda x, y: y if x is None else x.unionByName(y)
    while not todo.isEmpty():
        marked = _marked(todo)
        out = union(out, marked.filter("NOT _nested").select(key, "path", F.col("_value").alias("value"), F.col("_leaf").alias("digest")))
        spelled = F.regexp_replace("_k", r"([\\.\[\]])", r"\\$1")
        step = F.when(F.col("_k").isNull(), "[]").when(F.col("path") == "", spelled).otherwise(F.concat(F.lit("."), spelled))
        children = cut(_children(marked, exclude).select(key, F.concat("path", step).alias("path"), "_child", "_plain", F.col("_k").isNull().alias("_element"), F.col("_e").alias("v")))
        todo = children.filter("NOT _element").select(key, "path", F.col("_child").alias("id"), "_plain", "v")
        same = F.when(F.col("_plain"), F.sha2(F.coalesce(F.to_json("v"), F.lit("null")), 256)).otherwise(F.col("_child"))
        elements = union(elements, children.filter("_element").select(key, "path", "_plain", same.alias("_same"), "v"))
    if elements is None:
        return out if out is not None else todo.select(key, "path", F.col("id").alias("value"), F.col("id").alias("digest"))
    # Texts are grouped, as variants can't be; they are parsed again. Few are left to be joined, or few are equal.
    texts = elements.filter("_plain").groupBy("_same").agg(F.min(F.coalesce(F.to_json("v"), F.lit("null"))).alias("_t")).select("_same", F.parse_json("_t").alias("v"))
    digests = beside(_digests(texts.unionByName(elements.filter("NOT _plain").select("_same", "v")), exclude))
    text = F.coalesce(F.try_variant_get("v", "$", "string"), F.when(~F.is_variant_null("v"), F.to_json("v")))
    return out.unionByName(elements.join(digests, "_same").select(key, "path", text.alias("value"), "digest"))


def _marked(nodes: DataFrame) -> DataFrame:
    """Adds of the variant ``v``: _nested, whether something lies below it, and _value and _leaf, its text and digest if not."""
    kind = F.coalesce(F.schema_of_variant("v"), F.lit("-"))
    nested = (F.startswith(kind, F.lit("OBJECT<")) & (kind != "OBJECT<>")) | (F.startswith(kind, F.lit("ARRAY<")) & F.try_variant_get("v", "$[0]", "variant").isNotNull())
    empty = F.when(F.startswith("_kind", F.lit("OBJECT<")), "{}").when(F.startswith("_kind", F.lit("ARRAY<")), "[]")
    value = F.coalesce(empty, F.try_variant_get("v", "$", "string"))
    return nodes.withColumns({"_kind": kind, "_nested": nested}).withColumn("_value", value).withColumn("_leaf", F.sha2(F.concat_ws("=", "_kind", "_value"), 256))


def _children(marked: DataFrame, exclude: str | None) -> DataFrame:
    """What lies below the nested nodes: adds _k, the name, NULL within a list, _e and an id, _child."""
    children = marked.sparkSession.tvf.variant_explode(F.col("v").outer()).select(F.col("pos").alias("_at"), F.col("key").alias("_k"), F.col("value").alias("_e"))
    below = marked.filter("_nested").lateralJoin(children).withColumn("_child", F.md5(F.concat_ws("/", "id", "_at")))
    return below if exclude is None else below.filter(~F.coalesce(F.contains("_k", F.lit(exclude)), F.lit(False)))


def _digests(elements: DataFrame, exclude: str | None) -> DataFrame:
    """(_same, digest) of the tree of each element (_same, v): unfolded level by level, then folded from the lowest level up."""
    todo = cut(elements.select(F.col("_same").alias("id"), F.lit(None).cast("string").alias("up"), F.lit(None).cast("string").alias("name"), "v"))
    levels, known = [], None
    while not todo.isEmpty():
        marked = _marked(todo)
        levels.append((marked.filter("NOT _nested").select("id", "up", "name", F.col("_leaf").alias("digest")), marked.filter("_nested").select("id", "up", "name")))
        todo = cut(_children(marked, exclude).select(F.col("_child").alias("id"), F.col("id").alias("up"), F.col("_k").alias("name"), F.col("_e").alias("v")))
    for leaves, inner in reversed(levels):
        held = inner.withColumn("_digest", F.lit(None)) if known is None else inner.join(_folded(known), F.col("id") == F.col("_up"), "left")
        known = cut(leaves.unionByName(held.select("id", "up", "name", F.coalesce("_digest", F.sha2(F.lit(""), 256)).alias("digest"))))  # "": all left out
    if known is None:
        return todo.select(F.col("id").alias("_same"), F.col("name").alias("digest"))
    return known.select(F.col("id").alias("_same"), "digest")


#: Hexadecimal digits of a summand of a folded digest; sums of so many bits stay within a long for 2^31 children.
_CHUNK = 8


def _folded(children: DataFrame) -> DataFrame:
    """(_up, _digest) of each parent from its children's digests, whatever their order: the digest of their number and of the sums of the
    digests' parts, which combine before the shuffle. A child of an object counts with its name."""
    own = F.sha2(F.concat_ws("=", F.coalesce(F.concat(F.lit("."), "name"), F.lit("[]")), "digest"), 256)
    parts = [F.sum(F.conv(F.substring(F.col("_own"), i + 1, _CHUNK), 16, 10).cast("long")).cast("string") for i in range(0, 64, _CHUNK)]
    return children.select(F.col("up").alias("_up"), own.alias("_own")).groupBy("_up").agg(F.sha2(F.concat_ws(",", F.count("*").cast("string"), *parts), 256).alias("_digest"))
