"""Velocities and time functions, from sums that combine before the shuffle."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subsidia.functions.columns import YEAR_DAYS
from subsidia.operators.cube import PIXEL


def linear_velocity(obs: DataFrame, fill_zero: bool = False, by: list[str] | None = None) -> DataFrame:
    """Least-squares slope of each pixel per year; NULL with fewer than two dates.

    ``fill_zero`` takes no data as 0, as a series filled before the fit has it, and a slope of 0 as no data afterwards.
    """
    t = F.datediff("obs_date", F.lit("2000-01-01").cast("date")).cast("double")
    value = F.coalesce("value", F.lit(0.0)) if fill_zero else F.col("value")
    slope = F.regr_slope(value, t) * YEAR_DAYS
    out = obs.groupBy(*(by or PIXEL)).agg(slope.alias("velocity"))
    return out.withColumn("velocity", F.nullif("velocity", F.lit(0.0))) if fill_zero else out


def weighted_velocity(obs: DataFrame, weight: str, least: float = 0.4, by: list[str] | None = None) -> DataFrame:
    """The same with weights on the residuals (so their squares count); weights below ``least`` count as 0."""
    t = F.datediff("obs_date", F.lit("2000-01-01").cast("date")) / YEAR_DAYS
    w = F.when(F.col("value").isNotNull() & (F.col(weight) >= least), F.col(weight) * F.col(weight)).otherwise(0.0)
    s = obs.withColumn("_w", w).withColumn("_t", t).withColumn("_v", F.coalesce("value", F.lit(0.0)))
    s = s.groupBy(*(by or PIXEL)).agg(F.sum("_w").alias("w"), F.sum(F.expr("_w * _t")).alias("t"), F.sum(F.expr("_w * _v")).alias("v"), F.sum(F.expr("_w * _t * _t")).alias("tt"), F.sum(F.expr("_w * _t * _v")).alias("tv"))
    d = F.col("w") * F.col("tt") - F.col("t") * F.col("t")
    return s.select(*(by or PIXEL), F.when(d > 1e-9 * F.col("w") * F.col("tt"), (F.col("w") * F.col("tv") - F.col("t") * F.col("v")) / d).alias("velocity"))


def velocity_common_dates(primary: DataFrame, comparison: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Slopes of both versions on the dates they share: velocity and comparison_velocity."""
    by = by or PIXEL
    dates = primary.select("frame_id", "obs_date").intersect(comparison.select("frame_id", "obs_date"))
    one = linear_velocity(primary.join(dates, ["frame_id", "obs_date"], "left_semi"), by=by)
    two = linear_velocity(comparison.join(dates, ["frame_id", "obs_date"], "left_semi"), by=by)
    return one.join(two.withColumnRenamed("velocity", "comparison_velocity"), by)


def design(date: Column, first: Column, periods: list[float], steps: list[str]) -> dict[str, Column]:
    """Terms of a time model: offset, rate per year, cosine and sine of each period (years), one Heaviside per step (1 on its day)."""
    years = F.datediff(date, first) / YEAR_DAYS
    terms = {"offset": F.lit(1.0), "rate": years}
    for p in periods:
        terms[f"cos_{p:g}"] = F.cos(2 * math.pi / p * years)
        terms[f"sin_{p:g}"] = F.sin(2 * math.pi / p * years)
    for s in steps:
        terms[f"step_{s}"] = F.when(date >= F.lit(s).cast("date"), 1.0).otherwise(0.0)
    return terms


def time_function_fit(obs: DataFrame, first: str, periods: list[float] = (1.0, 0.5), steps: list[str] = (), by: list[str] | None = None, extra: list[str] = ()) -> DataFrame:
    """Least-squares coefficients of a time model for each key, one column a term; NULL where dates don't determine them.

    ``extra`` names columns of ``obs`` that are terms themselves, such as the perpendicular baseline of an epoch.

    The normal equations are sums, so they are added up before the shuffle; only the small solve runs in Python, on batches of rows.
    """
    by = by or PIXEL
    terms = design(F.col("obs_date"), F.lit(first).cast("date"), list(periods), list(steps)) | {c: F.col(c).cast("double") for c in extra}
    names, k = list(terms), len(terms)
    used = obs.filter("value IS NOT NULL").select(*by, "value", *[c.alias(f"_{i}") for i, c in enumerate(terms.values())])
    sums = [F.sum(F.col(f"_{i}") * F.col(f"_{j}")).alias(f"_{i}_{j}") for i in range(k) for j in range(i, k)]
    sums += [F.sum(F.col(f"_{i}") * F.col("value")).alias(f"_{i}_y") for i in range(k)]
    normal = used.groupBy(*by).agg(F.count("*").alias("n"), F.array(*[F.lit(0.0)]).alias("_"), *sums).drop("_")
    packed = normal.select(*by, "n", F.array(*[f"_{i}_{j}" for i in range(k) for j in range(i, k)]).alias("a"), F.array(*[f"_{i}_y" for i in range(k)]).alias("y"))

    @F.pandas_udf("array<double>")
    def solve(n, a, y):
        import numpy as np
        import pandas as pd

        upper, out = np.triu_indices(k), []
        for count, flat, right in zip(n, a, y, strict=True):
            m = np.zeros((k, k))
            m[upper] = flat
            m = m + np.triu(m, 1).T
            ok = count >= k and np.linalg.cond(m) < 1e12
            out.append(np.linalg.solve(m, np.asarray(right)).tolist() if ok else None)
        return pd.Series(out)

    return packed.withColumn("x", solve("n", "a", "y")).select(*by, "n", *[F.get("x", F.lit(i)).alias(t) for i, t in enumerate(names)])


def ragged_time_function_fit(obs: DataFrame, steps: DataFrame, first: str, periods: list[float] = (1.0, 0.5), by: list[str] | None = None, steps_by: list[str] | None = None) -> DataFrame:
    """The time model with steps of each key's own: by, n, one column a common term, and steps, an array of (step_date, amplitude).

    ``steps`` has ``steps_by`` (a part of ``by``, by default all) and step_date; from that date on a step counts. The dates cut a series into
    stretches. Sums of products are added up by stretch in one pass, before the shuffle, and the equations of any number of steps are
    sums over the stretches from a step on. Coefficients are NULL where the dates don't determine the common terms. A step with no value
    before it, or none between it and the next step, has a NULL amplitude and doesn't count; repeated steps are one.
    """
    by = by or PIXEL
    steps_by = steps_by or by
    terms = design(F.col("obs_date"), F.lit(first).cast("date"), list(periods), [])
    names, k = list(terms), len(terms)
    own = steps.filter("step_date IS NOT NULL").groupBy(*steps_by).agg(F.array_sort(F.collect_set("step_date")).alias("_steps"))
    used = obs.filter("value IS NOT NULL").join(own, steps_by, "left").withColumn("_steps", F.coalesce("_steps", F.array().cast("array<date>")))
    used = used.select(*by, "value", "_steps", F.size(F.filter("_steps", lambda s: s <= F.col("obs_date"))).alias("_at"), *[c.alias(f"_{i}") for i, c in enumerate(terms.values())])
    upper = [(i, j) for i in range(k) for j in range(i, k)]
    sums = [F.sum(F.col(f"_{i}") * F.col(f"_{j}")).alias(f"_{i}_{j}") for i, j in upper] + [F.sum(F.col(f"_{i}") * F.col("value")).alias(f"_{i}_y") for i in range(k)]
    stretches = used.groupBy(*by, "_steps", "_at").agg(F.count("*").alias("_n"), *sums)
    stretch = F.struct("_at", F.col("_n").cast("double").alias("n"), F.array(*[f"_{i}_{j}" for i, j in upper]).alias("a"), F.array(*[f"_{i}_y" for i in range(k)]).alias("y"))
    packed = stretches.groupBy(*by, "_steps").agg(F.sum("_n").alias("n"), F.sort_array(F.collect_list(stretch)).alias("_s"))

    @F.pandas_udf("x array<double>, a array<double>")
    def solve(n_steps, stretches):
        import numpy as np
        import pandas as pd

        rows = np.triu_indices(k)
        out = []
        for m, parts in zip(n_steps, stretches, strict=True):
            at = np.array([p["_at"] for p in parts])
            blocks = np.zeros((len(parts), k, k))
            blocks[:, rows[0], rows[1]] = np.array([p["a"] for p in parts])
            blocks += np.triu(blocks, 1).transpose(0, 2, 1)
            y = np.array([p["y"] for p in parts])
            kept = [j for j in range(1, m + 1) if j in at and at[0] < j]  # values from it to the next step, and before it
            size = k + len(kept)
            left, right = np.zeros((size, size)), np.zeros(size)
            left[:k, :k], right[:k] = blocks.sum(0), y.sum(0)
            for c, j in enumerate(kept):  # the first term is 1, so its row holds the sums of the terms themselves
                left[:k, k + c] = left[k + c, :k] = blocks[at >= j][:, 0].sum(0)
                right[k + c] = y[at >= j][:, 0].sum()
                for e, other in enumerate(kept[: c + 1]):
                    left[k + c, k + e] = left[k + e, k + c] = blocks[at >= max(j, other)][:, 0, 0].sum()
            if blocks[:, 0, 0].sum() >= size and np.linalg.cond(left) < 1e12:
                x = np.linalg.solve(left, right)
                found = dict(zip(kept, x[k:].tolist(), strict=True))
                out.append((x[:k].tolist(), [found.get(j) for j in range(1, m + 1)]))
            else:
                out.append((None, [None] * m))
        return pd.DataFrame(out, columns=["x", "a"])

    solved = packed.withColumn("_f", solve(F.size("_steps"), "_s"))
    amplitudes = F.zip_with("_steps", "_f.a", lambda d, a: F.struct(d.alias("step_date"), F.nanvl(a, F.lit(None).cast("double")).alias("amplitude")))
    return solved.select(*by, "n", *[F.get("_f.x", F.lit(i)).alias(t) for i, t in enumerate(names)], amplitudes.alias("steps"))


def deramp(points: DataFrame, x: str = "x", y: str = "y", v: str = "v") -> DataFrame:
    """Subtracts the plane fitted to (x, y, v): one row of sums gives it, by Cramer's rule on centred moments."""
    m = points.filter(F.col(v).isNotNull()).agg(
        F.avg(x).alias("mx"), F.avg(y).alias("my"), F.avg(v).alias("mv"), F.var_pop(x).alias("xx"), F.var_pop(y).alias("yy"),
        F.covar_pop(x, y).alias("xy"), F.covar_pop(x, v).alias("xv"), F.covar_pop(y, v).alias("yv"),
    )
    d = F.expr("nullif(xx * yy - xy * xy, 0)")
    m = m.select("mx", "my", "mv", ((F.col("xv") * F.col("yy") - F.col("yv") * F.col("xy")) / d).alias("_a"), ((F.col("yv") * F.col("xx") - F.col("xv") * F.col("xy")) / d).alias("_b"))
    flat = F.col(v) - (F.col("mv") + F.coalesce("_a", F.lit(0.0)) * (F.col(x) - F.col("mx")) + F.coalesce("_b", F.lit(0.0)) * (F.col(y) - F.col("my")))
    return points.crossJoin(F.broadcast(m)).withColumn(v, flat).drop("mx", "my", "mv", "_a", "_b")


def nonlinear_score(obs: DataFrame, window: int = 11, start: int = 1, compat: bool = False) -> DataFrame:
    """Share of windows of a pixel's series whose running mean is steadier than usual: score, and sigma.

    For each window of ``window`` epochs the population deviation of its expanding means is taken; sigma is the deviation of
    these; the score counts those below sigma. A window that begins with no data has none, and then sigma has none and the score
    is 0. Series begin at epoch ``start``; ``compat`` begins at 0, which is no data everywhere, so each score is 0.

    A pixel's series is one array (a pixel has hundreds of epochs), so windows multiply no rows; numpy takes them in Arrow batches.
    """
    start = 0 if compat else start
    own = obs.groupBy(*PIXEL).agg(F.sort_array(F.collect_list(F.struct("obs_date", F.coalesce("value", F.lit(float("nan"))).alias("v")))).alias("s"))

    @F.pandas_udf("sigma double, score double")
    def scores(series):
        import numpy as np
        import pandas as pd

        out = np.full((len(series), 2), np.nan)
        for i, s in enumerate(series):
            x = np.asarray(s, float)[start:]
            if len(x) >= window:
                w = np.lib.stride_tricks.sliding_window_view(x, window)
                seen = ~np.isnan(w)
                with np.errstate(invalid="ignore", divide="ignore"):
                    means = np.cumsum(np.where(seen, w, 0.0), axis=1) / np.cumsum(seen, axis=1)
                d = means.std(axis=1)
                sigma = d.std()
                out[i] = sigma, (d < sigma).mean() if sigma == sigma else 0.0
        return pd.DataFrame(out, columns=["sigma", "score"])

    found = own.withColumn("f", scores(F.transform("s", lambda x: x["v"])))
    return found.select(*PIXEL, F.nanvl("f.sigma", F.lit(None).cast("double")).alias("sigma"), F.coalesce(F.nanvl("f.score", F.lit(0.0)), F.lit(0.0)).alias("score"))
