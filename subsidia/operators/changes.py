"""Change points of station series: pruned dynamic programming over an rbf kernel's cost, and the steps that follow from them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Bounds of the scaled squared distances in the kernel.
LEAST, MOST = 1e-2, 1e2


def median_distance(x) -> float:
    """The median of (x_i - x_j)^2 over all pairs i < j, by counting the pairs below a bound."""
    import numpy as np

    s, n = np.sort(x), len(x)
    pairs, at = n * (n - 1) // 2, np.arange(n)

    def ranked(k):
        lo, hi = -1.0, float(s[-1] - s[0])
        while True:  # the k-th smallest difference lies in (lo, hi]
            mid = lo + (hi - lo) / 2
            if mid in (lo, hi):
                return hi
            below = int((np.searchsorted(s, s + mid, "right") - at - 1).sum())
            lo, hi = (lo, mid) if below >= k else (mid, hi)

    return (ranked((pairs + 1) // 2) ** 2 + ranked(pairs // 2 + 1) ** 2) / 2


def kernel_sums(x, jump: int):
    """Cumulative sums of the kernel exp(-(x_i - x_j)^2 / median) over blocks of ``jump`` points each way: [a, b] holds the sum over the
    first a and b blocks. The distances are clipped, but for a point with itself. Memory goes with the square of the blocks' number."""
    import numpy as np

    m = median_distance(x)
    gamma = 1.0 / m if m else 1.0
    starts = np.arange(0, len(x), jump)
    out = np.zeros((len(starts) + 1, len(starts) + 1))
    for k, i in enumerate(starts):
        part = np.exp(-np.clip(gamma * (x[i : i + jump, None] - x[None]) ** 2, LEAST, MOST))
        part[np.arange(len(part)), np.arange(i, i + len(part))] = 1.0
        out[k + 1, 1:] = np.add.reduceat(part.sum(axis=0), starts)
    return out.cumsum(axis=0).cumsum(axis=1)


def change_points(x, penalty: float = 1.0, jump: int = 5, least: int = 2, prune: bool = True) -> list[int]:
    """Where new segments begin, at multiples of ``jump``: the segmentation with the least sum of costs and ``penalty`` a segment.

    A segment of n points costs n less the kernel's sum over its pairs divided by n. A start that can't be the last one of a best
    segmentation of what has been seen is dropped for good, which changes no result; of equals the earliest start wins.
    """
    import numpy as np

    n = len(x)
    if n < 2 * least:
        return []
    sums = kernel_sums(np.asarray(x, float), jump)
    ends = np.minimum(np.arange(len(sums)) * jump, n)
    best, before, starts = np.full(len(ends), np.inf), np.zeros(len(ends), int), np.array([0])
    best[0] = 0.0
    for b in range(1, len(ends)):
        size = ends[b] - ends[starts]
        kernel = sums[b, b] - sums[starts, b] - sums[b, starts] + sums[starts, starts]
        total = best[starts] + size - kernel / size + penalty
        fits = size >= least
        if fits.any():
            total[~fits] = np.inf
            k = int(total.argmin())
            best[b], before[b] = total[k], starts[k]
            if prune:
                starts = starts[~fits | (total <= best[b] + penalty)]
        starts = np.append(starts, b)
    found, b = [], before[len(ends) - 1]
    while b > 0:
        found.append(int(ends[b]))
        b = before[b]
    return found[::-1]


def peaks(x, height: float) -> list[int]:
    """Local maxima of at least ``height``; the middle of a flat top, none at the ends."""
    out, i = [], 1
    while i < len(x) - 1:
        if x[i] > x[i - 1]:
            j = i
            while j < len(x) - 1 and x[j + 1] == x[i]:
                j += 1
            if j < len(x) - 1 and x[j + 1] < x[i] and x[i] >= height:
                out.append((i + j) // 2)
            i = j
        i += 1
    return out


def features(x, penalty: float, threshold: float, window: int, jump: int, skip_first: bool) -> list[tuple[int, str, float]]:
    """(index, kind, relative change) of the change points and of the peaks of the absolute differences."""
    import numpy as np

    step = np.diff(x)
    at = set(change_points(x, penalty, jump)[int(skip_first) :])
    at |= set(peaks(np.abs(step), 2 * step.std())) if len(step) else set()
    mean = lambda lo, hi: x[max(0, lo) : hi].mean() if hi > max(0, lo) and lo < len(x) else np.nan
    out = []
    with np.errstate(all="ignore"):
        for i in sorted(at):
            before, after = mean(i - window, i), mean(i, i + window)
            change = (after - before) / abs(before)
            if abs(change) > threshold:
                later = abs((mean(i + window, i + 2 * window) - after) / after) if i + window < len(x) else np.nan
                out.append((i, "stair" if later < threshold / 2 else "step", float(change)))
    return out


def _by_station(obs: DataFrame, value: str, find, schema: str) -> DataFrame:
    """``find(values)`` for each station's series in order of date; its first figure is an index, which becomes a date.

    A station has a value a day, some thousands; its series is an array, and stations go through Arrow in batches.
    """
    series = obs.filter(F.col(value).isNotNull() & ~F.isnan(value)).groupBy("station").agg(F.sort_array(F.collect_list(F.struct("obs_date", F.col(value).cast("double").alias("v")))).alias("s"))
    series = series.select("station", F.col("s.obs_date").alias("dates"), F.col("s.v").alias("x"))

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            rows = [(i, found) for i in range(batch.num_rows) for found in find(batch.column(2)[i].values.to_numpy())]
            station = batch.column(0).take(pa.array([i for i, _ in rows], pa.int64()))
            dates = pa.array([batch.column(1)[i].values[f[0]].as_py() for i, f in rows], pa.date32())
            rest = [pa.array([f[k] for _, f in rows]) for k in range(1, len(rows[0][1]))] if rows else []
            if rows:
                yield pa.RecordBatch.from_arrays([station, dates, *rest], names=["station", "obs_date", *[f"_{k}" for k in range(len(rest))]])

    return series.mapInArrow(run, f"station {dict(obs.dtypes)['station']}, obs_date date{schema}")


def station_change_points(obs: DataFrame, value: str = "east", penalty: float = 1.0, jump: int = 5) -> DataFrame:
    """(station, obs_date): the first day of each new segment. Rows without a value don't count; short or flat series have none."""
    return _by_station(obs, value, lambda x: [(i,) for i in change_points(x, penalty, jump)], "")


def step_features(obs: DataFrame, value: str = "east", penalty: float = 1.0, threshold: float = 0.1, window: int = 10, jump: int = 5, skip_first: bool = True) -> DataFrame:
    """(station, obs_date, kind, change): change points and jumps whose means over ``window`` days before and after differ by more than
    ``threshold`` of the one before; a ``stair`` where the next window stays within half of it, else a ``step``.

    ``skip_first`` leaves the first change point out, as the published screening does. A jump is dated by the day before it.
    """
    return _by_station(obs, value, lambda x: features(x, penalty, threshold, window, jump, skip_first), ", kind string, change double")
