"""Figures of all pairs of points by distance bin, without a row for any pair.

Points are packed by square cells, and cells make regions about as wide as the largest distance. A task holds the points of a region and is
sent those of the regions ahead of it a piece at a time, so a point is written about six times however many pairs it is in. Two trees
of boxes are walked at once: where all distances between two boxes fall into one bin (and all differences to one side of the
requirement), the pair is settled by the boxes' moments: numbers, sums and sums of squares. Boxes that are small beside their distance
are settled at each edge by sorting (``crossed``); others are split, and single points are compared only at the bottom, in blocks of pairs
of boxes that lie in the same bins: squared distances are compared with the squares that belong to the edges, so no root is taken.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from subsidia.functions.stages import beside, cut

#: Points of a pack; points of a box at the bottom of its tree, at most; pairs of boxes, and of points, looked at in one step.
TILE, LEAF, STEP, BLOCK = 16_384, 16, 200_000, 32_768
#: Points that a task holds of its own region, those that it compares with them at a time, and those that it packs at a time, at most.
OWN, PIECE, OPEN = 1 << 20, 1 << 19, 1 << 20
#: Cells to the largest distance, at most.
SPLIT = 8
#: Boxes are settled by sorting if they are that small beside an edge's distance and hold that many pairs of points; points of a strip, at least.
SMALL, MANY, STRIP = 0.6, 1 << 22, 48
#: Pairs compared in the time of a pair of strips; places kept until their pairs are compared, and pairs compared in one step (no more, as arrays of 128 KB and more are given back to the system each time).
COMPARED, NEAR = 10_000, 1 << 13
#: Distances and differences are rounded, so a box counts as within a bin only with this relative margin.
MARGIN = 1e-9
#: Bytes of an Arrow batch on its way to a Python worker, unless the session says otherwise.
BATCH_BYTES, BATCH_CONF = 4 << 20, "spark.sql.execution.arrow.maxBytesPerBatch"
#: Classes of equal width that differences are counted in, and differences that a task keeps before it counts the equal ones.
CLASSES, KEPT = 1024, 1 << 20


class Boxes:
    """A binary tree over points in any number of dimensions: level k cuts them into 2^k boxes along their widest side.

    The first two columns of ``points`` are positions in metres, the others u and w; the value is u - w. Boxes are cut along the value
    too if ``by_value``.
    """

    def __init__(self, points, origin, by_value: bool, leaf: int | None = None):
        import numpy as np

        value = points[:, 2] - points[:, 3]
        axes = np.column_stack([points[:, :2], value])
        n = len(points)
        self.depth = max(0, int(np.ceil(np.log2(n / (leaf or LEAF))))) if n else 0
        span = np.ptp(axes, axis=0)
        span[span == 0] = 1.0
        sides = 3 if by_value else 2
        order = np.arange(n)
        for level in range(self.depth):
            cuts = [n * i >> (level + 1) for i in range((2 << level) + 1)]
            for i in range(0, len(cuts) - 2, 2):
                a, m, b = cuts[i : i + 3]
                part = order[a:b]
                side = axes[part, int((np.ptp(axes[part], axis=0) / span)[:sides].argmax())]
                order[a:b] = part[np.argpartition(side, m - a)]
        axes = axes[order]
        flat = axes - origin
        weights = np.column_stack([np.ones(n), flat[:, 2], flat[:, 2] ** 2, flat[:, 0], flat[:, 1], flat[:, 0] ** 2 + flat[:, 1] ** 2])
        self.low, self.high, self.sums = [], [], []
        for level in range(self.depth + 1):
            starts = np.array([n * i >> level for i in range(1 << level)])
            self.low.append(np.minimum.reduceat(axes, starts))
            self.high.append(np.maximum.reduceat(axes, starts))
            self.sums.append(np.add.reduceat(weights, starts))
        self.ends = np.array([n * i >> self.depth for i in range((1 << self.depth) + 1)])
        self.columns = [np.ascontiguousarray(c) for c in points[order].T]


def squares(edges, closed: str):
    """For each edge the greatest square of a distance (metres) that is not beyond it, so that ``square > it`` says what ``distance > edge``
    (or ``>=``, where the bin behind the edge holds it) says of the rounded distance in km."""
    import numpy as np

    out = []
    for k, edge in enumerate(edges):
        strict = closed == "left" or (closed == "both" and k < len(edges) - 1)
        if edge < 0 or (strict and edge == 0):
            out.append(-1.0)
            continue
        if not np.isfinite(edge):
            out.append(edge)
            continue
        before = lambda s, e=edge, strict=strict: (math.sqrt(s) / 1000 < e) if strict else (math.sqrt(s) / 1000 <= e)
        s = (edge * 1000) ** 2
        while before(s):
            s = math.nextafter(s, math.inf)
        while not before(s):
            s = math.nextafter(s, 0.0)
        out.append(s)
    return np.array(out)


def binned(distance, edges, closed: str):
    """Numbers of bins; -1 before the first one, the number of bins behind the last one."""
    import numpy as np

    k = np.searchsorted(edges, distance, "left" if closed == "right" else "right") - 1
    return np.where(distance == edges[-1], len(edges) - 2, k) if closed == "both" else k


def walk(a: Boxes, b: Boxes, same: bool, edges, closed: str, requirement: Callable | None):
    """n, sum of squared distances, sum of half squared differences and n below the requirement, for each bin; ``same``: pairs within a."""
    import numpy as np

    n_bins, borders = len(edges) - 1, squares(edges, closed)
    out = np.zeros((4, n_bins))
    stack = [(0, 0, np.zeros(1, np.int64), np.zeros(1, np.int64))]
    while stack:
        la, lb, ia, ib = stack.pop()
        if len(ia) > STEP:
            for x, y in zip(np.array_split(ia, len(ia) // STEP + 1), np.array_split(ib, len(ia) // STEP + 1), strict=True):
                stack.append((la, lb, x, y))
            continue
        low_a, high_a, low_b, high_b = a.low[la][ia], a.high[la][ia], b.low[lb][ib], b.high[lb][ib]
        least, most = np.maximum(0, np.maximum(low_a - high_b, low_b - high_a)), np.maximum(high_a - low_b, high_b - low_a)
        near, far = np.hypot(least[:, 0], least[:, 1]) / 1000 * (1 - MARGIN), np.hypot(most[:, 0], most[:, 1]) / 1000 * (1 + MARGIN)
        first, last = binned(near, edges, closed), binned(far, edges, closed)
        some = (last >= 0) & (first < n_bins)
        whole = some & (first == last)
        passes = np.zeros(len(ia))
        if requirement is not None:
            all_pass = most[:, 2] * (1 + MARGIN) + MARGIN < requirement(near)
            passes = np.where(all_pass, 1.0, 0.0)
            whole &= all_pass | (least[:, 2] * (1 - MARGIN) - MARGIN >= requirement(far))
        inner = (ia == ib) if same and la == lb else np.zeros(len(ia), bool)
        x, y, k = a.sums[la][ia[whole]], b.sums[lb][ib[whole]], first[whole]
        half = np.where(inner[whole], 0.5, 1.0)  # a box with itself: each pair twice, and each point with itself
        n = half * (x[:, 0] * y[:, 0] - np.where(inner[whole], x[:, 0], 0))
        gamma = half * 0.5 * (x[:, 0] * y[:, 2] + y[:, 0] * x[:, 2] - 2 * x[:, 1] * y[:, 1])
        d2 = half * (x[:, 0] * y[:, 5] + y[:, 0] * x[:, 5] - 2 * (x[:, 3] * y[:, 3] + x[:, 4] * y[:, 4]))
        out += [np.bincount(k, v, n_bins) for v in (n, d2, gamma, n * passes[whole])]
        rest = some & ~whole
        if requirement is None:
            wide = (np.hypot(*(high_a - low_a)[:, :2].T) + np.hypot(*(high_b - low_b)[:, :2].T)) / 2
            away = np.hypot(*(low_a + high_a - low_b - high_b)[:, :2].T) / 2
            least_edge = np.sqrt(np.maximum(borders, 0))[np.minimum(first + 1, n_bins)]
            sorts = rest & ~inner & (wide <= SMALL * least_edge) & (away > wide * (1 + MARGIN)) & (a.sums[la][ia, 0] * b.sums[lb][ib, 0] >= MANY)
            for k in np.flatnonzero(sorts):
                out += crossed(a, b, la, lb, int(ia[k]), int(ib[k]), int(first[k]), int(last[k]), borders)
            rest &= ~sorts
        ia, ib, inner = ia[rest], ib[rest], inner[rest]
        if not len(ia):
            continue
        if la == a.depth and lb == b.depth:
            for at_a, at_b, own, lo, hi in alike(a, b, ia, ib, inner, first[rest], last[rest]):
                out += _points(at_a, at_b, a, b, own, lo, hi, borders, requirement)
            continue
        down_a, down_b, below = la < a.depth, lb < b.depth, []
        for p in (0, 1) if down_a else (None,):
            for q in (0, 1) if down_b else (None,):
                kept = ~inner if (p, q) == (1, 0) else slice(None)  # within a box its two halves meet once
                x, y = ia[kept], ib[kept]
                below.append((x if p is None else 2 * x + p, y if q is None else 2 * y + q))
        stack.append((la + down_a, lb + down_b, *map(np.concatenate, zip(*below, strict=True))))
    return out


class _Strips:
    """Points of a box in a frame whose first axis (t) points to another box: strips along it, each in order of t."""

    def __init__(self, boxes: Boxes, level: int, at: int, along, shift: float, strips: float, value: float):
        import numpy as np

        n = len(boxes.columns[0])
        start, end = n * at >> level, n * (at + 1) >> level
        self.x, self.y, u, w = (c[start:end] for c in boxes.columns)
        middle = (boxes.low[level][at] + boxes.high[level][at]) / 2
        dx, dy = self.x - middle[0], self.y - middle[1]
        t, s = dx * along[0] + dy * along[1], dy * along[0] - dx * along[1]
        low, span = s.min(), np.ptp(s)
        n = int(max(1, min(np.rint(strips), len(s) // STRIP)))
        of = np.minimum((s - low) * (n / (span or 1.0)), n - 1).astype(np.int64)
        order = np.lexsort((t, of))
        t, s = t[order], s[order]
        self.x, self.y, self.v, far = self.x[order], self.y[order], (u - w)[order] - value, t + shift
        self.t, self.moments = t, np.column_stack([np.ones(len(t)), self.v, self.v * self.v, far, s, far * far + s * s])
        ends = np.searchsorted(of[order], np.arange(n + 1))
        self.strips = []  # first and last place, middle, half the width, offsets from the middle, sums of moments up to each place
        for i, j in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True):
            if i < j:
                lo, hi = float(s[i:j].min()), float(s[i:j].max())
                off = s[i:j] - (lo + hi) / 2
                self.strips.append((i, j, (lo + hi) / 2, (hi - lo) / 2, off, off * off, np.concatenate([np.zeros((1, 6)), np.cumsum(self.moments[i:j], axis=0)])))


def crossed(a: Boxes, b: Boxes, la: int, lb: int, ia: int, ib: int, first: int, last: int, borders):
    """The figures of ``walk`` for two boxes that are small beside the distance between them; distances lie in the bins from ``first`` to ``last``.

    In a frame along the line between the boxes a pair is beyond an edge R if D + t_j - t_i > g(s_j - s_i), with g(q) = sqrt(R^2 - q^2). For two
    strips along the line g is nearly a parabola around the strips' offset, whose terms belong to one of the points but for
    s_i * s_j, which narrow strips make small. So one side is sorted, the other one looks up its place, and moments up to there settle all but the
    pairs within that margin, which are compared themselves. Work grows with points times strips rather than with pairs.
    """
    import numpy as np

    n_bins = len(borders) - 1
    gap = (b.low[lb][ib] + b.high[lb][ib] - a.low[la][ia] - a.high[la][ia])[:2] / 2
    away = math.hypot(*gap)
    edges = {k: math.sqrt(borders[k]) for k in range(first + 1, last + 1)}
    wide = float(np.hypot(*np.maximum(a.high[la][ia] - a.low[la][ia], b.high[lb][ib] - b.low[lb][ib])[:2]))
    # As a pair of strips costs as much as some thousand pairs that are compared, and twice as many strips leave a quarter of these.
    strips = (float(a.sums[la][ia, 0]) * float(b.sums[lb][ib, 0]) * wide / min(edges.values()) / COMPARED) ** 0.25
    value = float(a.columns[2][0] - a.columns[3][0])
    p, q = _Strips(a, la, ia, gap / away, 0.0, strips, value), _Strips(b, lb, ib, gap / away, away, strips, value)
    rounding = MARGIN * (away + max(float(np.abs(np.r_[c.low[level][i][:2], c.high[level][i][:2]]).max()) for c, level, i in ((a, la, ia), (b, lb, ib))))
    out = np.zeros((4, n_bins + 2))
    figures = lambda m: np.array([m[0, 0], m[5, 0] + m[0, 5] - 2 * (m[3, 3] + m[4, 4]), 0.5 * (m[2, 0] + m[0, 2]) - m[1, 1], 0.0])
    out[:, first + 1] = figures(np.outer(p.moments.sum(axis=0), q.moments.sum(axis=0)))
    for k, r in edges.items():
        m, near, size = np.zeros((6, 6)), [], 0
        for i0, i1, mid_i, half_i, off_i, square_i, upto_i in p.strips:
            t_i = p.t[i0:i1]
            for j0, j1, mid_j, half_j, off_j, square_j, upto_j in q.strips:
                t_j, c, half = q.t[j0:j1], mid_j - mid_i, half_i + half_j
                g = math.sqrt(r * r - c * c)
                g1, g2, most = -c / g, -r * r / g**3, abs(c) + half
                room = -g2 * half_i * half_j + 3 * most * r * r / (r * r - most * most) ** 2.5 * half**3 / 6 + rounding
                shift = g - away
                slack = abs(g1) * half - g2 * (half_i * half_i + half_j * half_j) / 2 + room
                # Points of one side that no point, or every point, of the other one is beyond the edge of.
                x, y = t_i.searchsorted(t_j[:: len(t_j) - 1 or 1][[0, -1]] + (-shift - slack, slack - shift)).tolist()
                if x:
                    m += upto_i[x][:, None] * upto_j[-1]
                if x == y:
                    continue
                u, w = t_j.searchsorted(t_i[[x, y - 1]] + (shift - slack, shift + slack)).tolist()
                if w < len(t_j):
                    m += (upto_i[y] - upto_i[x])[:, None] * (upto_j[-1] - upto_j[w])
                if u == w:
                    continue
                key_j = t_j[u:w] - (g1 * off_j[u:w] + (g2 / 2) * square_j[u:w])
                key_i = t_i[x:y] + ((g2 / 2) * square_i[x:y] - g1 * off_i[x:y])
                order = key_j.argsort()
                key_j = key_j[order]
                beyond = np.zeros((w - u + 1, 6))  # of the first places, in the order of keys
                q.moments[j0 + u : j0 + w].take(order, axis=0).cumsum(axis=0, out=beyond[1:])
                sure, maybe = key_j.searchsorted(key_i + (shift + room), "right"), key_j.searchsorted(key_i + (shift - room))
                m += p.moments[i0 + x : i0 + y].T @ (beyond[-1] - beyond.take(sure, axis=0))
                order += j0 + u
                near.append((i0 + x, order, maybe, sure - maybe))
                size += len(order) + len(maybe)
                if size > NEAR:
                    m += _compared(p, q, near, borders[k])
                    near, size = [], 0
        moved = figures(m + _compared(p, q, near, borders[k]))
        out[:, k] -= moved
        out[:, k + 1] += moved
    return out[:, 1:-1]


def _compared(p: _Strips, q: _Strips, near: list, border: float):
    """Products of moments, summed over the pairs near an edge whose squared distance is beyond ``border``.

    ``near``: for a pair of strips the first place in p, places in q, and for each place in p the first of these and their number.
    """
    import numpy as np

    m = np.zeros((6, 6))
    if not near:
        return m
    starts, places, first, count = zip(*near, strict=True)
    shift = np.cumsum([0, *map(len, places[:-1])])
    sizes = [len(c) for c in count]
    at_i = np.concatenate([np.arange(s, s + n) for s, n in zip(starts, sizes, strict=True)])
    count = np.concatenate(count)
    first = np.concatenate(first) + np.repeat(shift, sizes) - (np.cumsum(count) - count)
    places, ends = np.concatenate(places), np.cumsum(count)
    a = 0
    while a < len(count):  # blocks of pairs
        b = max(a + 1, int(np.searchsorted(ends, ends[a] - count[a] + NEAR)))
        i = np.repeat(at_i[a:b], count[a:b])
        start = int(ends[a] - count[a])
        j = places[np.arange(start, start + len(i)) + np.repeat(first[a:b], count[a:b])]
        d2, dy = p.x[i] - q.x[j], p.y[i] - q.y[j]
        d2 *= d2
        dy *= dy
        d2 += dy
        beyond = np.flatnonzero(d2 > border)
        v = p.v[i[beyond]] - q.v[j[beyond]]
        m[0, 0] += len(beyond)
        m[5, 0] += d2[beyond].sum()
        m[2, 0] += v @ v
        a = b
    return m


def alike(a: Boxes, b: Boxes, ia, ib, inner, first, last):
    """Pairs of bottom boxes of the same sizes and bins, at most ``BLOCK`` pairs of points at a time: (indexes of their points in a, in b,
    whether they are boxes with themselves, first bin, last bin)."""
    import numpy as np

    if not len(ia):
        return
    wide_a, wide_b = np.diff(a.ends)[ia], np.diff(b.ends)[ib]
    keys = np.stack([wide_a, wide_b, inner, first, last])
    order = np.lexsort(keys)
    starts = np.flatnonzero(np.r_[True, (np.diff(keys[:, order], axis=1) != 0).any(axis=0)])
    for start, end in zip(starts, np.r_[starts[1:], len(order)], strict=True):
        w_a, w_b, own, lo, hi = keys[:, order[start]].tolist()
        size = max(1, BLOCK // (w_a * w_b))
        for i in range(start, end, size):
            at = order[i : min(i + size, end)]
            yield a.ends[ia[at], None] + np.arange(w_a), b.ends[ib[at], None] + np.arange(w_b), bool(own), lo, hi


def _cross(a: Boxes, b: Boxes, at_a, at_b, c: int):
    return a.columns[c][at_a][:, :, None] - b.columns[c][at_b][:, None, :]


def _squared(a: Boxes, b: Boxes, at_a, at_b):
    dx, dy = _cross(a, b, at_a, at_b, 0), _cross(a, b, at_a, at_b, 1)
    dx *= dx
    dy *= dy
    dx += dy
    return dx.ravel()


def _difference(a: Boxes, b: Boxes, at_a, at_b):
    v = _cross(a, b, at_a, at_b, 2)
    if a.columns[3].any() or b.columns[3].any():
        v -= _cross(a, b, at_a, at_b, 3)
    return v.ravel()


def _points(at_a, at_b, a, b, own, first, last, borders, requirement):
    """The figures of ``walk`` for pairs of bottom boxes, point by point; their distances lie in the bins from ``first`` to ``last``.

    All pairs count for the first bin, and those beyond an edge are moved on, so a pair is compared with the few edges between. In boxes
    with themselves each pair is met twice and each point meets itself.
    """
    import numpy as np

    n_bins = len(borders) - 1
    d2, v = _squared(a, b, at_a, at_b), _difference(a, b, at_a, at_b)
    passed = np.abs(v) < requirement(np.sqrt(d2) / 1000) if requirement is not None else None
    v *= v
    out = np.zeros((4, n_bins + 2))  # with what lies before and behind the bins
    count = lambda x: 0 if x is None else np.count_nonzero(x)
    out[:, first + 1] = len(d2), d2.sum(), 0.5 * v.sum(), count(passed)
    for k in range(first + 1, last + 1):
        beyond = d2 > borders[k]
        n = np.count_nonzero(beyond)
        if n:
            weight = beyond.astype(float)
            moved = n, weight @ d2, 0.5 * (weight @ v), count(passed & beyond if passed is not None else None)
            out[:, k] -= moved
            out[:, k + 1] += moved
    if own:
        k = int((borders < 0).sum())  # where a distance of 0 lies
        out[0, k] -= at_a.size
        out[3, k] -= at_a.size if passed is not None and requirement(np.zeros(1))[0] > 0 else 0
        out *= 0.5
    return out[:, 1:-1]


def met_tiles(points: DataFrame, reach: float, by: list[str], u: str, w: str | None, tile: int) -> DataFrame:
    """by, _same, _a, _b: all pairs of tiles with points (x, y, u, w) at most ``reach`` metres apart, each once, dealt over all tasks.

    Cells are squares of a fraction of ``reach``, as fine as a tile needs where points are even; a crowded cell is cut into tiles at random.
    """
    group = F.struct(*by) if by else F.lit(0)  # structs with the same nulls are equal
    p = points.select(group.alias("_g"), F.col("x").cast("double").alias("_x"), F.col("y").cast("double").alias("_y"), F.col(u).cast("double").alias("_u"), (F.col(w).cast("double") if w else F.lit(0.0)).alias("_w"))
    p = p.filter(" AND ".join(f"{c} IS NOT NULL AND NOT isnan({c})" for c in ("_x", "_y", "_u", "_w")))
    p = cut(p.withColumn("_id", F.monotonically_increasing_id()))  # the numbers deal points to tiles, so they have to stay
    wide = p.groupBy("_g").agg(F.count("*").alias("n"), ((F.max("_x") - F.min("_x")) / reach).alias("x"), ((F.max("_y") - F.min("_y")) / reach).alias("y"))
    held = wide.agg(F.max(F.col("n") / (F.greatest("x", F.lit(1.0)) * F.greatest("y", F.lit(1.0))))).first()[0] or 0  # points to a square of reach
    split = min(SPLIT, max(1, round(math.sqrt(held / tile))))
    side = reach / split * (1 + MARGIN)
    p = p.withColumn("_cx", F.floor(F.col("_x") / side).cast("long")).withColumn("_cy", F.floor(F.col("_y") / side).cast("long"))
    cell = ["_g", "_cx", "_cy"]
    cells = cut(p.groupBy(*cell).agg(F.ceil(F.count("*") / tile).cast("long").alias("_tiles")))
    dealt = p.join(cells, cell).withColumn("_t", F.pmod(F.xxhash64("_id"), "_tiles"))
    tiles = cut(dealt.groupBy(*cell, "_t").agg(F.collect_list(F.array("_x", "_y", "_u", "_w")).alias("_p")))
    # Cells meet those behind them once; the key holds both tiles, so a crowded cell isn't one key. The points are joined last.
    steps = [(dx, dy) for dx in range(-split, split + 1) for dy in range(-split, split + 1) if (dx, dy) >= (0, 0) and math.hypot(max(abs(dx) - 1, 0), max(abs(dy) - 1, 0)) <= split]
    ahead = F.explode(F.array(*[F.struct((F.col("_cx") + dx).alias("_bx"), (F.col("_cy") + dy).alias("_by"), F.lit((dx, dy) == (0, 0)).alias("_self")) for dx, dy in steps]))
    numbers = lambda c, name: F.explode(F.sequence(F.lit(0).cast("long"), F.col(c) - 1)).alias(name)
    left = cells.select(*cell, "_tiles", ahead.alias("_n")).select("_g", "_cx", "_cy", "_tiles", "_n.*").select("_g", "_cx", "_cy", "_bx", "_by", "_self", numbers("_tiles", "_t"))
    right = cells.select("_g", F.col("_cx").alias("_bx"), F.col("_cy").alias("_by"), numbers("_tiles", "_s"))
    both = left.join(right, ["_g", "_bx", "_by"]).filter("NOT _self OR _t <= _s")
    spark = points.sparkSession
    parts = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))  # rows are few and heavy, so they aren't to be put together by size
    one = both.join(tiles.withColumnRenamed("_p", "_a").hint("shuffle_hash"), [*cell, "_t"])
    two = tiles.select("_g", F.col("_cx").alias("_bx"), F.col("_cy").alias("_by"), F.col("_t").alias("_s"), F.col("_p").alias("_b")).hint("shuffle_hash")
    met = one.join(two, ["_g", "_bx", "_by", "_s"]).repartition(parts)
    return met.select(*[F.col("_g")[c].alias(c) for c in by], (F.col("_self") & (F.col("_t") == F.col("_s"))).alias("_same"), "_a", "_b")


def dealt(points: DataFrame, reach: float, by: list[str], u: str, w: str | None, tile: int) -> DataFrame:
    """by, _rx, _ry, _t, _share, _role, _n, _p: for each task the packed points of its own part of a region (_role 0, in each share of the work)
    and those that it has to meet (_role 1), so that all points at most ``reach`` metres apart meet once; in this order in a partition.

    Regions are squares of ``reach``, or of a fraction of it where there are few, so a point is sent to its own region and to the four
    behind it. Parts of a crowded region have at most about ``tile`` points each.
    """
    spark = points.sparkSession
    parts = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    held = {"_x": F.col("x"), "_y": F.col("y"), "_u": F.col(u), "_w": F.col(w) if w else F.lit(0.0)}
    p = points.select(*by, *[c.cast("double").alias(n) for n, c in held.items()])
    p = p.filter(" AND ".join(f"{c} IS NOT NULL AND NOT isnan({c})" for c in held))
    side = reach / SPLIT * (1 + MARGIN)
    p = p.select(*by, *[F.floor(F.col(c) / side).cast("long").alias(n) for c, n in (("_x", "_cx"), ("_y", "_cy"))], *held)
    kinds = "".join(f"`{c}` {dict(points.dtypes)[c]}, " for c in by)
    spread = p.withColumn("_s", F.spark_partition_id() % SPLIT).repartition(parts, *by, "_cx", "_cy", "_s").drop("_s")  # no cell is one task's
    packs = cut(spread.mapInArrow(_packed(len(by) + 2, min(TILE, tile)), kinds + "_cx long, _cy long, _n long, _p binary").withColumn("_id", F.monotonically_increasing_id()))
    # Packs are numbered from here on, so that they are dealt alike whenever a task is run again.
    wanted = 6 * spark.sparkContext.defaultParallelism
    region = lambda split: [*by, *[F.floor(F.col(c) / (SPLIT // split)).cast("long").alias(n) for c, n in (("_cx", "_rx"), ("_cy", "_ry"))]]
    splits = [1, 2, 4, 8]
    total, *regions = packs.agg(F.coalesce(F.sum("_n"), F.lit(0)), *[F.count_distinct(F.struct(*region(s))) for s in splits]).first()
    split, steps = 0, []
    for split, n in zip(splits, regions, strict=True):
        steps = [(dx, dy) for dx in range(-split, split + 1) for dy in range(-split, split + 1) if (dx, dy) > (0, 0) and math.hypot(max(abs(dx) - 1, 0), max(abs(dy) - 1, 0)) <= split]
        if n * (len(steps) + 1) >= wanted:
            break
    tile = min(tile, max(TILE, -(-4 * total // wanted)))
    key = [*by, "_rx", "_ry"]
    packs = packs.select("*", *region(split)[len(by) :])
    tiles = beside(packs.groupBy(*key).agg(F.ceil(F.sum("_n") / tile).cast("long").alias("_tiles")))
    n_tiles = tiles.agg(F.coalesce(F.sum("_tiles"), F.lit(0))).first()[0]
    shares = min(len(steps) + 1, max(1, -(-wanted // max(n_tiles, 1))))
    same = lambda x, y: x.eqNullSafe(y)
    mine = packs.alias("p").join(tiles.alias("t"), [same(F.col(f"p.{c}"), F.col(f"t.{c}")) for c in key]).select("p.*", F.pmod("_id", "_tiles").alias("_of"), "_tiles")
    own = mine.select(*key, F.col("_of").alias("_t"), F.explode(F.sequence(F.lit(0), F.lit(shares - 1))).alias("_share"), F.lit(0).alias("_role"), F.lit(0).cast("long").alias("_from"), "_n", "_p")
    share = F.pmod(F.xxhash64("_rx", "_ry", "_of"), F.lit(shares)).cast("int")
    within = mine.filter("_of > 0").select(*key, F.explode(F.sequence(F.lit(0).cast("long"), F.col("_of") - 1)).alias("_t"), share.alias("_share"), F.lit(1).alias("_role"), F.col("_of").alias("_from"), "_n", "_p")
    k = SPLIT // split
    apart = lambda c, r: F.greatest(F.col(r) * k - F.col(c) - 1, F.col(c) - (F.col(r) * k + k - 1) - 1, F.lit(0))
    behind = F.explode(F.array(*[F.struct((F.col("_rx") - dx).alias("_ax"), (F.col("_ry") - dy).alias("_ay")) for dx, dy in steps]))
    met = mine.select(*by, "_cx", "_cy", behind.alias("_a"), share.alias("_share"), F.xxhash64("_rx", "_ry", "_of").alias("_from"), "_n", "_p").select("*", F.col("_a._ax").alias("_rx"), F.col("_a._ay").alias("_ry"))
    met = met.filter(F.hypot(apart("_cx", "_rx").cast("double"), apart("_cy", "_ry").cast("double")) <= SPLIT)
    met = met.alias("p").join(tiles.alias("t"), [same(F.col(f"p.{c}"), F.col(f"t.{c}")) for c in key]).select("p.*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_tiles") - 1)).alias("_t"))
    met = met.select(*key, "_t", "_share", F.lit(1).alias("_role"), "_from", "_n", "_p")
    task = [*key, "_t", "_share"]
    apiece = max(parts, min(n_tiles * shares, 20_000))
    return own.unionByName(within).unionByName(met).repartition(apiece, *task).sortWithinPartitions(*task, "_role", "_from").drop("_from")


def _packed(n_keys: int, most: int):
    """Packs the points of a cell, up to ``most`` a pack: their number, and x, y, u, w as compressed bytes."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        codec, names, kept, size = pa.Codec("zstd", compression_level=1), None, {}, 0

        def pack(key, parts):
            whole = np.concatenate(parts, axis=1)
            for i in range(0, whole.shape[1], most):
                some = np.ascontiguousarray(whole[:, i : i + most])
                planes = np.ascontiguousarray(some.view(np.uint8).reshape(4, -1, 8).transpose(0, 2, 1))  # alike bytes side by side
                rows.append((*key, some.shape[1], codec.compress(planes.tobytes(), asbytes=True)))

        def written():
            columns = list(zip(*rows, strict=True))
            kinds = [*types, pa.int64(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=names)

        for batch in batches:
            if not batch.num_rows:
                continue
            names, types, rows = [*batch.schema.names[:n_keys], "_n", "_p"], batch.schema.types[:n_keys], []
            code = np.zeros(batch.num_rows, np.int64)
            for c in batch.columns[:n_keys]:
                place = c.dictionary_encode("encode").indices.to_numpy()
                code = np.unique(code * (int(place.max()) + 1) + place, return_inverse=True)[1]
            order = np.argsort(code, kind="stable")
            values = np.stack([c.to_numpy() for c in batch.columns[n_keys:]])[:, order]
            starts = np.flatnonzero(np.r_[True, np.diff(code[order]) != 0])
            for i, j in zip(starts.tolist(), [*starts[1:].tolist(), len(order)], strict=True):
                key = tuple(c[int(order[i])].as_py() for c in batch.columns[:n_keys])
                kept.setdefault(key, []).append(values[:, i:j])
            size += len(order)
            if size > OPEN:
                for key, found in kept.items():
                    pack(key, found)
                kept, size = {}, 0
                yield written()
        rows = []
        for key, found in kept.items():
            pack(key, found)
        if rows:
            yield written()

    return run


def _unpacked(packs: list[tuple[int, bytes]]):
    """x, y, u, w of the points of packs, a row a point."""
    import numpy as np
    import pyarrow as pa

    codec, found = pa.Codec("zstd"), []
    for n, data in packs:
        planes = np.frombuffer(codec.decompress(data, decompressed_size=32 * n, asbytes=True), np.uint8).reshape(4, 8, n)
        found.append(np.ascontiguousarray(planes.transpose(0, 2, 1)).view(np.float64).reshape(4, n).T)
    return np.concatenate(found)


def pair_figures(points: DataFrame, edges: list[float], by: list[str] | None = None, u: str = "v", w: str | None = None, closed: str = "left", requirement: Callable | None = None, tile: int = OWN) -> DataFrame:
    """by, bin, n, distance (root mean square, km), gamma (mean of half the squared difference) and n_pass over all unordered pairs
    of points (x, y in metres) of a group ``by`` whose distance lies in a bin of ``edges`` (km; bins are closed on the ``closed`` side,
    with ``both`` on the left, the last one on both).

    A point's value is u, or u - w; n_pass counts differences below ``requirement``, a function of distances that never
    falls, on numpy arrays. Points without position or value are left out; repeated points are points of their own, at distance 0.
    Bins without pairs have no row. ``dealt`` says how points are dealt; a task holds about ``tile`` of them, and as many others at a time.
    """
    import numpy as np

    by = by or []
    kinds = dict(points.dtypes)
    borders = np.array(edges, float)
    n_by, leaf = len(by), LEAF if requirement is None else 4 * LEAF  # a requirement that grows with distance settles few boxes

    def add(batches):
        import pyarrow as pa

        names = [*by, "bin", "_n", "_d2", "_half", "_pass"]
        task, own, origin, ahead, size, sums, group = None, [], None, [], 0, None, None

        def done(last: bool):
            """Meets what has come with the task's own points; ``own`` is a list of packs until the first time."""
            nonlocal own, origin, ahead, size
            if isinstance(own, list) and own:
                points = _unpacked(own)
                origin = np.array([*points[0, :2], points[0, 2] - points[0, 3]])
                own = Boxes(points, origin, False, leaf)
                del points
                if task[-1] == 0:
                    sums[:] += walk(own, own, True, borders, closed, requirement)
            if ahead and own:  # a part may have got no packs
                sums[:] += walk(own, Boxes(_unpacked(ahead), origin, False, leaf), False, borders, closed, requirement)
            ahead, size = [], 0
            if last:
                k = np.flatnonzero(sums[0])
                keys = [pa.concat_arrays([c] * len(k)) if len(k) else c.slice(0, 0) for c in group]
                n, d2, g, passed = sums[:, k]
                return pa.RecordBatch.from_arrays([*keys, pa.array(k, pa.int32()), pa.array(np.rint(n).astype(np.int64)), pa.array(d2), pa.array(g), pa.array(np.rint(passed).astype(np.int64))], names=names)

        for batch in batches:
            for i in range(batch.num_rows):
                key = tuple("nan" if v != v else v for v in (c[i].as_py() for c in batch.columns[: n_by + 4]))
                role, n, data = (c[i].as_py() for c in batch.columns[n_by + 4 :])
                if key != task:
                    if task is not None:
                        yield done(True)
                    task, own, sums, group = key, [], np.zeros((4, len(borders) - 1)), [c.slice(i, 1) for c in batch.columns[:n_by]]
                if role == 0:
                    own.append((n, data))
                    continue
                if size and size + n > PIECE:
                    done(False)
                ahead.append((n, data))
                size += n
        if task is not None:
            yield done(True)

    schema = "".join(f"`{c}` {kinds[c]}, " for c in by) + "bin int, _n long, _d2 double, _half double, _pass long"
    conf = points.sparkSession.conf
    if conf.get(BATCH_CONF, None) is None:
        conf.set(BATCH_CONF, str(BATCH_BYTES))  # a batch would have 10,000 packs
    parts = dealt(points, float(edges[-1]) * 1000, by, u, w, tile)
    found = parts.mapInArrow(add, schema).groupBy(*by, "bin").agg(F.sum("_n").alias("n"), F.sum("_d2").alias("_d2"), F.sum("_half").alias("_half"), F.sum("_pass").alias("n_pass"))
    return found.select(*by, "bin", "n", (F.sqrt(F.greatest(F.col("_d2"), F.lit(0.0)) / F.col("n")) / 1000).alias("distance"), (F.greatest(F.col("_half"), F.lit(0.0)) / F.col("n")).alias("gamma"), "n_pass")


def ranked_differences(points: DataFrame, edges: list[float], rank: Callable[[int], list[int]], u: str = "v", w: str | None = None, closed: str = "right", requirement: float = 0.0, tile: int = 4_096) -> dict[int, tuple[int, int, list[float]]]:
    """For each bin of ``edges`` (km) that holds pairs, and for all bins as -1: the number of pairs, of those whose difference is below
    ``requirement``, and the differences of the ranks (from 0) that ``rank`` names for that number.

    A first pass counts the pairs by bin and ``CLASSES`` of the difference; a second one counts the different values within the classes
    that hold a rank. Nothing but these counts leaves a task. Points and bins are as in ``pair_figures``.
    """
    import numpy as np

    n_bins, names = len(edges) - 1, "bin int, at double, passed boolean, n long"
    met = cut(met_tiles(points, float(edges[-1]) * 1000, [], u, w, tile))
    value = F.col(u).cast("double") - (F.col(w).cast("double") if w else F.lit(0.0))
    span = points.filter(~F.isnan(value)).agg(F.max(value) - F.min(value)).first()[0] or 0.0
    scale = CLASSES / (span * (1 + MARGIN) + 1e-300)
    borders = np.array(edges, float)

    def classes(batches):
        counts = np.zeros((n_bins + 2, CLASSES, 2), np.int64)
        for lo, hi, half, d2, v in _pieces(batches, borders, closed):
            key = np.minimum(v * scale, CLASSES - 1).astype(np.int32) * 2 + (v < requirement)
            if d2 is not None:
                for k in range(lo + 1, hi + 1):
                    key += (d2 > half[1][k]) * (2 * CLASSES)
            found = np.bincount(key, minlength=(hi - lo + 1) * 2 * CLASSES).reshape(-1, CLASSES, 2)
            counts[lo + 1 : hi + 2] += 2 * found if half[0] is None else found
            if half[0]:
                counts[half[2], 0, int(requirement > 0)] -= half[0]
        counts = counts[1:-1] // 2
        at = np.nonzero(counts)
        yield _rows(at[0], at[1].astype(float), at[2].astype(bool), counts[at])

    held = met.mapInArrow(classes, names).groupBy("bin", "at", "passed").agg(F.sum("n").alias("n")).collect()  # bounded by bins and classes
    counts = np.zeros((n_bins, CLASSES, 2), np.int64)
    for r in held:
        counts[r["bin"], int(r["at"]), int(r["passed"])] = r["n"]
    groups = {k: counts[k] for k in range(n_bins) if counts[k].any()}
    if groups:
        groups[-1] = counts.sum(axis=0)
    wanted, ranks, before = np.zeros((n_bins + 1, CLASSES), bool), {}, {}
    for g, c in groups.items():
        upto = np.cumsum(c.sum(axis=1))
        ranks[g] = rank(int(upto[-1]))
        for r in ranks[g]:
            k = int(np.searchsorted(upto, r, "right"))
            wanted[g, k] = True
            before[g, k] = int(upto[k] - c[k].sum())

    def values(batches):
        kept, size = {g: [] for g in groups}, 0

        def counted():
            for g, parts in kept.items():
                if parts:
                    found, place = np.unique(np.concatenate([x for x, _ in parts]), return_inverse=True)
                    kept[g] = [(found, np.bincount(place, np.concatenate([n for _, n in parts])).astype(np.int64))]

        for lo, hi, half, d2, v in _pieces(batches, borders, closed):
            at = np.minimum(v * scale, CLASSES - 1).astype(np.int32)
            near = np.flatnonzero(wanted[[-1, *range(max(lo, 0), min(hi, n_bins - 1) + 1)]].any(axis=0)[at])
            at, v = at[near], v[near]
            bin_ = np.full(len(near), lo)
            if d2 is not None:
                for k in range(lo + 1, hi + 1):
                    bin_ += d2[near] > half[1][k]
            times = 2 if half[0] is None else 1
            inside = (bin_ >= 0) & (bin_ < n_bins)
            for g in [-1, *range(max(lo, 0), min(hi, n_bins - 1) + 1)]:
                if g in kept:
                    x = v[wanted[g][at] & (inside if g < 0 else bin_ == g)]
                    if len(x):
                        kept[g].append((x, np.full(len(x), times, np.int64)))
                        size += len(x)
            if half[0] and 0 <= half[2] - 1 < n_bins:
                for g in (half[2] - 1, -1):
                    if g in kept and wanted[g, 0]:
                        kept[g].append((np.zeros(1), np.array([-half[0]])))
            if size > KEPT:
                counted()
                size = 0
                if sum(len(x) for parts in kept.values() for x, _ in parts) > KEPT:  # hardly any are equal
                    for g, parts in kept.items():
                        for x, n in parts:
                            yield _rows(np.full(len(x), g), x, np.zeros(len(x), bool), n)
                        kept[g] = []
        counted()
        for g, parts in kept.items():
            for x, n in parts:
                yield _rows(np.full(len(x), g), x, np.zeros(len(x), bool), n)

    found = met.mapInArrow(values, names).groupBy("bin", "at").agg((F.sum("n") / 2).cast("long").alias("n")).filter("n > 0")
    # Classes in order of values, so ranks are counted within a class of a bin.
    place = F.array(*[F.struct(F.lit(g).alias("g"), F.lit(k).alias("k"), F.lit(b).cast("long").alias("b")) for (g, k), b in before.items()])
    out = {g: (int(c.sum()), int(c[:, 1].sum()), []) for g, c in groups.items()}
    if not groups:
        return out
    kind = F.least(F.floor(F.col("at") * scale), F.lit(CLASSES - 1)).cast("int")
    base = F.filter(place, lambda p: (p["g"] == F.col("bin")) & (p["k"] == F.col("k")))[0]["b"]
    order = Window.partitionBy("bin", "k").orderBy("at")
    to = found.withColumn("k", kind).withColumn("to", base + F.sum("n").over(order))
    asked = F.array(*[F.struct(F.lit(g).alias("g"), F.lit(i).alias("i"), F.lit(r).cast("long").alias("r")) for g in groups for i, r in enumerate(ranks[g])])
    hits = to.withColumn("q", F.explode(F.filter(asked, lambda q: (q["g"] == F.col("bin")) & (q["r"] < F.col("to")) & (q["r"] >= F.col("to") - F.col("n")))))
    for r in sorted(hits.select("bin", "q.i", "at").collect()):  # one row a rank
        out[r["bin"]][2].append(r["at"])
    return out


def _pieces(batches, edges, closed: str):
    """Blocks of point pairs of the met tiles: first bin, last bin, (pairs that are points with themselves or None where each pair is met
    once, borders, bin of a distance of 0 plus one), squared distances (None within one bin) and absolute differences."""
    import numpy as np

    borders = squares(edges, closed)
    zero = int((borders < 0).sum())
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1)
            same = row.column(0)[0].as_py()
            p, q = (row.column(c).flatten().flatten().to_numpy().reshape(-1, 4) for c in (1, 2))
            a = Boxes(p, np.zeros(3), False, 4 * LEAF)
            b = a if same else Boxes(q, np.zeros(3), False, 4 * LEAF)
            ia, ib = (x.ravel() for x in np.meshgrid(np.arange(len(a.ends) - 1), np.arange(len(b.ends) - 1), indexing="ij"))
            if same:
                ia, ib = ia[ia <= ib], ib[ia <= ib]
            low_a, high_a, low_b, high_b = a.low[-1][ia, :2], a.high[-1][ia, :2], b.low[-1][ib, :2], b.high[-1][ib, :2]
            least, most = np.maximum(0, np.maximum(low_a - high_b, low_b - high_a)), np.maximum(high_a - low_b, high_b - low_a)
            near, far = np.hypot(*least.T) / 1000 * (1 - MARGIN), np.hypot(*most.T) / 1000 * (1 + MARGIN)
            first, last = binned(near, edges, closed), binned(far, edges, closed)
            some = (last >= 0) & (first < len(edges) - 1)
            ia, ib = ia[some], ib[some]
            for at_a, at_b, own, lo, hi in alike(a, b, ia, ib, (ia == ib) & same, first[some], last[some]):
                d2 = _squared(a, b, at_a, at_b) if lo < hi else None
                yield lo, hi, (at_a.size if own else None, borders, zero), d2, np.abs(_difference(a, b, at_a, at_b))


def _rows(bins, at, passed, n):
    import pyarrow as pa

    return pa.RecordBatch.from_arrays([pa.array(bins, pa.int32()), pa.array(at), pa.array(passed), pa.array(n, pa.int64())], names=["bin", "at", "passed", "n"])


def later_within(stations: DataFrame, requirement: float, tile: int = 4_096) -> DataFrame:
    """station, n, p: for each station the number of stations with a greater name, and of those whose double difference
    |(gnss - gnss') - (insar - insar')| is below ``requirement``; stations with none after them have no row.

    Stations lie in ranges of their names. Every station of a range is before every one of a later range, so two ranges need no pairs:
    the later one's residuals are sorted, and two searches count those below the requirement. What rounding could
    decide is compared itself. Work grows with stations times ranges. Stations without a value are left out; rows with one name count apart.
    """
    held = cut(stations.filter("gnss IS NOT NULL AND insar IS NOT NULL").select("station", F.col("gnss").cast("double").alias("g"), F.col("insar").cast("double").alias("i")))
    n_tiles = max(1, -(-held.count() // tile))
    ranges = held.repartitionByRange(n_tiles, "station").withColumn("_t", F.spark_partition_id())
    tiles = cut(ranges.groupBy("_t").agg(*[F.collect_list(c).alias(c) for c in ("station", "g", "i")]))
    ahead = tiles.select(F.explode(F.sequence("_t", F.lit(n_tiles - 1))).alias("_t"), F.col("_t").alias("_from"), *[F.col(c).alias(f"{c}_1") for c in ("station", "g", "i")])
    met = ahead.join(tiles, "_t").select((F.col("_t") == F.col("_from")).alias("same"), "station_1", "g_1", "i_1", "station", "g", "i")

    def count(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            for k in range(batch.num_rows):
                same, names, g1, i1, others, g2, i2 = (c[k] for c in batch.columns)
                (g1, i1, g2, i2), keys = (c.values.to_numpy() for c in (g1, i1, g2, i2)), names.values
                r1, r2 = g1 - i1, g2 - i2
                if same.as_py():
                    _, rank = np.unique(keys.to_numpy(zero_copy_only=False), return_inverse=True)
                    later = [rank > x for x in rank]
                    n = np.array([x.sum() for x in later])
                    p = np.array([(np.abs((g1[a] - g2) - (i1[a] - i2)) < requirement)[x].sum() for a, x in enumerate(later)])
                else:
                    order = np.argsort(r2, kind="stable")
                    ranked, room = r2[order], MARGIN * (np.abs(r1) + np.abs(r2).max() + requirement)
                    at = lambda x: np.searchsorted(ranked, x)  # noqa: B023, E731
                    outer, inner = (at(r1 - requirement - room), at(r1 + requirement + room)), (at(r1 - requirement + room), at(r1 + requirement - room))
                    n, p = np.full(len(r1), len(r2)), np.maximum(inner[1] - inner[0], 0)
                    for a in np.flatnonzero(outer[1] - outer[0] != p):
                        near = order[outer[0][a] : outer[1][a]]
                        p[a] = (np.abs((g1[a] - g2[near]) - (i1[a] - i2[near])) < requirement).sum()
                yield pa.RecordBatch.from_arrays([keys, pa.array(n.astype(np.int64)), pa.array(p.astype(np.int64))], names=["station", "n", "p"])

    spark = stations.sparkSession
    parts = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    found = met.repartition(parts).mapInArrow(count, f"station {dict(stations.dtypes)['station']}, n long, p long")
    return found.groupBy("station").agg(F.sum("n").alias("n"), F.sum("p").alias("p")).filter("n > 0")
