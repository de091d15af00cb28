"""Whitening of embeddings by principal components, found with contour integration (FEAST).

Sums and the centred scatter matrix are added up per task and by Spark; only a matrix of the vectors' width squared reaches the
driver. The spectrum is cut into intervals by inertia counts. Each interval is a task of its own: a quadrature of the resolvent
(zI - V)^-1 on a circle through the interval's ends, applied to a block of vectors, filters out all but the interval's
eigenvectors, Rayleigh-Ritz extracts them, and the two steps repeat until the residuals are at rounding level. The number found
must equal the inertia count, so none is missed.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subsidia.llm.common import in_arrow, staged

#: Eigenvalues in an interval, where the spectrum lets itself be cut so; nodes of a quadrature; rounds of a filter.
IN_INTERVAL, NODES, ROUNDS = 8, 12, 40
#: A component whose eigenvalue is a smaller part of the largest one is rounding noise and left out.
RANK_TOLERANCE = 1e-10
#: No border of an interval has an eigenvalue nearer than this part of the norm.
BORDER = 1e-9
#: Larger entries would not fit the exact integer sums.
LARGEST = 2**40


def integers(vectors):
    """floor(64 c) + 1,000,000 of each entry, as 64-bit integers."""
    import numpy as np

    x = np.floor(64.0 * vectors)
    if x.size and np.abs(x).max() > LARGEST:
        raise OverflowError(f"an entry of more than 2^40 / 64 in a vector: {np.abs(vectors).max()}")
    return x.astype(np.int64) + 1_000_000


def matrix(column):
    """A column of lists of one length, without nulls, as a matrix of doubles."""
    import numpy as np

    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def usable(rows: DataFrame, vector: str = "embedding") -> DataFrame:
    """The rows whose vector is there, has only finite entries and has the commonest length (the larger of two as common).

    Vectors that are null, or hold null, NaN or infinite entries, and vectors of another length are left out. Repeated rows are kept.
    """
    finite = rows.filter(F.forall(F.col(vector).cast("array<double>"), lambda c: F.coalesce(F.abs(c) < float("inf"), F.lit(False))))
    sizes = finite.groupBy(F.size(vector).alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return finite.filter(F.size(vector) == (sizes["d"] if sizes else 0))


def summed(rows: DataFrame, vector: str, convert, kind: str) -> tuple[int, list]:
    """The number of rows and the sums of ``convert(matrix)`` by dimension; one row a task is added up by Spark."""

    def add(batches):
        import pyarrow as pa

        n, total = 0, None
        for b in batches:
            if b.num_rows:
                part = convert(matrix(b.column(0))).sum(axis=0)
                n, total = n + b.num_rows, part if total is None else total + part
        if n:
            yield pa.RecordBatch.from_pydict({"n": [n], "s": [total.tolist()]})

    parts = in_arrow(rows.select(F.col(vector).cast("array<double>")), add, f"n long, s array<{kind}>")
    got = parts.select("n", F.posexplode("s").alias("j", "v")).groupBy("j").agg(F.sum("n").alias("n"), F.sum("v").alias("v")).orderBy("j").collect()
    return (got[0]["n"] if got else 0), [r["v"] for r in got]


def covariance(rows: DataFrame, vector: str, centre, n: int):
    """The covariance (divisor n) of rows that ``centre`` turns into centred doubles: d by d, on the driver."""
    import numpy as np

    def add(batches):
        import pyarrow as pa

        total = None
        for b in batches:
            if b.num_rows:
                y = centre(matrix(b.column(0)))
                total = y.T @ y if total is None else total + y.T @ y
        if total is not None:
            yield pa.RecordBatch.from_pydict({"i": list(range(len(total))), "s": total.tolist()}, schema=pa.schema([("i", pa.int32()), ("s", pa.list_(pa.float64()))]))

    parts = in_arrow(rows.select(F.col(vector).cast("array<double>")), add, "i int, s array<double>")
    got = parts.select("i", F.posexplode("s").alias("j", "v")).groupBy("i", "j").agg(F.sum("v").alias("v")).toPandas()
    d = int(got["i"].max()) + 1 if len(got) else 0
    out = np.zeros((d, d))
    out[got["i"], got["j"]] = got["v"]
    return (out + out.T) / (2 * n) if d else out


class Inertia:
    """How many eigenvalues of a symmetric matrix lie below a number: the negative pivots of the shifted tridiagonal form."""

    def __init__(self, a):
        import numpy as np

        t = np.array(a, float)
        for k in range(len(t) - 2):  # Householder reflections
            x = t[k + 1 :, k].copy()
            x[0] += np.copysign(np.linalg.norm(x), x[0])
            if (size := np.linalg.norm(x)) > 0:
                x /= size
                t[k + 1 :] -= 2 * np.outer(x, x @ t[k + 1 :])
                t[:, k + 1 :] -= 2 * np.outer(t[:, k + 1 :] @ x, x)
        self.main, self.off = np.diag(t).tolist(), (np.diag(t, 1) ** 2).tolist()
        self.norm = float(np.abs(a).sum(axis=1).max()) or 1.0

    def below(self, shift: float) -> int:
        n, pivot = 0, 1.0
        for a, b in zip(self.main, [0.0, *self.off], strict=True):
            pivot = a - shift - b / pivot
            if abs(pivot) < 1e-300:
                pivot = -1e-300
            n += pivot < 0
        return n

    def border(self, lo: float, hi: float) -> float | None:
        """A number between, near the middle, that keeps its distance from every eigenvalue; None if there is none."""
        for share in (0.5, 0.45, 0.55, 0.4, 0.6, 0.35, 0.65, 0.3, 0.7):
            at, room = lo + share * (hi - lo), BORDER * self.norm
            if self.below(at - room) == self.below(at + room):
                return at
        return None

    def intervals(self, most: int) -> list[tuple[float, float, int]]:
        """(lo, hi, eigenvalues inside) that cover the ``most`` largest eigenvalues, and few others."""
        d, lo, hi = len(self.main), -1.01 * self.norm, 1.01 * self.norm
        bottom, top = lo, hi
        while d - self.below(bottom) > most and (at := self.border(bottom, top)) is not None and top - bottom > BORDER * self.norm:
            bottom, top = (at, top) if d - self.below(at) >= most else (bottom, at)
        todo, out = [(bottom, hi)], []
        while todo:
            lo, hi = todo.pop()
            n = self.below(hi) - self.below(lo)
            at = self.border(lo, hi) if n > IN_INTERVAL and hi - lo > BORDER * self.norm else None
            if at is not None:
                todo += [(lo, at), (at, hi)]
            elif n:
                out.append((lo, hi, n))
        return out


def eigenpairs(a, lo: float, hi: float, n: int):
    """The n eigenvalues of the symmetric matrix within (lo, hi), and their unit eigenvectors as rows."""
    import numpy as np

    d, scale = len(a), np.abs(a).sum(axis=1).max()
    x, w = np.polynomial.legendre.leggauss(NODES)
    turns = np.exp(0.5j * np.pi * (1 - x))  # the upper half of the circle; the lower half gives the conjugates
    centre, radius, eye = (lo + hi) / 2, (hi - lo) / 2, np.eye(d)
    block = np.random.default_rng(13).standard_normal((d, min(d, 2 * n + 4)))
    best = None
    for _ in range(ROUNDS):
        filtered = sum(np.real(wi * radius * z * np.linalg.solve((centre + radius * z) * eye - a, block)) for wi, z in zip(w, turns, strict=True))
        q, _ = np.linalg.qr(filtered / (np.linalg.norm(filtered, axis=0) + 1e-300))
        values, mix = np.linalg.eigh(q.T @ a @ q)
        block = q @ mix
        residual = np.linalg.norm(a @ block - block * values, axis=0) / scale
        inside = np.flatnonzero((values > lo) & (values < hi))
        inside = np.sort(inside[np.argsort(residual[inside], kind="stable")[:n]])
        worst = residual[inside].max() if len(inside) == n else np.inf
        if best is not None and worst >= best[0] / 2 and best[0] < 1e-12:
            break
        if best is None or worst < best[0]:
            best = worst, values[inside], block[:, inside].T
        if worst < 1e-15:
            break
    if best is None or not best[0] < 1e-11:
        raise ArithmeticError(f"{n} eigenvalues counted between {lo} and {hi}, not all found")
    return best[1], best[2]


@dataclass
class Whitening:
    """n fitted rows, exact sums by dimension, components (unit rows), eigenvalues (falling) and the covariance's trace."""

    n: int
    sums: list[int]
    components: list[list[float]]
    eigenvalues: list[float]
    trace: float


def fit(rows: DataFrame, most: int = 32, vector: str = "embedding") -> Whitening:
    """Fit on all rows (see ``usable``), at most ``most`` components; fewer if the vectors span less.

    An empty table, or equal vectors only, give no component.
    """
    import numpy as np

    n, sums = summed(rows, vector, integers, "long")
    if not n:
        return Whitening(0, [], [], [], 0.0)
    total = np.array(sums, np.int64)
    v = covariance(rows, vector, lambda m: (n * integers(m) - total) / n, n)
    trace, parts = float(np.trace(v)), Inertia(v).intervals(most) if np.any(v) else []
    pairs = []
    if parts:
        spark = rows.sparkSession
        matrix_ = spark.sparkContext.broadcast(v)

        def solve(batches):
            import pyarrow as pa

            for b in batches:
                for lo, hi, count in zip(*(c.to_pylist() for c in b.columns), strict=True):
                    values, vectors = eigenpairs(matrix_.value, lo, hi, count)
                    yield pa.RecordBatch.from_pydict({"value": values.tolist(), "vector": vectors.tolist()})

        cut = spark.createDataFrame(parts, "lo double, hi double, n int").repartition(len(parts))
        pairs = sorted(in_arrow(cut, solve, "value double, vector array<double>").collect(), key=lambda r: -r["value"])
        if len(pairs) != sum(p[2] for p in parts):
            raise ArithmeticError("components are missing")
        pairs = [r for r in pairs[:most] if r["value"] > RANK_TOLERANCE * pairs[0]["value"]]
    return Whitening(n, sums, [list(r["vector"]) for r in pairs], [r["value"] for r in pairs], trace)


def whiten(rows: DataFrame, model: Whitening, keep: list[str], vector: str = "embedding") -> DataFrame:
    """``keep`` columns with deviation (decimal: the sum over dimensions of (n x - S)^2, exact) and whitened (array of doubles)."""
    import numpy as np

    n, total = model.n, np.array(model.sums, np.int64)
    axes = (np.array(model.components) / np.sqrt(np.array(model.eigenvalues))[:, None]).T if model.components else np.zeros((len(total), 0))

    def project(batches):
        import decimal

        import pyarrow as pa

        exact = decimal.Context(prec=38)
        for b in batches:
            apart = n * integers(matrix(b.column(len(keep)))) - total
            if b.num_rows and float(np.abs(apart).max()) ** 2 * apart.shape[1] < 2**62:
                deviation = (apart * apart).sum(axis=1).tolist()
            else:
                deviation = [sum(v * v for v in row) for row in apart.tolist()]
            columns = [pa.array([exact.create_decimal(v) for v in deviation], pa.decimal128(38, 0)), pa.array(((apart / n) @ axes).tolist() if b.num_rows else [], pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays([*b.columns[: len(keep)], *columns], names=[*keep, "deviation", "whitened"])

    kinds = dict(rows.dtypes)
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in keep) + ", deviation decimal(38,0), whitened array<double>"
    return in_arrow(rows.select(*keep, F.col(vector).cast("array<double>")), project, schema)


def identity_error(whitened: DataFrame, vector: str = "whitened") -> float | None:
    """The largest absolute entry of the covariance of whitened vectors less the identity; None without vectors or components."""
    import numpy as np

    n, sums = summed(whitened, vector, lambda m: m, "double")
    if not n:
        return None
    mean = np.array(sums) / n
    c = covariance(whitened, vector, lambda m: m - mean, n)
    return float(np.abs(c - np.eye(len(c))).max())


def whitened_components(rows: DataFrame, most: int = 32, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """One row for each usable row and component: key, component (from 1), n, deviation, whitened, explained, identity_error.

    Nulls in ``key`` and repeated rows are kept. Tables without usable rows or without spread give no rows.
    """
    rows = usable(rows.select(key, vector), vector)
    model = fit(rows, most, vector)
    if not model.components:
        return whiten(rows.limit(0), Whitening(1, [], [], [], 1.0), [key], vector).select(
            key, F.lit(1).alias("component"), F.lit(0).cast("long").alias("n"), "deviation", F.lit(0.0).alias("whitened"), F.lit(0.0).alias("explained"), F.lit(0.0).alias("identity_error")
        )
    done = staged(whiten(rows, model, [key], vector), "whitened")
    error = identity_error(done)
    shares = F.array(*[F.lit(e / model.trace) for e in model.eigenvalues])
    each = done.select(key, "deviation", F.posexplode("whitened").alias("_i", "whitened"))
    return each.select(key, (F.col("_i") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened", shares[F.col("_i")].alias("explained"), F.lit(error).alias("identity_error"))
