"""Quality by compression: which of two dictionaries fits a text better.

Two zstandard dictionaries are built, one from texts labelled good and one from texts labelled bad. A text is cut into
pieces (a dictionary helps most at a piece's beginning) and every piece of the whole text is compressed with both and with
none. The difference of the sizes over the text's length, together with the plain ratio, goes through a logistic fit on
other labelled texts, which makes it a calibrated probability of the label 1.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from subsidia.llm.common import in_arrow, in_slices

#: Bounds of what is fitted on: labelled rows of each class, and pieces of each class in a dictionary.
SAMPLE_ROWS = 10_000
SAMPLE_PIECES = 4_096
PIECE = 2_048
DICTIONARY = 262_144
LEVEL = 3


@dataclass(frozen=True)
class Model:
    good: bytes
    bad: bytes
    weights: tuple[float, ...]  # of the two features, then the constant
    mean: tuple[float, ...]
    spread: tuple[float, ...]


class Sizes:
    """Compressed sizes of a text with either dictionary and with none."""

    def __init__(self, good: bytes, bad: bytes):
        import zstandard as zs

        options = {"level": LEVEL, "write_content_size": False, "write_checksum": False, "write_dict_id": False}
        self.compress = []
        for data in (good, bad, b""):
            dictionary = zs.ZstdCompressionDict(data) if data else None
            if dictionary:
                dictionary.precompute_compress(level=LEVEL)
            self.compress.append(zs.ZstdCompressor(dict_data=dictionary, **options).compress if dictionary else zs.ZstdCompressor(**options).compress)
        self.empty = [len(c(b"")) for c in self.compress]

    def features(self, text: str) -> tuple[float, float]:
        """(bad minus good size, plain size), each over the length; 0 and 0 for an empty text."""
        data = text.encode()
        sums = [0, 0, 0]
        for i in range(0, len(data), PIECE):
            for k, c in enumerate(self.compress):
                sums[k] += len(c(data[i : i + PIECE])) - self.empty[k]
        n = len(data) + 32
        return (sums[1] - sums[0]) / n, sums[2] / n


def dictionary(pieces: list[bytes], size: int = DICTIONARY) -> bytes:
    """A trained dictionary, or the pieces themselves where they are too few to train on."""
    import zstandard as zs

    try:
        return zs.train_dictionary(size, pieces).as_bytes()
    except (zs.ZstdError, ValueError):
        return b"".join(pieces)[-size:] or b"\0" * 8


def featured(docs: DataFrame, keep: list[str], good: bytes, bad: bytes, text: str = "text") -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast((good, bad))

    def run(batches):
        import pyarrow as pa

        sizes = Sizes(*sent.value)
        for batch in in_slices(batches):
            f = [sizes.features(t or "") for t in batch.column(len(keep)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array([x for x, _ in f], pa.float64()), pa.array([x for _, x in f], pa.float64())], names=[*keep, "gain", "ratio"])

    schema = T.StructType([docs.schema[c] for c in keep] + [T.StructField(c, T.DoubleType()) for c in ("gain", "ratio")])
    return in_arrow(docs.select(*keep, text), run, schema)


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", rows: int = SAMPLE_ROWS, pieces: int = SAMPLE_PIECES) -> Model | None:
    """Learn from the labelled documents; None where a class has no labelled text.

    ``rows`` labelled ids of each class (by hash order, a documented bound) are looked up in the documents by a broadcast of
    at most ``2 * rows`` ids. One half of them gives the pieces of the dictionaries, the other half the calibration, weighted
    so that the classes keep their true shares. Null labels and ids, and ids with both labels, teach nothing.
    """
    import numpy as np

    known = labels.filter(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1)).groupBy("doc_id").agg(F.min(label).alias("y"), F.max(label).alias("z")).filter("y = z").select("doc_id", "y", F.xxhash64(F.lit("quality"), "doc_id").alias("h"))
    shares = dict(known.groupBy("y").count().collect())
    if len(shares) < 2:
        return None
    sample = known.filter("y = 0").orderBy("h").limit(rows).unionByName(known.filter("y = 1").orderBy("h").limit(rows))
    found = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(sample), "doc_id")
    for_words, for_odds = found.filter("h % 2 = 0"), found.filter("h % 2 != 0")
    cut = for_words.select("y", "h", F.explode(F.transform(F.sequence(F.lit(0), F.floor(F.length("text") / PIECE)), lambda i: F.substring("text", (i * PIECE + 1).cast("int"), F.lit(PIECE)))).alias("piece")).filter("piece <> ''")
    order = F.xxhash64(F.lit("piece"), "h", "piece")
    own = {y: [r[0].encode() for r in cut.filter(F.col("y") == y).orderBy(order, "piece").select("piece").limit(pieces).collect()] for y in (0, 1)}
    if not own[0] or not own[1]:
        return None
    good, bad = dictionary(own[1]), dictionary(own[0])
    got = featured(for_odds, ["y"], good, bad).toPandas()  # three numbers a sampled row
    if got["y"].nunique() < 2:
        return None
    got = got.sort_values(["y", "gain", "ratio"])
    x, y = got[["gain", "ratio"]].to_numpy(), got["y"].to_numpy().astype(float)
    weight = np.where(y == 1, shares[1] / max(1, (y == 1).sum()), shares[0] / max(1, (y == 0).sum()))
    weight = weight * len(y) / weight.sum()
    mean, spread = x.mean(0), x.std(0) + 1e-9
    z = np.c_[(x - mean) / spread, np.ones(len(x))]
    w, ridge = np.zeros(3), np.diag([0.05, 0.05, 1e-4])
    for _ in range(50):  # Newton's steps
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (weight * p * (1 - p))[:, None]).T @ z + ridge, z.T @ (weight * (y - p)) - ridge @ w)
        w = w + np.clip(step, -2, 2)
    return Model(good, bad, tuple(w), tuple(mean), tuple(spread))


def score(docs: DataFrame, model: Model | None, keep: list[str] | None = None, text: str = "text", unknown: float = 1.0) -> DataFrame:
    """``keep`` columns (default: doc_id) and score, one row a row of ``docs``; every row gets ``unknown`` without a model.

    Null and empty texts get the score that their features (0, 0) have. Very long texts are compressed whole, piece by piece.
    """
    keep = keep or ["doc_id"]
    if model is None:
        return docs.select(*keep, F.lit(float(unknown)).alias("score"))
    sized = featured(docs, keep, model.good, model.bad, text)
    terms = [F.lit(w) * (F.col(c) - F.lit(m)) / F.lit(s) for c, w, m, s in zip(("gain", "ratio"), model.weights, model.mean, model.spread, strict=False)]
    return sized.select(*keep, (1 / (1 + F.exp(-(terms[0] + terms[1] + F.lit(model.weights[2]))))).alias("score"))


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows that nothing is learnt from: crc32 of the id as text is divisible by 5."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit_held_in(docs: DataFrame, labels: DataFrame) -> Model | None:
    return fit(docs, labels.filter(~held_out()))


def keep_good(docs: DataFrame, model: Model | None, threshold: float = 0.3) -> DataFrame:
    """The documents, all columns, whose score reaches ``threshold``; all of them without a model.

    Null and empty texts are judged by the score of their features; repeated rows are judged alike and stay repeated.
    """
    if model is None:
        return docs
    sent, at = docs.sparkSession.sparkContext.broadcast(model), docs.columns.index("text")

    def run(batches):
        import numpy as np
        import pyarrow as pa

        m = sent.value
        sizes = Sizes(m.good, m.bad)
        for batch in in_slices(batches):
            f = np.array([sizes.features(t or "") for t in batch.column(at).to_pylist()], float).reshape(-1, 2)
            odds = (f - m.mean) / m.spread @ np.array(m.weights[:2]) + m.weights[2]
            yield batch.filter(pa.array(1 / (1 + np.exp(-odds)) >= threshold))

    return in_arrow(docs, run, docs.schema)
