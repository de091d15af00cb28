"""Document fingerprints by SpotSigs.

A spot signature is a common word (the anchor) with the chain of the content words that follow it. Running prose has many
anchors, lists and boilerplate have few, so the set of a text's spot signatures describes its prose. A fingerprint is that
set: its hashes, sorted, as one string. Sets are compared by Jaccard similarity, pruned by their sizes: two sets whose sizes
differ too much can't reach a threshold, so a search looks only into neighbouring partitions of set size.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subsidia.llm.common import in_arrow, staged

# Common words of English, German, French and Spanish.
ANCHORS = """
a an and are as at be by for from has have he in is it its not of on or that the this to was were which with you
aber als am an auch auf aus bei das dass dem den der des die ein eine einem einen einer es für ich im ist mit nach nicht
sich sie sind so um und von war werden wie wird zu zum zur
au aux avec ce ces cette dans de des du elle en est et il la le les leur mais ne nous ou par pas plus pour qui que sa ses
son sont sur un une vous
al como con del el ella en es esta este la las lo los más no o para pero por que se ser sin su sus un una y ya
""".split()

#: Content words of a chain and the step between them.
CHAIN, STEP = 2, 1
_MARKS = ".,;:!?\"'()[]{}«»“”„‘’…|*#$%&"


class _Words(dict):
    """Word -> 63 bits of hash and, as the lowest bit, whether it is an anchor. Case and outer marks don't count."""

    def __missing__(self, word):
        import xxhash

        bare = word.lower().strip(_MARKS)
        out = self[word] = (xxhash.xxh3_64_intdigest(bare) & ~1) | (bare in _anchors)
        return out


_anchors = frozenset(ANCHORS)
_words = _Words()


def spots(text: str | None, chain: int = CHAIN, step: int = STEP):
    """The sorted distinct spot signatures of a text, 32 bits each.

    A chain that runs past the end is shorter. A text without anchors, or without content words, is described by its pairs of
    neighbouring words, so only a text without words has an empty set.
    """
    import numpy as np

    if len(_words) > 200_000:
        _words.clear()
    words = (text or "").split()
    if not words:
        return np.empty(0, np.uint32)
    codes = np.fromiter(map(_words.__getitem__, words), np.uint64, len(words))
    anchor = (codes & np.uint64(1)).astype(bool)
    at = np.flatnonzero(anchor)
    content = codes[~anchor]
    if len(at) and len(content):
        first = np.cumsum(~anchor)[at]
        at, first = at[first < len(content)], first[first < len(content)]
    if not len(at) or not len(content):
        at, first, content = np.arange(len(codes)), np.arange(len(codes)), codes
    h = codes[at].copy()
    padded = np.concatenate([content, np.zeros(chain * step + 1, np.uint64)])
    for i in range(chain):
        h *= np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(31)
        h += padded[np.minimum(first + i * step, len(padded) - 1)]
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return np.unique((h >> np.uint64(32)).astype(np.uint32))


def fingerprint(signatures) -> str:
    return signatures.astype(">u4").tobytes().hex()


def likeness(a, b, at_least: float = 0.0) -> float:
    """Jaccard similarity of two sorted sets; 0 where their sizes alone rule out ``at_least``. Two empty sets are alike."""
    import numpy as np

    if not len(a) or not len(b):
        return float(len(a) == len(b))
    if min(len(a), len(b)) < at_least * max(len(a), len(b)):
        return 0.0
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def fingerprinted(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_spots and fingerprint of every whole text; null and empty texts have an empty fingerprint."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            sets = [spots(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array([fingerprint(s) for s in sets], pa.string())], names=["doc_id", "n_spots", "fingerprint"])

    return in_arrow(docs.select(F.col(doc_id).alias("doc_id"), text), run, "doc_id long, n_spots long, fingerprint string")


def similar(docs: DataFrame, threshold: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """(members, links): the class of equal fingerprints of each document, and the pairs of classes from ``threshold`` on.

    members: doc_id, class (a hash of the fingerprint; null without spots). links: a < b (classes), likeness. Copies stay inside their
    class. Classes meet if they share one of their rarest spots (as many as any partner must share one of) in the same or a
    neighbouring partition of set size; sizes and the full sets decide.
    """
    import math

    prints = staged(fingerprinted(docs).withColumn("class", F.when(F.col("n_spots") > 0, F.xxhash64("fingerprint"))), "spot-prints")
    sets = prints.filter("class IS NOT NULL").groupBy("class").agg(F.first("fingerprint").alias("fingerprint"), F.first("n_spots").alias("n"))
    cut = F.transform(F.sequence(F.lit(0), F.col("n") - 1), lambda i: F.substring("fingerprint", (i * 8 + 1).cast("int"), F.lit(8)))
    sets = staged(sets.select("class", "n", cut.alias("spots"), F.floor(F.log(F.col("n")) / -math.log(threshold)).alias("part")), "spot-sets")
    each = sets.select("class", "n", "part", F.explode("spots").alias("spot"))
    ranked = each.join(each.groupBy("spot").agg(F.count("*").alias("rare")), "spot").groupBy("class", "n", "part").agg(F.sort_array(F.collect_list(F.struct("rare", "spot"))).alias("own"))
    needed = (F.col("n") - F.ceil(F.col("n") * threshold) + 1).cast("int")
    prefix = staged(ranked.select("class", "n", "part", F.explode(F.slice("own", F.lit(1), needed)).alias("x")).select("class", "n", "part", "x.spot"), "spot-prefixes")
    other = prefix.select(F.col("class").alias("b"), F.col("n").alias("b_n"), F.explode(F.array(F.col("part"), F.col("part") - 1, F.col("part") + 1)).alias("part"), "spot")
    pairs = prefix.withColumnRenamed("class", "a").join(other, ["spot", "part"]).filter((F.col("a") < F.col("b")) & (F.least("n", "b_n") >= F.greatest("n", "b_n") * threshold)).select("a", "b").distinct()
    left, right = sets.select(F.col("class").alias("a"), F.col("spots").alias("x")), sets.select(F.col("class").alias("b"), F.col("spots").alias("y"))
    both = F.size(F.array_intersect("x", "y"))
    links = pairs.join(left, "a").join(right, "b").withColumn("likeness", both / (F.size("x") + F.size("y") - both)).filter(F.col("likeness") >= threshold)
    return prints.select("doc_id", "class"), links.select("a", "b", "likeness")


#: Stands for a null id in the order of documents: it comes last.
NO_ID = -(2**63)


def with_next(docs: DataFrame, make, schema: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``make(pairs)`` over (doc_id, text, next text), where the next document is the one with the next smaller id.

    After the last comes the first. Equal ids are ordered by text, null ids come last. Documents go once, by ranges of their ids;
    the first document of each range goes to the range before it too. One row a range reaches the driver.
    """
    import numpy as np

    spark = docs.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    key = F.coalesce(F.col(doc_id), F.lit(NO_ID))
    ranges = docs.select(key.alias("key")).repartitionByRange(n, F.desc("key")).groupBy(F.spark_partition_id().alias("part")).agg(F.max("key").alias("top"))
    tops = sorted((r["top"] for r in ranges.collect()), reverse=True)
    if not tops:
        return spark.createDataFrame([], schema)
    sent = spark.sparkContext.broadcast(np.array(tops[::-1], np.int64))

    @F.pandas_udf("int")
    def range_of(keys):
        import pandas as pd

        ascending = sent.value
        return pd.Series((len(ascending) - 1 - np.searchsorted(ascending, keys.to_numpy(), side="left")).astype("int32"))

    last = len(tops) - 1
    rows = docs.select(key.alias("key"), F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")).withColumn("range", range_of("key"))
    first = F.col("key").isin(tops) if len(tops) <= 1000 else F.col("key").isin([])
    if len(tops) > 1000:
        firsts = F.broadcast(spark.createDataFrame([(t, True) for t in tops], "key long, top boolean"))
        rows, first = rows.join(firsts, "key", "left"), F.coalesce("top", F.lit(False))
    before = F.when(F.col("range") == 0, F.lit(last)).otherwise(F.col("range") - 1)
    places = F.when(first, F.array(F.struct(F.col("range"), F.lit(0).alias("after")), F.struct(before.alias("range"), F.lit(1).alias("after")))).otherwise(F.array(F.struct(F.col("range"), F.lit(0).alias("after"))))
    dealt = rows.withColumn("place", F.explode(places)).select("place.range", "place.after", "key", "doc_id", "text")
    dealt = dealt.repartitionById(len(tops), "range").sortWithinPartitions("after", F.desc("key"), "text").select("after", "doc_id", "text")

    def run(batches):
        def pairs():
            waiting = None
            for batch in batches:
                for after, d, t in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    if waiting is not None:
                        yield (*waiting, t)
                    if after:
                        waiting = None
                        break
                    waiting = (d, t)
                else:
                    continue
                break
            for _ in batches:  # the rest are repeated first documents
                pass

        yield from make(pairs())

    return in_arrow(dealt, run, schema)


def edited_prints(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text, of its edited text and their likeness to each other and to the next document's.

    The edited text ends, in place of its last third (rounded down), with as many code points from the start of the next document.
    Null texts are empty; texts without words have an empty fingerprint, alike only to another such. Rows that share an id are
    ordered by text, null ids come last; repeated rows have repeated results. A single document is its own next one. An empty table
    gives an empty table; other columns are ignored. Likenesses are exact: two given sets are compared, so no size is ruled out.
    """

    def make(pairs):
        import pyarrow as pa

        names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
        rows, held = [], (None, None)
        for d, t, u in pairs:
            k = len(t) // 3
            edited = t[: len(t) - k] + u[:k]
            own = held[1] if held[0] == t else spots(t)
            held = (u, spots(u))
            other = spots(edited)
            rows.append((d, len(t), hashlib.sha256(edited.encode()).hexdigest(), fingerprint(own), fingerprint(other), likeness(own, other), likeness(own, held[1])))
            if len(rows) == 1000:
                yield pa.RecordBatch.from_arrays([pa.array(c, x) for c, x in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)
                rows = []
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, x) for c, x in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    return with_next(docs, make, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
