"""Near-duplicate documents by b-bit MinHash.

1. Every text becomes a set of word shingles (64-bit hashes). Equal sets form a class, told by two 64-bit hashes of the set: the
   first is its number, and should two sets share it, the second shows it and all numbers are made anew from another seed. Only
   classes go on, so a group of copies counts once.
2. A class has ``BANDS * ROWS`` MinHash values. Bands of them give candidate buckets; only the low 2 bits of each value are
   kept, packed into 64-bit words, and the similarity of a candidate pair is estimated from the equal 2-bit lanes, corrected
   for lanes that agree by chance (one in four).
3. Pairs whose estimate is not far below the threshold are confirmed on the full sets.
4. Confirmed links are joined to components.

No large bucket is expanded into all its pairs. Each bucket first offers its smallest member as a hub, and every class tries
two of the hubs offered to it, the smallest and the most similar one, which joins a large group of near copies. What is still
apart afterwards is compared pair by pair in small buckets. In large ones the shingles are counted that only one of the open members
of a family has, a family being all that large buckets connect: whatever two classes share is held by both, so a class of which
more than a fifth is its own is linked with none of them and goes. The member with the fewest of them lies in the middle, so it is
the second hub. Then pairs are compared that are still apart and that the counts don't rule out. So no link between components is
lost: two members of a bucket are in one component already, or compared, or too far apart. There a class carries what
distinguishes its set from the middle's; two such differences give the exact similarity of their sets, so the comparison of members
yields nothing but links. A family whose members meet in many buckets is compared as one bucket, so that each pair is looked at
once. Members of one bucket are dealt over many tasks.

A pair at the threshold of 0.8 shares no bucket with a probability of (1 - 0.8 ** 5) ** 51 = 1.6e-9.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from subsidia.llm.common import in_arrow, in_slices, staged

BANDS, ROWS = 51, 5
#: Longs of a packed signature: 2 bits a value, 32 values a long.
LONGS = 8
LANES = 0x5555555555555555
#: How far an estimate may lie below the threshold: over six standard deviations of 255 values.
SLACK = 0.2
#: Ids of texts to fetch are broadcast up to this number (16 MB at 64 bytes each), else joined.
BROADCAST_IDS = 250_000
#: Members of a bucket from which on it is large, and so many of them meet in a task.
LARGE, SHARE = 24, 256
#: Stands for a null id in joins.
NO_ID = -(2**63)
LAST_ID = 2**63 - 1


class _WordHashes(dict):
    def __missing__(self, word):
        import xxhash

        out = self[word] = xxhash.xxh3_64_intdigest(word)
        return out


_hashes = _WordHashes()


def shingles(text: str | None, n: int):
    """The sorted distinct shingles of ``n`` words of a text as 64-bit hashes; fewer words make one shingle, none makes none."""
    import numpy as np

    if len(_hashes) > 200_000:
        _hashes.clear()
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and the ASCII spaces only
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words))
    n = min(n, len(h))
    out = h[: len(h) - n + 1].copy()
    for i in range(1, n):
        out *= np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
        out += h[i : len(h) - n + 1 + i]
    out *= np.uint64(0xBF58476D1CE4E5B9)
    out ^= out >> np.uint64(32)
    return np.unique(out)


def _constants():
    import numpy as np

    rng = np.random.default_rng(20_240_229)
    k = BANDS * ROWS
    return rng.integers(0, 2**32, k, dtype=np.uint32) | np.uint32(1), rng.integers(0, 2**32, k, dtype=np.uint32), rng.integers(0, 2**32, k, dtype=np.uint32) | np.uint32(1)


def minima(hashes, constants):
    """The least value of each hash function over a set, a block of shingles at a time."""
    import numpy as np

    a, b, _ = constants
    low = np.full(len(a), 0xFFFFFFFF, np.uint32)
    x = (hashes ^ (hashes >> np.uint64(32))).astype(np.uint32)
    for i in range(0, len(x), 1024):
        block = x[i : i + 1024, None] * a[None, :]
        block += b[None, :]
        block ^= block >> np.uint32(15)
        block *= np.uint32(0x2C1B3C6D)
        np.minimum(low, block.min(axis=0), out=low)
    return low


def set_hash(hashes, seed: int = 0) -> int:
    """A 64-bit number of a set of shingles, signed."""
    import xxhash

    x = xxhash.xxh3_64_intdigest(hashes.tobytes(), seed)
    return x - 2**64 if x >= 2**63 else x


def signatures(docs: DataFrame, n: int, seed: int = 0) -> DataFrame:
    """Of (doc_id, text): doc_id, n, id (the set's number, null for an empty set), twin (another such number), bands (one hash
    each), sig (packed low bits)."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        constants = _constants()
        seeds = np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)
        shifts = np.arange(0, 64, 2, dtype=np.uint64)
        for batch in in_slices(batches):
            sizes, ids, twins, bands, sigs = [], [], [], [], []
            for t in batch.column(1).to_pylist():
                s = shingles(t, n)
                low = minima(s, constants).astype(np.uint64)
                key = seeds.copy()
                for row in low.reshape(BANDS, ROWS).T:
                    key = (key ^ row) * np.uint64(0xFF51AFD7ED558CCD)
                    key ^= key >> np.uint64(33)
                lanes = np.zeros(LONGS * 32, np.uint64)
                lanes[: len(low)] = low & np.uint64(3)
                sizes.append(len(s))
                ids.append(set_hash(s, 2 * seed) if len(s) else None)
                twins.append(set_hash(s, 2 * seed + 1) if len(s) else None)
                bands.append(key.view(np.int64))
                sigs.append(np.bitwise_or.reduce(lanes.reshape(LONGS, 32) << shifts, axis=1).view(np.int64))
            rows = batch.num_rows
            flat = lambda x, k: pa.ListArray.from_arrays(pa.array(np.arange(rows + 1) * k, pa.int32()), pa.array(np.concatenate(x) if rows else [], pa.int64()))  # noqa: B023, E731
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(ids, pa.int64()), pa.array(twins, pa.int64()), flat(bands, BANDS), flat(sigs, LONGS)], names=["doc_id", "n", "id", "twin", "bands", "sig"])

    return in_arrow(docs, run, "doc_id long, n long, id long, twin long, bands array<long>, sig array<long>")


def classes_of(docs: DataFrame, n: int) -> tuple[DataFrame, DataFrame, int]:
    """The signatures, the classes of equal sets (id, doc_id, copies), and the seed of their numbers."""
    seed = 0
    while True:
        sets = staged(signatures(docs, n, seed), "near-signatures")
        own = sets.filter("id IS NOT NULL").groupBy("id").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("copies"), F.min("twin").alias("lo"), F.max("twin").alias("hi"))
        classes = staged(own, "near-classes")
        if classes.filter("lo <> hi").isEmpty():
            return sets, classes.select("id", "doc_id", "copies"), seed
        seed += 1


def estimate(a: str = "a_sig", b: str = "b_sig"):
    """Similarity estimated from two packed signatures: equal lanes, less those that agree by chance."""
    x = [F.expr(f"{a}[{i}] ^ {b}[{i}]") for i in range(LONGS)]
    unequal = sum((F.bit_count((v.bitwiseOR(F.shiftrightunsigned(v, 1))).bitwiseAND(F.lit(LANES))) for v in x), F.lit(0))
    equal = 1 - unequal / F.lit(float(BANDS * ROWS))
    return (equal - 0.25) / 0.75


def fetched(ids: DataFrame, docs: DataFrame, heads: DataFrame, n: int, seed: int) -> DataFrame:
    """(id, text) of the classes ``ids`` (id, distinct), from one document of each; ``heads`` has its doc_id."""
    wanted = staged(ids.join(heads, "id").select("id", "doc_id"), "near-wanted")
    own = wanted.select("doc_id").distinct()
    own = F.broadcast(own) if wanted.count() <= BROADCAST_IDS else own
    texts = in_arrow(docs.join(own, "doc_id", "left_semi"), _named(n, seed), "id long, text string")
    return staged(texts.dropDuplicates(["id"]), "near-texts")


def with_text(rows: DataFrame, key: str, by: str, texts: DataFrame, name: str) -> DataFrame:
    """``rows`` with the text of the class ``key`` as ``name``; ``rows`` is a written table.

    A class that more than ``SHARE`` rows ask for is asked for in several shares, told apart by a hash of ``by``, so that its
    rows don't meet in one task. Its text goes to each share.
    """
    hot = rows.groupBy(F.col(key).alias("_hot")).agg(F.ceil(F.count("*") / SHARE).alias("_shares")).filter("_shares > 1")
    hot = staged(hot, "near-hot")  # at most a row for each SHARE rows
    few = hot.count()
    hint = F.broadcast if few <= BROADCAST_IDS else (lambda x: x)
    own = texts.select(F.col("id").alias(key), F.col("text").alias(name))
    if not few:
        return rows.join(own, key)
    dealt = rows.join(hint(hot), F.col(key) == F.col("_hot"), "left").withColumn("_share", F.coalesce(F.pmod(F.xxhash64(by), "_shares"), F.lit(0).cast("long"))).drop("_hot", "_shares")
    copies = own.join(hint(hot), F.col(key) == F.col("_hot"), "left").select(key, name, F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("_shares", F.lit(1).cast("long")) - 1)).alias("_share"))
    return dealt.join(copies, [key, "_share"]).drop("_share")


def confirmed(pairs: DataFrame, texts: DataFrame, n: int, percent: int) -> DataFrame:
    """The pairs (a, b) of classes whose full sets meet the threshold: 100 * intersection >= percent * union.

    A pair travels to its first text, then to its second; texts are smaller than their sets. ``pairs`` is a written table.
    """
    first = with_text(pairs, "a", "b", texts, "ta")
    both = first.join(texts.select(F.col("id").alias("b"), F.col("text").alias("tb")), "b")  # a hub is the smaller one of a pair, so none is b often

    def check(batches):
        import numpy as np
        import pyarrow as pa

        last = (None, None)
        for batch in in_slices(batches):
            keep = []
            for b, x, y in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3)), strict=True):  # in the order of b
                if last[0] != b:
                    last = (b, shingles(y, n))
                x, y = shingles(x, n), last[1]
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return in_arrow(both.select("a", "b", "ta", "tb"), check, "a long, b long")


def own_shingles(members: DataFrame, families: DataFrame, texts: DataFrame, n: int) -> DataFrame:
    """(id, family, part, n, own): how many shingles of a class no other open class of its family has.

    ``members``: key, id and comp in crowded buckets; ``families``: id, family, the members that these buckets connect. ``part`` tells
    apart the groups of copies in a family: a bucket belongs to the component with most members in it, and a class to the
    smallest of its buckets' components.
    """
    sizes = staged(members.groupBy("key", "comp").agg(F.count("*").alias("c")), "near-sizes")
    main = staged(sizes.groupBy("key").agg(F.max("c").alias("c")), "near-sizes")
    main = staged(sizes.join(main, ["key", "c"]).groupBy("key").agg(F.max("comp").alias("main")), "near-mains")
    part = staged(members.join(main, "key").groupBy("id").agg(F.min("main").alias("part")).join(families, "id"), "near-parts")

    def listed(batches):
        import numpy as np
        import pyarrow as pa

        for batch in in_slices(batches):
            sets = [shingles(t, n).view(np.int64) for t in batch.column(1).to_pylist()]
            ends = np.cumsum([0, *map(len, sets)])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(sets) if sets else [], pa.int64()))], names=["id", "shingles"])

    each = in_arrow(texts.join(part, "id", "left_semi"), listed, "id long, shingles array<long>").join(part, "id").select("family", "id", F.explode("shingles").alias("shingle"))
    once = each.groupBy("family", "shingle").agg(F.count("*").alias("n"), F.min("id").alias("id")).filter("n = 1")
    lone = once.groupBy("id").agg(F.count("*").alias("own"))
    sizes = each.groupBy("id").agg(F.count("*").alias("n"))
    return staged(part.join(sizes, "id").join(lone, "id", "left").select("id", "family", "part", "n", F.coalesce("own", F.lit(0)).alias("own")), "near-own")


def differences(own: DataFrame, texts: DataFrame, n: int) -> DataFrame:
    """(id, family, part, own, delta): the shingles that a class has and the middle of its part has not, or the other way round.

    The middle is the member with the smallest share of own shingles. A class that differs from it in more than half of its
    shingles has no delta.
    """
    middle = staged(own.groupBy("part").agg(F.min_by("id", F.struct(F.col("own") / F.col("n"), "id")).alias("centre")), "near-centres")
    hint = F.broadcast if middle.count() <= BROADCAST_IDS else (lambda x: x)  # a part may hold most rows
    both = with_text(staged(own.join(hint(middle), "part"), "near-parts"), "centre", "id", texts, "middle").join(texts, "id")

    def run(batches):
        import numpy as np
        import pyarrow as pa

        last = (None, None)
        for batch in in_slices(batches):
            out = []
            for t, m in zip(batch.column(4).to_pylist(), batch.column(5).to_pylist(), strict=True):
                if last[0] != m:
                    last = (m, shingles(m, n))
                own = shingles(t, n)
                delta = np.setxor1d(own, last[1], assume_unique=True)
                out.append(delta.view(np.int64) if 2 * len(delta) <= len(own) else None)
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(out, pa.list_(pa.int64()))], names=["id", "family", "part", "own", "delta"])

    return staged(in_arrow(both.select("id", "family", "part", "own", "text", "middle"), run, "id long, family long, part long, own long, delta array<long>"), "near-differences")


def _named(n, seed):
    def run(batches):
        import pyarrow as pa

        for batch in in_slices(batches):
            sets = [shingles(t, n) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([set_hash(s, 2 * seed) if len(s) else None for s in sets], pa.int64()), batch.column(1)], names=["id", "text"])

    return run


def components(edges: DataFrame) -> DataFrame:
    """(id, comp): the smallest id that each node of the links (a, b) reaches.

    Large-star and small-star steps in turn until nothing changes; each step is a grouping by node with partial minima and a
    join, and its links are written to the shared folder.
    """
    print_of, links = _written(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct(), "links")
    while True:
        both = links.select("u", "v").union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select("u", "v", "m", F.explode(F.when(F.col("v") == F.col("m"), F.array("u")).otherwise(F.array("u", "v"))).alias("x"))
        before = print_of
        print_of, small = _written(small.select(F.col("x").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct(), "links")
        if print_of == before:
            # Stable: every node but the smallest points at the smallest.
            return links.select(F.col("u").alias("id"), F.col("v").alias("comp")).union(links.select("v", "v").distinct())
        links = small


def _written(links: DataFrame, what: str) -> tuple[tuple, DataFrame]:
    """The links, staged, with their number and the sum of their hashes, both observed while they are written."""
    seen = Observation()
    links = staged(links.observe(seen, F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")), what)
    return (seen.get["n"], seen.get["h"]), links


def near_duplicates(docs: DataFrame, n: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row a document: doc_id, n_shingles, component_id (smallest id reachable), kept (the document is that one).

    Texts are lower-cased (A-Z) and cut at ASCII spaces; shingles have ``n`` words, a shorter text is one shingle, a text
    without words (or null) has none and is linked with nothing. Documents are linked from a similarity of ``percent`` / 100.
    Rows that share an id are rows of their own: each has its text's component. A null id is larger than any other; a component
    of null ids has a null component_id and is kept. An empty table gives an empty table.
    """
    docs = docs.select(F.coalesce(doc_id, F.lit(LAST_ID)).alias("doc_id"), F.col(text).alias("text"))
    sets, classes, seed = classes_of(docs, n)
    heads = classes.select("id", "doc_id")
    marks = staged(sets.filter("id IS NOT NULL").select("id", "n", "bands", "sig").dropDuplicates(["id"]), "near-marks")

    banded = marks.select("id", F.explode("bands").alias("key"))
    buckets = banded.groupBy("key").agg(F.count("*").alias("members"), F.min("id").alias("hub")).filter("members > 1").select("key", "hub")
    crowded = staged(banded.join(staged(buckets, "near-buckets"), "key"), "near-members")
    texts = fetched(crowded.select("id").distinct(), docs, heads, n, seed)

    near = percent / 100 - SLACK
    side = lambda c: marks.select(F.col("id").alias(c), F.col("n").alias(f"{c}_n"), F.col("sig").alias(f"{c}_sig"))
    fits = (F.greatest("a_n", "b_n") * percent <= F.least("a_n", "b_n") * 100) & (estimate() >= near)

    def tried(offered: DataFrame, more=F.lit(True)) -> DataFrame:
        """Of the hubs (a) offered to each class (b): the smallest and the most similar one."""
        own = Window.partitionBy("b")
        first, best = F.row_number().over(own.orderBy("a")), F.row_number().over(own.orderBy(F.desc("like"), "a"))
        likely = offered.distinct().join(side("b"), "b").join(side("a"), "a").filter(fits & more).select("a", "b", estimate().alias("like"))
        return likely.withColumn("first", first).withColumn("best", best).filter("first = 1 OR best = 1").select("a", "b")

    def apart(members: DataFrame, comp: DataFrame) -> DataFrame:
        """The members of buckets that more than one component meets in: key, id, comp, members, lo (the smallest component)."""
        named = members.select("key", "id").join(comp, "id", "left").select("key", "id", F.coalesce("comp", "id").alias("comp"))
        keys = named.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count("*").alias("members")).filter("lo <> hi").select("key", "members", "lo")
        return staged(named.join(staged(keys, "near-open"), "key"), "near-apart")

    def crossed(members: DataFrame, more=F.lit(True), extra: tuple = ()) -> DataFrame:
        """The likely pairs of members of a bucket in different components.

        Members of a large bucket are dealt into groups of ``SHARE`` on one side; the other side goes to all groups. That side
        leaves out one component, as a rule the largest: its members are in one component already.
        """
        sized = members.join(side("a").withColumnRenamed("a", "id"), "id").select("key", "id", "comp", "members", "lo", "a_n", "a_sig", *[F.col(c).alias(f"a_{c}") for c in extra])
        sized = staged(sized, "near-sides")
        shares = F.ceil(F.col("members") / SHARE)
        one = sized.withColumnRenamed("id", "a").withColumn("share", F.pmod(F.xxhash64("a"), shares)).drop("members")
        other = sized.filter("comp <> lo").select("key", F.col("id").alias("b"), F.col("comp").alias("b_comp"), F.col("a_n").alias("b_n"), F.col("a_sig").alias("b_sig"), *[F.col(f"a_{c}").alias(f"b_{c}") for c in extra], F.explode(F.sequence(F.lit(0).cast("long"), shares - 1)).alias("share"))
        once = (F.col("a") < F.col("b")) | (F.col("comp") == F.col("lo"))
        both = one.join(other, ["key", "share"]).filter(once & (F.col("comp") != F.col("b_comp")) & more & fits)
        return both.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()

    def gathered(members: DataFrame, own: DataFrame, comp: DataFrame) -> DataFrame:
        """The members of large buckets that are apart, a family as one bucket where that takes fewer comparisons.

        The members of a family that meet in many buckets are compared once then, instead of once a bucket.
        """
        cost = F.sum(F.when(F.col("comp") != F.col("lo"), F.ceil(F.col("members") / SHARE)).otherwise(0))
        family = own.select("id", "family")
        narrow = apart(members, comp)
        wide = apart(members.select("id").distinct().join(family, "id").select(F.col("family").alias("key"), "id"), comp)
        by_bucket = narrow.join(family, "id").groupBy("family").agg(cost.alias("by_bucket"))
        by_family = wide.groupBy(F.col("key").alias("family")).agg(cost.alias("by_family"))
        whole = staged(by_bucket.join(by_family, "family").filter("by_family <= by_bucket").select("family"), "near-whole")
        split = narrow.join(family, "id").join(whole, "family", "left_anti").select(narrow.columns)
        return staged(wide.join(whole.withColumnRenamed("family", "key"), "key", "left_semi").unionByName(split), "near-rest")

    hubs = crowded.filter("id <> hub").select(F.col("hub").alias("a"), F.col("id").alias("b"))
    links = staged(confirmed(staged(tried(hubs), "near-stars"), texts, n, percent), "near-links")
    comp = staged(components(links), "near-components")

    def linked(pairs: DataFrame, comp: DataFrame) -> DataFrame:
        """The components with the pairs that hold joined in; the old ones are stars of links themselves."""
        pairs = staged(pairs, "near-pairs")
        if pairs.isEmpty():
            return comp
        found = staged(confirmed(pairs, texts, n, percent), "near-links")
        if found.isEmpty():
            return comp
        return staged(components(found.union(comp.select(F.col("comp").alias("a"), F.col("id").alias("b")))), "near-components")

    open_ = apart(crowded, comp)
    small, large = open_.filter(F.col("members") < LARGE), open_.filter(F.col("members") >= LARGE)
    pairs = crossed(small)
    crowd = not large.isEmpty()
    if crowd:
        meeting = large.join(staged(large.groupBy("key").agg(F.min("id").alias("a")), "near-firsts"), "key").filter("id <> a")
        families = components(meeting.select("a", F.col("id").alias("b"))).withColumnRenamed("comp", "family")
        own = own_shingles(large, families, texts, n)
        share = F.col("own") / F.col("n")
        large = staged(large.join(own, "id").select(*large.columns, "n", "own"), "near-large")
        best = staged(large.groupBy("key").agg(F.min_by("id", F.struct(share, "id")).alias("a")), "near-middles")
        again = large.join(best, "key").filter("id <> a").select(F.least("a", "id").alias("a"), F.greatest("a", "id").alias("b"))
        pairs = pairs.union(tried(again)).distinct()

    comp = linked(pairs, comp)
    if crowd:
        # What two open classes of a family share is at most what either shares with its family; where both have a delta from
        # one middle, the symmetric difference of their sets is that of their deltas.
        able = (F.col("n") - F.col("own")) * 100 >= F.col("n") * percent
        rest = gathered(large.filter(able), own, comp)
        most = F.least(F.col("a_n") - F.col("a_own"), F.col("b_n") - F.col("b_own"))
        share = most * 100 >= (F.col("a_n") + F.col("b_n") - most) * percent
        apart_by = F.size("a_delta") + F.size("b_delta") - 2 * F.size(F.array_intersect("a_delta", "b_delta"))
        meets = (F.col("a_n") + F.col("b_n") - apart_by) * 100 >= (F.col("a_n") + F.col("b_n") + apart_by) * percent
        exact = (F.col("a_part") != F.col("b_part")) | F.col("a_delta").isNull() | F.col("b_delta").isNull() | meets
        if not rest.isEmpty():
            comp = linked(crossed(rest.join(differences(own, texts, n), "id"), share & exact, ("own", "part", "delta")), comp)

    # The smallest document id of each component, for every class that has more than one document or a link.
    grouped = classes.join(comp, "id", "left").filter("copies > 1 OR comp IS NOT NULL").select("id", F.coalesce("comp", "id").alias("comp"), "doc_id")
    least = grouped.groupBy("comp").agg(F.min("doc_id").alias("component_id"))
    known = staged(grouped.select("id", "comp").join(least, "comp").select("id", "component_id"), "near-known")
    found = sets.select("doc_id", "n", "id").join(known, "id", "left")
    component = F.coalesce("component_id", "doc_id")
    real = lambda c: F.when(c != LAST_ID, c)
    return found.select(real(F.col("doc_id")).alias("doc_id"), F.col("n").alias("n_shingles"), real(component).alias("component_id"), (F.col("doc_id") == component).alias("kept"))


def keep_one(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """The documents, all columns, without those that are near copies of a document with a smaller id.

    Rows that repeat one id and text are reduced to one. Rows that share an id but not the text go only if all of them are
    copies.
    """
    found = staged(near_duplicates(docs, n, percent).withColumn("doc_id", F.coalesce("doc_id", F.lit(NO_ID))), "near-found")
    own = found.groupBy("doc_id").agg(F.count("*").alias("rows"), F.bool_or("kept").alias("kept"))
    own = staged(own.filter("rows > 1 OR NOT kept"), "near-dropped")
    dropped, again = own.filter("NOT kept").select("doc_id"), own.filter("kept").select("doc_id")
    hint = F.broadcast if own.count() <= BROADCAST_IDS else (lambda x: x)
    # Packed, so that no column of the documents can clash with the columns used here.
    packed = docs.select(F.struct(*docs.columns).alias("doc"), F.coalesce("doc_id", F.lit(NO_ID)).alias("doc_id"), F.col("text").alias("text"))
    left = packed.join(hint(dropped), "doc_id", "left_anti")
    if not again.isEmpty():
        again = hint(again)
        repeated = left.join(again, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
        left = left.join(again, "doc_id", "left_anti").unionByName(repeated)
    return left.select("doc.*")
