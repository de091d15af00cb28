"""Mixing sources to target weights by Pareto order sampling, with DataFrame operations only.

Each source gets a target in words. A document's expected number of copies is target / size of its source; its whole part
is handed out to every document, and its fraction p is an inclusion probability. Documents are ranked by their random odds
over their inclusion odds, (u / (1 - u)) / (p / (1 - p)) with u from a hash, and taken in that order until the words that
remain are used up. The draw is of fixed size: it stops at the last document that still fits, and one more document, the one
nearest in size to what is left, closes the gap if that brings the total nearer.

Nothing is sorted whole: ranks are binned, bins are summed before the shuffle, and only the bin in which a source's budget
runs out is ordered. What remains is one row a source, which documents look up.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from subsidia.llm.common import WORD, staged, text_or_empty

#: Ranked documents a bin holds on average.
BIN = 4096
#: A plan of up to so many sources is broadcast (under 4 MB); beyond it the join is shuffled.
BROADCAST_SOURCES = 20_000
#: Bits of the random number.
BITS = 52


def n_words(text: str = "text"):
    """Words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def draw(seed: int, doc_id: str = "doc_id", text: str = "text"):
    """A 52-bit number from the document's id and text; equal rows draw equal numbers."""
    key = F.concat_ws("|", F.lit(str(seed)), F.col(doc_id).cast("string"), F.md5(text_or_empty(text)))
    return F.conv(F.substring(F.md5(key), 1, BITS // 4), 16, 10).cast("long")


def rank(drawn, share):
    """Odds of u over odds of the inclusion probability; null where nothing is to be drawn."""
    u = (drawn + F.lit(0.5)) / F.lit(float(2**BITS))
    return F.when(share > 0, (u / (1 - u)) / (share / (1 - share)))


def source_targets(sized: DataFrame, weights: tuple[float, ...] = (5, 2, 1), cap: float = 3.0) -> DataFrame:
    """One row a source: n_docs, source_size and target, in words.

    Sources in code-point order (null last) weigh ``weights`` in turn. They share all words by weight; a target stops at
    ``cap`` times its source's size and the excess is reshared by weight. Sorted by cap over weight, the capped sources
    come first, so one running sum finds them all.
    """
    own = sized.groupBy("source").agg(F.count("*").alias("n_docs"), F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(order) - 1) % len(weights)
    own = own.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn + 1).cast("int")))
    own = own.withColumn("most", F.col("source_size") * F.lit(float(cap)))
    filled = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").asc_nulls_last())
    everything = Window.partitionBy(F.lit(1))
    before = F.coalesce(F.sum("most").over(filled.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    own = own.withColumn("level", (F.sum("source_size").over(everything) - before) / F.sum("weight").over(filled.rowsBetween(0, Window.unboundedFollowing)))
    # The level rises while sources are capped and falls afterwards, so its top is the one at which the rest shares.
    own = own.withColumn("level", F.max("level").over(everything))
    return own.select("source", "n_docs", "source_size", F.coalesce(F.least("most", F.col("weight") * F.col("level")), F.lit(0.0)).alias("target"))


def plan_mix(sized: DataFrame, weights: tuple[float, ...] = (5, 2, 1), cap: float = 3.0) -> DataFrame:
    """One row a source: source_size, target, whole copies, and what decides the draw (share, last rank, last number, closing number).

    ``sized`` has source, size and drawn, one row a document; rows of one source and number are drawn together.
    """
    targets = source_targets(sized, weights, cap)
    copies = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    targets = targets.withColumn("whole", F.floor(copies).cast("long")).withColumn("share", copies - F.col("whole"))
    targets = staged(targets.withColumn("budget", F.col("target") - F.col("whole") * F.col("source_size")), "mix-targets")
    drawing = targets.filter("share > 0").select(F.col("source").alias("of"), "n_docs", "share", "budget")
    drawing = F.broadcast(drawing) if drawing.count() <= BROADCAST_SOURCES else drawing
    ranked = sized.join(drawing, F.col("source").eqNullSafe(F.col("of")))
    ranked = ranked.withColumn("rank", rank(F.col("drawn"), F.col("share")))
    bins = F.ceil(F.col("n_docs") / BIN)
    ranked = ranked.withColumn("bin", F.floor(F.col("rank") / (1 + F.col("rank")) * bins)).select("of", "bin", "rank", "drawn", "size", "budget")

    summed = ranked.groupBy("of", "bin", "budget").agg(F.sum("size").alias("words"))
    upto = F.sum("words").over(Window.partitionBy("of").orderBy("bin"))
    # The bin in which the budget runs out; the last one if rounding leaves it a little short.
    last = summed.withColumn("upto", upto).groupBy("of", "budget").agg(F.min(F.when(F.col("upto") >= F.col("budget"), F.struct("bin", (F.col("upto") - F.col("words")).alias("before")))).alias("a"), F.max(F.struct("bin", (F.col("upto") - F.col("words")).alias("before"))).alias("b"))
    last = staged(last.select(F.col("of").alias("source"), F.coalesce("a", "b").alias("cut")).select("source", F.col("cut.bin").alias("last_bin"), F.col("cut.before").alias("before")), "mix-bins")
    small = last.count() <= BROADCAST_SOURCES
    inside = ranked.join(F.broadcast(last) if small else last, F.col("of").eqNullSafe(F.col("source")) & (F.col("bin") == F.col("last_bin")))
    inside = inside.groupBy("of", "rank", "drawn", "budget", "before").agg(F.sum("size").alias("size"))
    upto = F.col("before") + F.sum("size").over(Window.partitionBy("of").orderBy("rank", "drawn"))
    inside = inside.withColumn("upto", upto).withColumn("fits", F.col("upto") <= F.col("budget"))
    edge = inside.groupBy("of", "budget", "before").agg(F.max(F.when(F.col("fits"), F.struct("rank", "drawn", "upto"))).alias("edge"))
    edge = staged(edge.select(F.col("of").alias("source"), F.coalesce("edge.rank", F.lit(-1.0)).alias("edge_rank"), F.coalesce("edge.drawn", F.lit(-1)).alias("edge_drawn"), (F.col("budget") - F.coalesce("edge.upto", "before")).alias("gap")).join(last.select(F.col("source").alias("s"), "last_bin"), F.col("source").eqNullSafe(F.col("s"))).drop("s"), "mix-edges")

    # Where the edge's bin holds no fitting document, all bins before it are taken whole.
    taken = F.col("bin") < F.col("last_bin")
    taken = taken | ((F.col("bin") == F.col("last_bin")) & ((F.col("rank") < F.col("edge_rank")) | ((F.col("rank") == F.col("edge_rank")) & (F.col("drawn") <= F.col("edge_drawn")))))
    rest = ranked.join(F.broadcast(edge) if small else edge, F.col("of").eqNullSafe(F.col("source"))).filter(~taken)
    rest = rest.groupBy("of", "rank", "drawn", "gap").agg(F.sum("size").alias("size")).filter(F.abs(F.col("gap") - F.col("size")) < F.abs("gap"))
    closing = rest.groupBy("of").agg(F.min(F.struct(F.abs(F.col("gap") - F.col("size")).alias("off"), "rank", "drawn")).alias("c")).select(F.col("of").alias("c_source"), F.col("c.drawn").alias("closing"))
    plan = targets.join(edge.withColumnRenamed("source", "e_source"), F.col("source").eqNullSafe(F.col("e_source")), "left").join(closing, F.col("source").eqNullSafe(F.col("c_source")), "left")
    return staged(plan.select("source", "n_docs", "source_size", "target", "whole", "share", "last_bin", "edge_rank", "edge_drawn", "closing"), "mix-plan")


def copies(docs: DataFrame, plan: DataFrame) -> DataFrame:
    """``docs`` (with source and drawn) plus source_size, target and copies, by looking up the plan."""
    plan = plan.withColumnRenamed("source", "of")
    plan = F.broadcast(plan) if plan.count() <= BROADCAST_SOURCES else plan
    ranked = docs.join(plan, F.col("source").eqNullSafe(F.col("of"))).withColumn("rank", rank(F.col("drawn"), F.col("share")))
    bin_ = F.floor(F.col("rank") / (1 + F.col("rank")) * F.ceil(F.col("n_docs") / BIN))
    inside = (F.col("rank") < F.col("edge_rank")) | ((F.col("rank") == F.col("edge_rank")) & (F.col("drawn") <= F.col("edge_drawn")))
    taken = (bin_ < F.col("last_bin")) | ((bin_ == F.col("last_bin")) & inside) | (F.col("drawn") == F.col("closing"))
    drawn = F.when(F.coalesce(taken, F.lit(False)), 1).otherwise(0)
    return ranked.select(*docs.columns, "source_size", "target", (F.col("whole") + drawn).alias("copies"))


def mixed_sizes(docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), cap: float = 3.0, seed: int = 7) -> DataFrame:
    """One row a document: doc_id, source, size, source_size, target and copies (0 to ``cap``).

    Null texts have size 0; a null source is a source of its own, the last one. Sizes of 0 are never drawn but share the
    whole copies. Equal rows share one decision. Reruns agree. An empty table gives an empty table.
    """
    sized = staged(docs.select("doc_id", "source", n_words().alias("size"), draw(seed).alias("drawn")), "mix-sizes")
    return copies(sized, plan_mix(sized, weights, cap)).drop("drawn")


def mix(docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), cap: float = 3.0, seed: int = 7) -> DataFrame:
    """The documents of the mix, all columns, each as often as it was drawn."""
    sized = staged(docs.select("source", n_words().alias("size"), draw(seed).alias("drawn")), "mix-sizes")
    plan = plan_mix(sized, weights, cap)
    own = docs.columns
    packed = docs.select(F.struct(*own).alias("doc"), F.col("source"), draw(seed).alias("drawn"))
    chosen = copies(packed, plan).filter("copies > 0")
    return chosen.select("doc", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("doc.*")
