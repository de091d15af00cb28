"""Helpers for plans in stages: cutting lineage, exact quantiles and numbering without a task that holds everything."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Equal-width bins of a quantile's first pass, and hash buckets of a numbering.
BINS, HASH_DIGITS = 4096, 4


def cut(df: DataFrame) -> DataFrame:
    """A reliable checkpoint in the folder that the session names (``spark.checkpoint.dir``); without one, under the warehouse."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"
        spark.sparkContext.setCheckpointDir(base)
    return df.checkpoint()


#: Rows of a table that is sent to every task.
BESIDE = 100_000


def beside(df: DataFrame) -> DataFrame:
    """``df``, a row or two for each group of a larger table, ready to be joined to it: cut, and broadcast if it has few rows.

    A join by few groups deals the larger table by them, and so does what comes after it by group and more: a task for each group.
    """
    df = cut(df)
    return F.broadcast(df) if df.count() <= BESIDE else df


def quantile(df: DataFrame, by: list[str], value: str, q: float, name: str = "quantile") -> DataFrame:
    """(by, name): the exact quantile of each group, linear between ranks, as ``percentile`` gives it; NULLs don't count.

    ``percentile`` keeps all different values of a group in one buffer. Here the values are counted in bins of equal width, and only
    the bins that hold the two ranks next to the quantile are ordered, one row for each different value.
    """
    v = df.filter(F.col(value).isNotNull()).select(*by, F.col(value).cast("double").alias("_v"))
    span = v.groupBy(*by).agg(F.min("_v").alias("_lo"), F.max("_v").alias("_hi"), F.count("*").alias("_n"))
    share = (F.col("_v") - F.col("_lo")) / F.nullif(F.col("_hi") - F.col("_lo"), F.lit(0.0))
    binned = v.join(beside(span), by).withColumn("_bin", F.least(F.floor(F.coalesce(share, F.lit(0.0)) * BINS), F.lit(BINS - 1)))
    at = (F.col("_n") - 1) * F.lit(float(q))
    low, high = F.floor(at), F.least(F.floor(at) + 1, F.col("_n") - 1)
    counted = binned.groupBy(*by, "_bin", "_n").agg(F.count("*").alias("_c"))
    counted = counted.withColumn("_upto", F.sum("_c").over(Window.partitionBy(*by).orderBy("_bin")))
    held = counted.filter((F.col("_upto") > low) & (F.col("_upto") - F.col("_c") <= high))
    held = held.select(*by, "_bin", (F.col("_upto") - F.col("_c")).alias("_before"))
    ties = binned.join(beside(held), [*by, "_bin"]).groupBy(*by, "_n", "_v").agg(F.count("*").alias("_c"), F.min("_before").alias("_before"))
    order = Window.partitionBy(*by).orderBy("_v")
    ties = ties.withColumn("_upto", F.min("_before").over(Window.partitionBy(*by)) + F.sum("_c").over(order))
    ends = ties.groupBy(*by, "_n").agg(F.min(F.when(F.col("_upto") > low, F.col("_v"))).alias("_a"), F.min(F.when(F.col("_upto") > high, F.col("_v"))).alias("_b"))
    return ends.select(*by, (F.col("_a") + (F.col("_b") - F.col("_a")) * (at - F.floor(at))).alias(name))


def numbered(df: DataFrame, digest: str, key: str, most: int) -> DataFrame:
    """The first ``most`` rows in the order of a hexadecimal digest, then ``key``, with their number from 0 as ``_rn``.

    Rows are counted by the first digits of the digest; prefix sums of these counts (65,536 at most) give each bucket its first
    number, so buckets are numbered apart and those beyond ``most`` are not ordered at all.
    """
    df = df.withColumn("_bucket", F.substring(digest, 1, HASH_DIGITS))
    counts = df.groupBy("_bucket").agg(F.count("*").alias("_c"))
    before = F.coalesce(F.sum("_c").over(Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    bases = counts.withColumn("_base", before).filter(F.col("_base") < most).select("_bucket", "_base")
    at = F.row_number().over(Window.partitionBy("_bucket").orderBy(digest, key))
    ranked = df.join(F.broadcast(bases), "_bucket").withColumn("_rn", F.col("_base") + at - 1)
    return ranked.filter(F.col("_rn") < most).drop("_bucket", "_base")
