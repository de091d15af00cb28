"""Small helpers shared by the corpus operators."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word, for every operator that counts or shingles words.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession, what: str) -> str:
    """A fresh folder that the driver and all executors can reach.

    It lies under ``spark.checkpoint.dir``. Only where the session names none (tests, a notebook on one
    machine) a folder under the warehouse is used instead.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        base = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_staging"
    return f"{base.rstrip('/')}/{what}-{uuid.uuid4().hex}"


def staged(df: DataFrame, what: str, by: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder, in folders by the column ``by`` if given, and read it again.

    Cuts the lineage (a lost executor does not recompute what lies before) and gives later joins true sizes.
    """
    spark = df.sparkSession
    path = shared_dir(spark, what)
    (df.write.partitionBy(by) if by else df.write).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """``df``, dealt over all cores where it comes in fewer partitions than there are (a small file); else as it is."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def text_or_empty(col: str = "text"):
    return F.coalesce(F.col(col), F.lit(""))


#: Bytes of an Arrow batch on its way to a Python worker, unless the session says otherwise.
BATCH_BYTES = 4 << 20
BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"


def in_arrow(df: DataFrame, run, schema) -> DataFrame:
    """``df.mapInArrow(run, schema)`` with batches bounded by bytes.

    Without a bound a batch has 10,000 rows, whatever their length, in the executor and in the worker. The bound is a setting of
    the session; where it has none, it gets ``BATCH_BYTES``. A text longer than that travels alone and whole.
    """
    conf = df.sparkSession.conf
    if conf.get(BATCH_CONF, None) is None:
        conf.set(BATCH_CONF, str(BATCH_BYTES))
    return df.mapInArrow(run, schema)


def in_slices(batches, rows: int = 512):
    """Arrow batches in slices, so that a worker holds few texts as Python strings and passes results on early."""
    for batch in batches:
        for i in range(0, max(1, batch.num_rows), rows):
            yield batch.slice(i, rows)
