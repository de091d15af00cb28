"""How cubes lie on disk: along a Z-order curve for windows, in buckets of pixels for joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows of a file along the curve, about, and of a row group.
FILE_ROWS, GROUP_BYTES = 5_000_000, 8 << 20


def _spread(x: Column) -> Column:
    """The lower 32 bits of a long on its even places."""
    x = x.bitwiseAND(F.lit(0xFFFFFFFF))
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
        x = x.bitwiseOR(F.shiftleft(x, shift)).bitwiseAND(F.lit(mask))
    return x


def z_order(row: Column, col: Column) -> Column:
    """The place of a pixel on the curve that takes row's and col's bits in turn; rows and columns from -2^30 to 2^30 - 1 keep their order."""
    own = lambda c: _spread(c.cast("long") + (1 << 30))
    return F.shiftleft(own(row), 1).bitwiseOR(own(col))


def write_clustered(cube: DataFrame, path: str, by: tuple[str, ...] = ("frame_id", "layer"), file_rows: int = FILE_ROWS, group_bytes: int = GROUP_BYTES) -> None:
    """Writes a cube in folders by ``by``, its pixels along the Z-order curve: files and row groups hold squares, so that a square window
    reads few of them. Files follow the curve by ranges, so a frame of any size is dealt over tasks."""
    keys = [c for c in by if c in cube.columns]
    n = max(1, -(-cube.count() // file_rows))
    sorted_ = cube.withColumn("_z", z_order(F.col("row"), F.col("col"))).repartitionByRange(n, *keys, "_z").sortWithinPartitions(*keys, "_z").drop("_z")
    sorted_.write.option("parquet.block.size", group_bytes).partitionBy(*keys).parquet(path)


def write_bucketed(cube: DataFrame, table: str, path: str, buckets: int = 16) -> DataFrame:
    """Writes a cube as an external table in buckets of its pixels (frame_id, row, col), and returns it.

    Cubes in as many buckets join on pixels, and on pixels and dates, and group by pixels, without an exchange. For keys beyond the
    buckets' own the session is told that a part of the keys is enough to meet on.
    """
    cube.sparkSession.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    cube.repartition(buckets, "frame_id", "row", "col").write.mode("overwrite").option("path", path).bucketBy(buckets, "frame_id", "row", "col").sortBy("frame_id", "row", "col").saveAsTable(table)
    return cube.sparkSession.table(table)
