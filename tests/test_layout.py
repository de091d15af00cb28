"""Layouts of cubes: fewer row groups for a window, no exchange below joins on pixels."""

import glob

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from subsidia.operators import compare, cube
from subsidia.sources import layout


def pixels(spark, scale=1.0):
    return spark.range(160_000).select(F.lit(1).alias("frame_id"), F.lit("d").alias("layer"), F.lit("2020-01-01").cast("date").alias("obs_date"), F.expr("cast(id div 400 as int)").alias("row"), (F.col("id") % 400).cast("int").alias("col"), (F.rand(3) * scale).alias("value"))


def plain_z(row, col):
    return sum(((row >> k & 1) << (2 * k + 1)) | ((col >> k & 1) << (2 * k)) for k in range(32))


def test_curve(spark):
    spots = [(0, 0), (5, 9), (1 << 20, 3), ((1 << 30) - 1, (1 << 30) - 1), (-1, -7), (-(1 << 30), 12)]
    got = [r[0] for r in spark.createDataFrame([(i, *s) for i, s in enumerate(spots)], "i int, r int, c int").orderBy("i").select(layout.z_order(F.col("r"), F.col("c"))).collect()]
    assert got == [plain_z(r + (1 << 30), c + (1 << 30)) for r, c in spots]


def test_a_square_window_reads_few_row_groups(spark, tmp_path):
    def groups(path):
        n = hit = 0
        for f in glob.glob(f"{path}/**/*.parquet", recursive=True):
            meta = pq.read_metadata(f)
            names = [meta.schema.column(i).name for i in range(meta.num_columns)]
            for g in range(meta.num_row_groups):
                span = {c: meta.row_group(g).column(names.index(c)).statistics for c in ("row", "col")}
                n += 1
                hit += span["row"].min < 250 and span["row"].max >= 200 and span["col"].min < 250 and span["col"].max >= 200
        return n, hit

    p = pixels(spark)
    layout.write_clustered(p, f"{tmp_path}/z", file_rows=10_000)
    p.repartitionByRange(16, "row").sortWithinPartitions("row", "col").write.partitionBy("frame_id", "layer").parquet(f"{tmp_path}/rows")
    (n, hit), (m, other) = groups(f"{tmp_path}/z"), groups(f"{tmp_path}/rows")
    assert n == m == 16 and hit <= 4 and other >= 2 and hit / n <= 0.25
    back = spark.read.parquet(f"{tmp_path}/z")
    assert back.filter("row between 200 and 249 and col between 200 and 249").count() == 2500 and back.count() == p.count()


def test_joins_on_pixels_take_no_exchange(spark, tmp_path):
    a, b = (layout.write_bucketed(pixels(spark, s), f"cube_{k}", f"{tmp_path}/{k}", 4) for k, s in (("a", 1.0), ("b", 2.0)))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for joined in (compare.common_dates(a, b), compare.version_compare(a, b), cube.subtract_corrections(a, b)):
            plan = joined._jdf.queryExecution().executedPlan().toString()
            assert "SortMergeJoin" in plan and "Exchange hash" not in plan
        assert compare.common_dates(a, b).count() == 160_000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        spark.sql("DROP TABLE cube_a")
        spark.sql("DROP TABLE cube_b")


@pytest.mark.parametrize("rows", [0, 1])
def test_small_cubes(spark, tmp_path, rows):
    p = pixels(spark).limit(rows)
    layout.write_clustered(p, f"{tmp_path}/z")
    assert (spark.read.schema(p.schema).parquet(f"{tmp_path}/z").count() if rows else 0) == rows
