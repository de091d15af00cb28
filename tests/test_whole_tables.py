"""Queries that must look at all of their tables."""

import datetime

import pytest
from pyspark.sql import functions as F

from subsidia.functions import stages
from subsidia.operators import compare, validate
from subsidia.plans import registry, validation

SF = "/root/testdata/sf0.01"


def test_production_samples_hold_all_points(spark):
    n = validation.unique_points(spark, SF).count()
    assert n > 5001 and registry.QUERIES["w06_sample_pairs"](spark, SF).count() == n // 2
    assert registry.QUERIES["w07_profile_pairs"](spark, SF).count() > 100


def test_queries_reach_all_positions_and_frames(spark):
    sf = "/root/testdata/sf0.1"  # more than one frame
    cells = validation.fxs._cells(spark, sf)
    assert registry.QUERIES["p18_look_angles"](spark, sf).count() == cells.count()
    frames = {r[0] for r in cells.select("frame_id").distinct().collect()}
    assert len(frames) > 1 and {r[0] for r in registry.QUERIES["j04_station_pixel_sample"](spark, sf).select("frame_id").collect()} == frames
    rows = registry.QUERIES["j15_nearest_valid_pixel"](spark, sf).select(F.expr("near_row div 20").alias("frame_id")).distinct().collect()
    assert {r[0] for r in rows} == frames


@pytest.mark.parametrize("method", ["zscore", "modified"])
def test_outliers_of_few_groups_are_dealt_over_all_tasks(spark, monkeypatch, method):
    layer = spark.range(900).select((F.col("id") % 3).cast("int").alias("frame_id"), "id", F.when(F.col("id") % 50 != 7, F.col("id") % 31 + F.when(F.col("id") % 97 == 0, 500).otherwise(0)).cast("double").alias("value"))
    mask = validate.outlier_mask(layer, method, 3.0)
    plan = mask._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning(frame_id" not in plan  # one task a frame before
    monkeypatch.setattr(stages, "BESIDE", 0)
    assert sorted(mask.collect()) == sorted(validate.outlier_mask(layer, method, 3.0).collect())
    assert mask.filter("outlier").count() == 10


def test_common_reference_date_joins_no_rows(spark):
    day = lambda n: datetime.date(2020, 1, n)
    cubes = [spark.createDataFrame(rows, "frame_id int, obs_date date") for rows in ([(1, day(1)), (1, day(2)), (1, day(2)), (2, day(5)), (2, None), (4, None), (None, day(3)), (None, day(4))], [(1, day(2)), (1, day(3)), (3, day(1)), (2, None), (None, day(4))])]
    dates = compare.common_reference_date(*cubes)
    assert {r["frame_id"]: r["reference_date"] for r in dates.collect()} == {1: day(2), 2: day(5), 4: None, None: day(3)}
    assert "Join" not in dates._jdf.queryExecution().executedPlan().toString()  # all rows of both cubes were sorted for a join
