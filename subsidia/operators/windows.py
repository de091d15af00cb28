"""Sums over square windows of pixels by summed-area tables, with as many rows whatever the radius."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Pixels of a block's side, at least; points that look into a block in one row.
SIDE, POINTS = 64, 1_024


def window_sums(points: DataFrame, pixels: DataFrame, columns: list[str], before: int, behind: int, key: str = "pid", epoch: list[str] | None = None) -> DataFrame:
    """key, epoch and, for each of ``columns``, the sum over the valid pixels from row - before to row + behind and the same columns; with
    their number n. Windows without a valid pixel have no row.

    ``points``: key, frame_id, row, col; ``pixels``: frame_id, row, col, ``epoch`` columns and ``columns``, a pixel being valid if none
    of these is NULL. The pixels of an epoch lie in blocks at least as wide as a window, so a window touches four at most. A task makes
    a block's summed-area tables once for the points that look into it; a sum over the window's part of the block takes four
    look-ups. Repeated pixels count as often as they are there.
    """
    epoch = epoch or []
    side = max(SIDE, before + behind + 1)
    block = lambda c: F.expr(f"cast(floor({c} / {side}) as int)")
    held = pixels.filter(" AND ".join(f"`{c}` IS NOT NULL" for c in columns))
    dense = held.groupBy("frame_id", block("row").alias("_br"), block("col").alias("_bc"), *epoch).agg(
        F.collect_list((F.pmod("row", F.lit(side)) * side + F.pmod("col", F.lit(side))).cast("int")).alias("_at"), *[F.collect_list(F.col(c).cast("double")).alias(f"_v_{i}") for i, c in enumerate(columns)]
    )
    span = lambda c: F.explode(F.array_distinct(F.array(*[F.floor((F.col(c) + d) / side).cast("int") for d in (-before, behind)])))
    asked = points.select(F.col(key).alias("_key"), "frame_id", "row", "col").withColumn("_br", span("row")).withColumn("_bc", span("col"))
    corner = lambda c, b, d: (F.col(c) + d - F.col(b) * side).cast("int")
    asked = asked.select("frame_id", "_br", "_bc", "_key", F.greatest(corner("row", "_br", -before), F.lit(0)).alias("r0"), F.least(corner("row", "_br", behind + 1), F.lit(side)).alias("r1"), F.greatest(corner("col", "_bc", -before), F.lit(0)).alias("c0"), F.least(corner("col", "_bc", behind + 1), F.lit(side)).alias("c1"))
    # Points of a crowded block are asked for in several rows.
    crowds = asked.groupBy("frame_id", "_br", "_bc").agg(F.ceil(F.count("*") / POINTS).alias("_shares"))
    at = ["frame_id", "_br", "_bc"]
    looks = asked.join(crowds, at).groupBy(*at, F.pmod(F.xxhash64("_key"), "_shares").alias("_share")).agg(*[F.collect_list(c).alias(c) for c in ("_key", "r0", "r1", "c0", "c1")])
    met = dense.join(looks, at).select(*epoch, "_at", *[f"_v_{i}" for i in range(len(columns))], "_key", "r0", "r1", "c0", "c1")
    kinds, n_epoch, n = dict(points.dtypes) | dict(pixels.dtypes), len(epoch), len(columns)

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            for i in range(batch.num_rows):
                row = [c[i] for c in batch.columns]
                flat = lambda c: c.values.to_numpy(zero_copy_only=False)
                places = flat(row[n_epoch])
                r0, r1, c0, c1 = map(flat, row[n_epoch + n + 2 :])
                sums = []
                for values in [np.ones(len(places)), *map(flat, row[n_epoch + 1 : n_epoch + 1 + n])]:
                    table = np.zeros((side + 1, side + 1))
                    table[1:, 1:] = np.bincount(places, values, side * side).reshape(side, side).cumsum(0).cumsum(1)
                    sums.append(table[r1, c1] - table[r0, c1] - table[r1, c0] + table[r0, c0])
                some = np.flatnonzero(sums[0] > 0.5)
                same = [pa.array([row[k].as_py()] * len(some), batch.column(k).type) for k in range(n_epoch)]
                keys = row[n_epoch + n + 1].values.take(pa.array(some))
                yield pa.RecordBatch.from_arrays([keys, *same, *[pa.array(s[some]) for s in sums[1:]], pa.array(np.rint(sums[0][some]).astype(np.int64))], names=["_key", *epoch, *columns, "n"])

    schema = ", ".join([f"_key {kinds[key]}", *[f"`{c}` {kinds[c]}" for c in epoch], *[f"`{c}` double" for c in columns], "n long"])
    parts = met.mapInArrow(run, schema).groupBy("_key", *epoch)
    return parts.agg(*[F.sum(c).alias(c) for c in columns], F.sum("n").alias("n")).withColumnRenamed("_key", key)
