"""Trailing time-window averages per sensor.

The frame of a reading at second ``t`` is ``[t - length, t]``, both ends included, with every reading of second ``t``.

Spark's own sliding range frame re-adds the frame for every row and keeps a sensor in one task, which is quadratic for a busy
sensor. Here the time line is cut into slices that divide the frame's length, and a frame is put together from three parts:

* the readings of its own slice up to ``t``: a running sum, ascending;
* the whole slices between: their totals, one row per (sensor, slice), reduced map-side, and summed over the slices before;
* the readings of the slice in which the frame begins, from ``t - length`` on: each reading is used again as a carry, placed
  ``length`` seconds later and so in the slice of ``t``, where the carries at ``t`` or later are a running sum, descending.

All three meet in one group per (sensor, slice), in one shuffle: the total of the slices between comes as a row of its own, placed
before the slice's readings. Nothing is subtracted, so special values and great magnitudes leave a frame without a trace. The
work per reading doesn't depend on the frame, a group holds one slice of one sensor, and the plan is the same for all data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gaugeworks.functions.time import epoch_seconds
from gaugeworks.sources.readings import MEASURES

DAY_SECONDS = 86_400
# A frame is cut into so many slices. One is fastest; more make smaller groups, at the price of rows of totals, where a frame of one
# sensor is too much for a task.
SLICES = 1

OWN, CARRY, BETWEEN = 0, 1, 2


def trailing_averages(
    readings: DataFrame,
    measures: tuple[str, ...] = MEASURES,
    seconds: int = DAY_SECONDS,
    names: tuple[str, ...] | None = None,
    slices: int = SLICES,
) -> DataFrame:
    """All columns of ``readings`` plus the trailing average of each measure, one row per reading.

    Readings without a time share one frame per sensor. The frame is cut into at most ``slices`` slices of whole seconds.
    """
    names = names or tuple(f"rolling_{m}" for m in measures)
    length = slice_length(seconds, slices)
    rows = _placed(readings, measures)
    totals = _totals(rows, measures, length) if length < seconds else None
    return _averages(_with_carries(rows, measures, seconds), totals, measures, seconds, length, names).select(*readings.columns, *names)


def slice_length(seconds: int, slices: int = SLICES) -> int:
    """Whole seconds of a slice, of at most ``slices`` to a frame."""
    return seconds // next(n for n in range(slices, 0, -1) if seconds % n == 0)


def slice_totals(readings: DataFrame, measures: tuple[str, ...] = MEASURES, seconds: int = DAY_SECONDS, slices: int = SLICES) -> DataFrame:
    """Sums and counts per sensor and slice, the state that further readings need beside those of a frame's first slice."""
    return _totals(_placed(readings, measures), measures, slice_length(seconds, slices))


def trailing_averages_of_batch(
    batch: DataFrame,
    earlier: DataFrame,
    totals: DataFrame,
    measures: tuple[str, ...] = MEASURES,
    seconds: int = DAY_SECONDS,
    names: tuple[str, ...] | None = None,
    slices: int = SLICES,
) -> DataFrame:
    """`trailing_averages` of the readings of ``batch`` alone, where others came before.

    ``earlier`` has at least the readings ``seconds`` before those of the batch, up to the end of their slice; ``totals`` the
    `slice_totals` of the frame before the batch, and of the batch.
    """
    names = names or tuple(f"rolling_{m}" for m in measures)
    length = slice_length(seconds, slices)
    parts = _with_carries(_placed(batch, measures), measures, seconds)
    before = _with_carries(_placed(earlier, measures), measures, seconds).filter(F.col("_kind") == CARRY)
    parts = parts.unionByName(before, allowMissingColumns=True)
    return _averages(parts, totals, measures, seconds, length, names).select(*batch.columns, *names)


def rolling_24h(readings: DataFrame, slices: int = SLICES) -> DataFrame:
    """``sensor_id, time`` and the trailing 24-hour average of both measures."""
    narrow = readings.select("sensor_id", "time", *MEASURES)
    names = ("rolling_pm25_24h", "rolling_no2_24h")
    return trailing_averages(narrow, names=names, slices=slices).select("sensor_id", "time", *names)


def _counts(measures: tuple[str, ...]) -> list[str]:
    return [f"_{m}_n" for m in measures]


def _placed(readings: DataFrame, measures: tuple[str, ...]) -> DataFrame:
    """Readings with their second, and for each measure whether it is there."""
    there = {c: F.when(F.col(m).isNotNull(), 1).otherwise(0).cast("long") for m, c in zip(measures, _counts(measures))}
    return readings.withColumn("_second", epoch_seconds(readings, "time")).withColumns(there)


def _with_carries(rows: DataFrame, measures: tuple[str, ...], seconds: int) -> DataFrame:
    """Each reading at its own second and again, as a carry, ``seconds`` later.

    A carry travels only with its sensor, measures and counts, and only if it has a time and some value.
    """
    carry = F.col("_kind") == CARRY
    useful = F.col("_second").isNotNull() & F.coalesce(*measures).isNotNull()
    own_only = [c for c in rows.columns if c not in {"sensor_id", "_second", *measures, *_counts(measures)}]
    return (
        rows.withColumn("_kind", F.explode(F.array(F.lit(OWN), F.lit(CARRY))))
        .filter(~carry | useful)
        .withColumns({c: F.when(~carry, F.col(c)) for c in own_only})
        .withColumn("_place", F.col("_second") + F.when(carry, F.lit(seconds)).otherwise(F.lit(0)))
        .drop("_second")
    )


def _totals(rows: DataFrame, measures: tuple[str, ...], length: int) -> DataFrame:
    slice_ = F.floor(F.col("_second") / length).alias("_slice")
    sums = [F.sum(c).alias(c) for c in (*measures, *_counts(measures))]
    return rows.filter(F.col("_second").isNotNull()).groupBy("sensor_id", slice_).agg(*sums)


def _between(totals: DataFrame, measures: tuple[str, ...], length: int, slices: int) -> DataFrame:
    """For each slice with readings the total of the ``slices - 1`` slices before it, placed before its first second."""
    before = W.partitionBy("sensor_id").orderBy("_slice").rangeBetween(1 - slices, -1)
    sums = [F.sum(c).over(before).alias(c) for c in (*measures, *_counts(measures))]
    placed = totals.select("sensor_id", "_slice", (F.col("_slice") * length - 1).alias("_place"), F.lit(BETWEEN).alias("_kind"), *sums)
    return placed.filter(F.coalesce(*measures).isNotNull())


def _averages(parts: DataFrame, totals: DataFrame | None, measures: tuple[str, ...], seconds: int, length: int, names: tuple[str, ...]) -> DataFrame:
    counts = _counts(measures)
    parts = parts.withColumn("_slice", F.floor(F.col("_place") / length))
    if totals is not None and length < seconds:
        parts = parts.unionByName(_between(totals, measures, length, seconds // length), allowMissingColumns=True)
    # Groups are sorted by a number first, which tells most of them apart at once.
    group = W.partitionBy("_group", "sensor_id", "_slice")
    ascending = group.orderBy(F.asc("_place")).rangeBetween(W.unboundedPreceding, W.currentRow)
    descending = group.orderBy(F.desc("_place")).rangeBetween(W.unboundedPreceding, W.currentRow)
    carry = F.col("_kind") == CARRY

    def running(side: str, wanted, window) -> list:
        return [F.sum(F.when(wanted, F.col(c))).over(window).alias(f"{side}{c}") for c in (*measures, *counts)]

    def total(c: str):
        return F.coalesce(F.col(f"_to{c}"), F.lit(0)) + F.coalesce(F.col(f"_from{c}"), F.lit(0))

    grouped = parts.withColumn("_group", F.xxhash64("sensor_id", "_slice"))
    there = grouped.select("*", *running("_to", ~carry, ascending))
    both = there.select("*", *running("_from", carry, descending)).filter(F.col("_kind") == OWN)
    return both.select("*", *[F.when(total(n) > 0, total(m) / total(n)).alias(name) for m, n, name in zip(measures, counts, names)])
