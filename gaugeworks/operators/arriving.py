"""Results that are kept up to date as days of readings arrive, without reading what came long before.

*States* are mergeable: for each sensor and day the count, mean, second moment, minimum and maximum of each measure. Summary, daily
averages, report averages, deviation and the limits of anomalies follow from them, and states of parts add up to those of the whole. A
batch's states are a folder of their own, so that adding a batch again replaces what it gave before.

*Rolling averages* of new days need their own readings, the readings one frame earlier, and totals of the slices between. All
are kept by day; a batch of whole days writes its days and reads only those days of the others that its frames reach.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, timedelta
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeworks.operators import rolling
from gaugeworks.session import names_in
from gaugeworks.sources.readings import MEASURES

# --- states ------------------------------------------------------------------------------------


def daily_states(readings: DataFrame, measures: tuple[str, ...] = MEASURES) -> DataFrame:
    """One row per sensor and day: ``records``, and per measure ``n``, ``mean``, ``m2`` (sum of squared deviations), ``min``, ``max``."""
    aggs = [F.count(F.lit(1)).alias("records")]
    for m in measures:
        aggs += [
            F.count(m).alias(f"{m}_n"),
            F.avg(m).alias(f"{m}_mean"),
            (F.var_pop(m) * F.count(m)).alias(f"{m}_m2"),
            F.min(m).alias(f"{m}_min"),
            F.max(m).alias(f"{m}_max"),
        ]
    return readings.groupBy("sensor_id", F.to_date("time").alias("date")).agg(*aggs)


def merged_states(states: DataFrame, *keys: str, measures: tuple[str, ...] = MEASURES) -> DataFrame:
    """States of coarser keys (none: one row). Second moments are merged around the common mean, so nothing cancels."""
    aggs = [F.coalesce(F.sum("records"), F.lit(0)).alias("records")]
    for m in measures:
        n = F.coalesce(F.sum(f"{m}_n"), F.lit(0))
        aggs += [
            n.alias(f"{m}_n"),
            F.when(n > 0, F.sum(F.col(f"{m}_n") * F.col(f"{m}_mean")) / n).alias(f"{m}_mean"),
            F.min(f"{m}_min").alias(f"{m}_min"),
            F.max(f"{m}_max").alias(f"{m}_max"),
        ]
    first = states.groupBy(*keys).agg(*aggs)
    means = first.select(*[F.col(k).alias(f"_{k}") for k in keys], *[F.col(f"{m}_mean").alias(f"_{m}") for m in measures])
    if keys:
        same = [states[k].eqNullSafe(means[f"_{k}"]) for k in keys]
        around = states.join(means, same)
    else:
        around = states.withColumns({f"_{m}": means.select(f"_{m}").scalar() for m in measures})
    apart = {m: F.col(f"{m}_mean") - F.col(f"_{m}") for m in measures}
    moments = [F.sum(F.col(f"{m}_m2") + F.col(f"{m}_n") * apart[m] * apart[m]).alias(f"{m}_m2") for m in measures]
    second = around.groupBy(*keys).agg(*moments)
    if not keys:
        return first.withColumns({f"{m}_m2": second.select(f"{m}_m2").scalar() for m in measures})
    second = second.withColumnsRenamed({k: f"_{k}" for k in keys})
    return first.join(second, [first[k].eqNullSafe(second[f"_{k}"]) for k in keys]).drop(*[f"_{k}" for k in keys])


def _means(states: DataFrame, *keys: str, measures: tuple[str, ...] = MEASURES) -> DataFrame:
    """Like `merged_states`, without second moments: one aggregation."""
    aggs = [F.sum("records").alias("records")]
    for m in measures:
        n = F.sum(f"{m}_n")
        aggs += [
            F.when(n > 0, F.sum(F.col(f"{m}_n") * F.col(f"{m}_mean")) / n).alias(f"{m}_avg"),
            F.min(f"{m}_min").alias(f"{m}_min"),
            F.max(f"{m}_max").alias(f"{m}_max"),
            n.alias(f"{m}_count"),
        ]
    return states.groupBy(*keys).agg(*aggs)


def summary_of(states: DataFrame, measures: tuple[str, ...] = MEASURES) -> DataFrame:
    """`aggregates.per_sensor_summary`."""
    return _means(states, "sensor_id", measures=measures).drop("records").orderBy(F.desc_nulls_last(f"{measures[0]}_avg"), "sensor_id")


def daily_averages_of(states: DataFrame, measures: tuple[str, ...] = MEASURES) -> DataFrame:
    """`aggregates.daily_averages`."""
    days = _means(states, "date", measures=measures)
    return days.select("date", *[f"{m}_avg" for m in measures], "records").orderBy("date")


def report_averages_of(states: DataFrame, key: str, measures: tuple[str, ...] = MEASURES) -> DataFrame:
    """`aggregates.sensor_averages` (key ``sensor_id``) or `aggregates.daily_measures` (``date``) of typed readings."""
    known = states.filter((F.col(key) != "") if key == "sensor_id" else F.col(key).isNotNull())
    kept = _means(known, key, measures=measures).filter(reduce(or_, [F.col(f"{m}_count") > 0 for m in measures]))
    columns = [c for m in measures for c in (F.coalesce(f"{m}_avg", F.lit(0.0)).alias(f"{m}_avg"), F.col(f"{m}_count"))]
    return kept.select(key, *columns)


def global_stats_of(states: DataFrame, measures: tuple[str, ...] = MEASURES) -> DataFrame:
    """`aggregates.global_stats`."""
    whole = merged_states(states, measures=measures)
    columns = []
    for m in measures:
        deviation = F.when(F.col(f"{m}_n") > 1, F.sqrt(F.col(f"{m}_m2") / (F.col(f"{m}_n") - 1)))
        columns += [F.coalesce(f"{m}_mean", F.lit(0.0)).alias(f"{m}_mean"), F.coalesce(deviation, F.lit(0.0)).alias(f"{m}_std")]
    return whole.select(*columns)


def add_states(path: str, batch: str, readings: DataFrame) -> None:
    """Add the states of a batch of readings, or replace those that the batch of this name gave before."""
    daily_states(readings).write.mode("overwrite").parquet(f"{path}/batch={batch}")


def read_states(spark: SparkSession, path: str) -> DataFrame:
    """The states of all batches; those of one sensor and day may be in several rows."""
    return spark.read.parquet(path).drop("batch")


# --- rolling averages --------------------------------------------------------------------------

#: The day of readings without a time: they share frames, so they are one batch.
NO_DAY = "none"


def _day() -> Column:
    return F.coalesce(F.to_date("time").cast("string"), F.lit(NO_DAY)).alias("day")


def _stored_days(spark: SparkSession, folder: str) -> list[str]:
    return [name.partition("=")[2] for name in names_in(spark, folder) if name.startswith("day=")]


def _read_days(spark: SparkSession, folder: str, schema: T.StructType, days: Iterable[str]) -> DataFrame:
    paths = [f"{folder}/day={day}" for day in days]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def _write_days(rows: DataFrame, folder: str) -> None:
    """Replace the days of ``rows``. All of it follows from the batch, so what a stopped write has lost, adding the batch again restores."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(folder)


def add_rolling(spark: SparkSession, path: str, batch: DataFrame, seconds: int = rolling.DAY_SECONDS, slices: int = rolling.SLICES) -> None:
    """Add the readings (``sensor_id, time`` and measures) of whole days, none before a day that is there, and their averages.

    Adding the same days again replaces them. A slice must divide a day.
    """
    length = rolling.slice_length(seconds, slices)
    if rolling.DAY_SECONDS % length:
        raise ValueError(f"slices of {length} seconds don't divide a day")
    days = {r[0] for r in batch.select(_day()).distinct().collect()}  # folders to write
    dated = [date.fromisoformat(d) for d in sorted(days - {NO_DAY})]
    there = set(_stored_days(spark, f"{path}/rolling")) - {NO_DAY} - days
    if dated and there and max(there) > dated[0].isoformat():
        raise ValueError(f"{max(there)} is there already; days are added in order")
    if not days:
        return
    _write_days(batch.select("*", _day()), f"{path}/readings")
    own = _read_days(spark, f"{path}/readings", batch.schema, sorted(days))
    totals = rolling.slice_totals(own, seconds=seconds, slices=slices)
    start = F.date_add(F.lit("1970-01-01").cast("date"), F.floor(F.col("_slice") * length / rolling.DAY_SECONDS).cast("int"))
    _write_days(totals.withColumn("day", start.cast("string")), f"{path}/totals")
    earlier = _read_days(spark, f"{path}/readings", batch.schema, days_one_frame_before(spark, path, dated, seconds))
    frame = {d for d in _stored_days(spark, f"{path}/totals") if dated and _shifted(dated[0], seconds) <= d <= dated[-1].isoformat()}
    state = _read_days(spark, f"{path}/totals", totals.schema, sorted(frame))
    out = rolling.trailing_averages_of_batch(own, earlier, state, seconds=seconds, slices=slices)
    _write_days(out.select("*", _day()), f"{path}/rolling")


def _shifted(day: date, seconds: int) -> str:
    """The day ``seconds`` before the beginning of ``day``."""
    return (day - timedelta(days=-(-seconds // rolling.DAY_SECONDS))).isoformat()


def days_one_frame_before(spark: SparkSession, path: str, days: list[date], seconds: int) -> list[str]:
    """The stored days that the frames of ``days`` begin in, but for those days themselves."""
    if not days:
        return []
    first, last = _shifted(days[0], seconds), (days[-1] - timedelta(days=seconds // rolling.DAY_SECONDS)).isoformat()
    return [d for d in _stored_days(spark, f"{path}/readings") if first <= d <= last and d < days[0].isoformat()]


def read_rolling(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/rolling").drop("day")
