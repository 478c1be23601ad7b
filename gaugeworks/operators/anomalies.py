"""Readings far above the global mean."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeworks.operators.aggregates import global_stats
from gaugeworks.sources.readings import MEASURES


def anomalies(readings: DataFrame, measures: tuple[str, ...] = MEASURES, deviations: float = 2.0) -> DataFrame:
    """Readings where some measure is above mean + ``deviations`` sample standard deviations.

    The limits are scalar subqueries over one shared aggregation: Spark computes them first and
    filters the scan against two constants, so no reading is shuffled. A measure whose deviation is
    zero or NaN has a null limit and flags nothing.
    """
    stats = global_stats(readings, measures)

    def limit(m: str):
        mean, std = F.col(f"{m}_mean"), F.col(f"{m}_std")
        return stats.select(F.when((std > 0) & ~F.isnan(std), mean + F.lit(deviations) * std)).scalar()

    above = [F.col(m) > limit(m) for m in measures]
    return readings.filter(reduce(or_, above)).select("sensor_id", "time", *measures)
