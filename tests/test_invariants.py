"""Relations between results, and the shape of the plans."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
from gaugeworks.functions.time import on_day
from gaugeworks.operators import aggregates as agg
from gaugeworks.operators import keyed
from gaugeworks.operators.anomalies import anomalies
from gaugeworks.operators.rolling import rolling_24h
from gaugeworks.plans.queries import DAY, cells, raw_readings, readings
from gaugeworks.sources.readings import to_long

SF_DIR = "/root/testdata/sf0.01"


def totals(df, *columns):
    return tuple(df.agg(*[F.sum(c) for c in columns]).first())


def executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_counts_agree(spark):
    rows = readings(spark, SF_DIR)
    present = rows.agg(F.count("pm25"), F.count("no2")).first()
    for result in (agg.per_sensor_summary(rows), agg.sensor_averages(rows), agg.daily_measures(rows), agg.hourly_averages(rows)):
        assert totals(result, "pm25_count", "no2_count") == tuple(present)
    assert totals(agg.daily_averages(rows), "records") == (rows.count(),)
    assert to_long(rows).count() == sum(present)


def test_text_and_typed_readings_agree(spark):
    rows, raw = readings(spark, SF_DIR), raw_readings(spark, SF_DIR)
    for operator in (agg.sensor_averages, agg.hourly_averages, agg.sensor_exceedances):
        a, b = operator(rows), operator(raw)
        assert sorted(a.drop("pm25_avg", "no2_avg").collect()) == sorted(b.drop("pm25_avg", "no2_avg").collect())


def test_rolling_average_lies_within_the_sensor(spark):
    rows = readings(spark, SF_DIR)
    joined = rolling_24h(rows).join(agg.per_sensor_summary(rows), "sensor_id")
    assert joined.filter("rolling_pm25_24h NOT BETWEEN pm25_min - 1e-9 AND pm25_max + 1e-9").count() == 0
    assert joined.filter("rolling_no2_24h NOT BETWEEN no2_min - 1e-9 AND no2_max + 1e-9").count() == 0


def test_anomalies_are_readings_above_the_limit(spark):
    rows = readings(spark, SF_DIR)
    s = agg.global_stats(rows).first()
    expected = rows.filter((F.col("pm25") > s.pm25_mean + 2 * s.pm25_std) | (F.col("no2") > s.no2_mean + 2 * s.no2_std))
    assert anomalies(rows).count() == expected.count() > 0


def test_export_has_the_rows_of_the_day(spark):
    rows = readings(spark, SF_DIR)
    assert keyed.export_day(cells(spark, SF_DIR), DAY).count() == rows.filter(F.to_date("time") == DAY).count()
    assert rows.filter(on_day(rows, "time", DAY)).count() == rows.filter(F.to_date("time") == DAY).count()


def test_latest_row_is_the_latest_time(spark):
    table = cells(spark, SF_DIR)
    newest = {r[0]: r[1] for r in table.groupBy("datasourceid").agg(F.max("time")).collect()}
    assert {r.datasourceid: r.time for r in keyed.latest_per_sensor(table).collect()} == newest


@pytest.mark.parametrize("name", sorted(driver.queries()))
def test_plans_stay_in_the_jvm_and_join_on_keys(spark, name):
    plan = executed(driver.queries()[name](spark, SF_DIR))
    for unwanted in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "LocalTableScan"):
        assert unwanted not in plan


def test_scans_are_narrow(spark):
    plan = executed(driver.queries()["daily_averages"](spark, SF_DIR))
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string,value:double>" in plan
    plan = executed(driver.queries()["export_day"](spark, SF_DIR))
    assert "GreaterThanOrEqual(ts,2024-01-05T00:00)" in plan and "LessThan(ts,2024-01-06T00:00)" in plan


def test_aggregates_reduce_before_the_shuffle(spark):
    for name in ("per_sensor_summary", "daily_averages", "hourly_averages", "sensor_exceedances"):
        plan = executed(driver.queries()[name](spark, SF_DIR))
        assert "partial_" in plan and "SortAggregate" not in plan


def test_anomalies_do_not_shuffle_readings(spark):
    plan = executed(driver.queries()["anomalies"](spark, SF_DIR))
    assert "Exchange hashpartitioning" not in plan and "Exchange rangepartitioning" not in plan
