"""Results don't depend on the session's time zone."""

import datetime

import pytest
from compare import connect, duck_result, spark_result
from pyspark.sql import functions as F

from gaugeworks.functions.text import row_key, split_line
from gaugeworks.functions.time import iso_millis
from gaugeworks.operators import aggregates as agg
from gaugeworks.operators import keyed
from gaugeworks.plans.oracle import all_oracles
from gaugeworks.plans.queries import all_queries

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def elsewhere(spark):
    session = spark.newSession()
    session.conf.set("spark.sql.session.timeZone", "America/New_York")
    return session


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_queries_elsewhere(elsewhere, name):
    columns, rows = spark_result(all_queries()[name](elsewhere, SF_DIR))
    expected_columns, expected = duck_result(connect(SF_DIR), all_oracles()[name])
    assert (columns, rows) == (expected_columns, expected)


def test_hour_that_clocks_skip(elsewhere):
    """On 2024-03-10 New York has no 02:30."""
    times = [datetime.datetime(2024, 3, 10, h, 30) for h in (1, 2, 3)]
    rows = elsewhere.createDataFrame([("A", t, float(k), None) for k, t in enumerate(times)], "sensor_id string, time timestamp_ntz, pm25 double, no2 double")
    keys = rows.select(row_key(F.col("sensor_id"), iso_millis(F.col("time"))).alias("k"))
    assert sorted(r.k for r in keys.collect()) == [f"A_2024-03-10T0{h}_30_00.000" for h in (1, 2, 3)]
    assert sorted((r.hour, r.pm25_avg) for r in agg.hourly_averages(rows).collect()) == [(f"2024-03-10T0{h + 1}", float(h)) for h in (0, 1, 2)]
    raw = rows.select(F.lit(1).alias("ingest_seq"), "sensor_id", iso_millis(F.col("time")).alias("time"), F.col("pm25").cast("string"))
    assert keyed.reduce_batch(keyed.to_cells(raw), list(keyed.CELLS)).count() == 3


def test_fractions_of_seconds(spark):
    times = [datetime.datetime(2024, 3, 10, 2, 30, 5, f) for f in (0, 7, 70_000, 123_456, 999_999)]
    rows = spark.createDataFrame([(t,) for t in times], "time timestamp_ntz").select(iso_millis(F.col("time")).alias("t"))
    assert [r.t[-7:] for r in rows.collect()] == [":05.000", ":05.000", ":05.070", ":05.123", ":05.999"]


def test_any_character_may_stand_in_a_field(spark):
    line = 'a￿b,"c,d",e,"\x01"'
    assert spark.createDataFrame([(line,)], "v string").select(split_line(F.col("v")).alias("f")).first().f == ["a￿b", "c,d", "e", "\x01"]
