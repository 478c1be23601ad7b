"""Trailing averages with slices of any length agree with Spark's own sliding frame, also where one sensor holds a third of all rows."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gaugeworks.functions.time import epoch_seconds
from gaugeworks.operators.rolling import rolling_24h, trailing_averages
from gaugeworks.plans.queries import readings

SF_DIR = "/root/testdata/sf0.01"
WAYS = {"half days": {"slices": 2}, "hours": {"slices": 24}, "days": {}, "six": {"slices": 7}, "seconds": {"slices": 86_400}}


def skewed(spark, hot="hot"):
    """A third of all readings on one sensor, and some without a time."""
    seq = F.col("ingest_seq")
    rows = readings(spark, SF_DIR).withColumn("sensor_id", F.when(seq % 3 == 0, F.lit(hot)).otherwise(F.col("sensor_id")))
    return rows.withColumn("time", F.when(seq % 50 != 0, F.col("time"))).drop("sensor_name")


def averages(spark, **sizes):
    out = trailing_averages(skewed(spark), **sizes)
    out = out.select("ingest_seq", F.round("rolling_pm25", 8), F.round("rolling_no2", 8))
    return sorted(tuple(r) for r in out.collect())


@pytest.fixture(scope="module")
def expected(spark):
    rows = skewed(spark)
    frame = W.partitionBy("sensor_id").orderBy("s").rangeBetween(-86_400, 0)
    out = rows.withColumn("s", epoch_seconds(rows, "time")).select("ingest_seq", *[F.round(F.avg(m).over(frame), 8) for m in ("pm25", "no2")])
    return sorted(tuple(r) for r in out.collect())


@pytest.mark.parametrize("way", WAYS)
def test_ways_agree(spark, expected, way):
    assert len(expected) == 10_000
    assert averages(spark, **WAYS[way]) == expected


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    rows=st.lists(
        st.tuples(
            st.sampled_from(["A", "B", None]),
            st.one_of(st.none(), st.integers(-25, 60)),
            st.one_of(st.none(), st.integers(0, 8)),
        ),
        min_size=1,
        max_size=30,
    ),
    length=st.integers(1, 20),
    way=st.sampled_from(sorted(WAYS)),
)
def test_brute_force(spark, rows, length, way):
    data = [(i, s, t, None if v is None else float(v)) for i, (s, t, v) in enumerate(rows)]
    df = spark.createDataFrame(data, "i int, sensor_id string, s long, v double")
    df = df.withColumn("time", F.timestamp_seconds("s"))
    out = trailing_averages(df, ("v",), length, ("avg",), **WAYS[way])
    got = {r.i: r.avg for r in out.collect()}
    for i, (sensor, t, _) in enumerate(rows):
        same = [(u, v) for s, u, v in rows if s == sensor and v is not None]
        frame = [v for u, v in same if (u is None and t is None) or (None not in (u, t) and t - length <= u <= t)]
        assert got[i] == (pytest.approx(sum(frame) / len(frame)) if frame else None)
    assert len(got) == len(rows)


def test_no_readings(spark):
    assert rolling_24h(skewed(spark).filter("false")).count() == 0


def shape(rows, slices=2):
    plan = rolling_24h(rows, slices)._jdf.queryExecution().executedPlan().toString()
    return [line.split("#")[0].strip(" +-:").split(" ")[0].split("(")[0] for line in plan.splitlines()]


def test_one_plan_for_all_data(spark):
    """Readings and carries are shuffled once, totals of slices, if there are several, twice; nothing runs while the plan is made."""
    even, uneven = shape(readings(spark, SF_DIR)), shape(readings(spark, SF_DIR).withColumn("sensor_id", F.lit("hot")).where("ingest_seq > 5"))
    assert even.count("Exchange") == 3 and "Python" not in " ".join(even)
    assert shape(readings(spark, SF_DIR), slices=1).count("Exchange") == 1
    assert [x for x in even if x in ("Exchange", "Window", "HashAggregate", "Union", "Generate")] == [
        x for x in uneven if x in ("Exchange", "Window", "HashAggregate", "Union", "Generate")
    ]
    rows = skewed(spark)  # reads the file's schema
    spark.sparkContext.setJobGroup("planning", "no jobs")
    rolling_24h(rows)
    assert list(spark.sparkContext.statusTracker().getJobIdsForGroup("planning")) == []


def test_special_values_leave_the_frame(spark):
    """What a frame once held doesn't linger: not a number, infinity, and numbers that swallow others."""
    values = [float("nan"), float("inf"), 1e300, 2.0, 4.0]
    rows = spark.createDataFrame([("A", 86_500 * k, v) for k, v in enumerate(values)], "sensor_id string, s long, v double").withColumn("time", F.timestamp_seconds("s"))
    for way in WAYS.values():
        out = [r.avg for r in trailing_averages(rows, ("v",), names=("avg",), **way).orderBy("time").collect()]
        assert str(out[0]) == "nan" and out[1:] == values[1:]


def test_zoneless_times_ignore_the_session_zone(spark, expected):
    zone = spark.conf.get("spark.sql.session.timeZone")
    data = [("A", f"2024-03-10 0{hour}:30:00", value) for hour, value in ((1, 1.0), (2, 3.0), (3, 5.0))]
    rows = spark.createDataFrame(data, "sensor_id string, t string, v double")
    rows = rows.withColumn("time", F.col("t").cast("timestamp_ntz"))
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        out = trailing_averages(rows, ("v",), 3600, ("avg",))
        assert [r.avg for r in out.orderBy("t").collect()] == [1.0, 2.0, 4.0]
        assert averages(spark) == expected
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
