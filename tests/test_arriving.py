"""Days that arrive one by one against all readings at once."""

import os

import pytest
from pyspark.sql import functions as F

from gaugeworks.operators import aggregates as agg
from gaugeworks.operators import arriving
from gaugeworks.operators.rolling import trailing_averages
from gaugeworks.plans.queries import skewed

SCHEMA = "sensor_id string, time timestamp_ntz, pm25 double, no2 double"
DAY = 86_400


def sample(spark, days=6, offset=0.0):
    """Readings of some sensors over some days, many of one sensor, values missing here and there."""
    seq = F.col("id")
    rows = spark.range(days * 60).select(
        F.when(seq % 3 == 0, "busy").when(seq % 11 != 0, F.concat(F.lit("s"), (seq % 4).cast("string"))).alias("sensor_id"),
        F.expr(f"timestamp_ntz '2026-02-01 00:00:00' + make_dt_interval(0, 0, 0, id * {days * DAY} div {days * 60})").alias("time"),
        F.when(seq % 5 != 0, (F.pmod(F.hash("id"), F.lit(1000)) / 7 + offset)).alias("pm25"),
        F.when(seq % 2 == 0, (F.pmod(F.hash("id", F.lit(1)), F.lit(1000)) / 3 - offset)).alias("no2"),
    )
    return rows.select(*[F.col(c).cast(t) for c, t in (f.split(" ") for f in SCHEMA.split(", "))])


def by_day(rows):
    days = [r[0] for r in rows.select(F.to_date("time").alias("d")).distinct().orderBy("d").collect()]
    return [rows.where(F.to_date("time").eqNullSafe(F.lit(d))) for d in days]


def values(df, digits=9):
    return sorted((tuple(round(x, digits) if isinstance(x, float) else x for x in r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("seconds, slices", [(DAY, 1), (2 * DAY, 2), (2 * DAY, 48), (DAY // 2, 1), (3 * 3600, 3)])
def test_rolling_day_by_day_equals_all_at_once(spark, tmp_path, seconds, slices):
    rows = sample(spark, days=4)
    rows = rows.unionByName(rows.limit(7).withColumn("time", F.lit(None).cast("timestamp_ntz")))
    for batch in by_day(rows):
        arriving.add_rolling(spark, str(tmp_path), batch, seconds, slices)
    expected = trailing_averages(rows, seconds=seconds, slices=slices)
    assert values(arriving.read_rolling(spark, str(tmp_path))) == values(expected)


def test_rolling_reads_only_the_days_one_frame_before(spark, tmp_path, monkeypatch):
    path, read = str(tmp_path), []
    original = arriving._read_days

    def watched(spark, folder, schema, days):
        read.append((os.path.basename(folder), list(days)))
        return original(spark, folder, schema, days)

    monkeypatch.setattr(arriving, "_read_days", watched)
    for batch in by_day(sample(spark)):
        read.clear()
        arriving.add_rolling(spark, path, batch, 3 * DAY, 3)
    names = [f"2026-02-0{d}" for d in range(1, 7)]
    assert read == [("readings", names[5:]), ("readings", [names[2]]), ("totals", names[2:])]


def test_rolling_days_can_be_added_again_but_not_before_others(spark, tmp_path):
    path, batches = str(tmp_path), by_day(sample(spark, days=3))
    for batch in (*batches, batches[2]):
        arriving.add_rolling(spark, path, batch)
    assert values(arriving.read_rolling(spark, path)) == values(trailing_averages(sample(spark, days=3)))
    with pytest.raises(ValueError, match="2026-02-03 is there already"):
        arriving.add_rolling(spark, path, batches[1])
    with pytest.raises(ValueError, match="don't divide a day"):
        arriving.add_rolling(spark, path, batches[2], seconds=7 * 3600)
    arriving.add_rolling(spark, path, batches[2].limit(0))


def test_a_stopped_batch_is_restored_by_adding_it_again(spark, tmp_path, monkeypatch):
    path, batches = str(tmp_path), by_day(sample(spark, days=3))
    for batch in batches[:2]:
        arriving.add_rolling(spark, path, batch)
    for stop in ("readings", "totals", "rolling"):
        with monkeypatch.context() as patch:
            original = arriving._write_days
            patch.setattr(arriving, "_write_days", lambda rows, folder, stop=stop: 1 / 0 if folder.endswith(stop) else original(rows, folder))
            with pytest.raises(ZeroDivisionError):
                arriving.add_rolling(spark, path, batches[2])
    arriving.add_rolling(spark, path, batches[2])
    assert values(arriving.read_rolling(spark, path)) == values(trailing_averages(sample(spark, days=3)))


@pytest.mark.parametrize("offset", [0.0, 1e6])
def test_states_of_parts_equal_one_pass(spark, tmp_path, offset):
    """Also where values are large beside their deviation."""
    rows = sample(spark, offset=offset)
    path = str(tmp_path)
    for k in range(4):  # parts share sensors and days
        arriving.add_states(path, str(k), rows.where(F.pmod(F.hash("time", "pm25"), F.lit(4)) == k))
    arriving.add_states(path, "3", rows.where(F.pmod(F.hash("time", "pm25"), F.lit(4)) == 3))  # again
    states = arriving.read_states(spark, path)

    def close(a, b):
        a, b = ({tuple(x for x in r if not isinstance(x, float)): r for r in df.collect()} for df in (a.select(b.columns), b))
        assert a.keys() == b.keys() and a
        for key in a:
            for x, y in zip(a[key], b[key]):
                assert x == y or abs(x - y) <= 1e-10 * abs(y)

    close(arriving.summary_of(states), agg.per_sensor_summary(rows))
    close(arriving.daily_averages_of(states), agg.daily_averages(rows))
    close(arriving.global_stats_of(states), agg.global_stats(rows))
    close(arriving.report_averages_of(states, "sensor_id"), agg.sensor_averages(rows))
    close(arriving.report_averages_of(states, "date"), agg.daily_measures(rows))
    close(arriving.merged_states(states, "sensor_id", "date"), arriving.daily_states(rows))


def test_states_of_nothing(spark):
    states = arriving.daily_states(spark.createDataFrame([], SCHEMA))
    assert [tuple(r) for r in arriving.global_stats_of(states).collect()] == [(0.0, 0.0, 0.0, 0.0)]
    assert arriving.summary_of(states).collect() == [] and arriving.merged_states(states, "date").collect() == []
    one = arriving.daily_states(spark.createDataFrame([("a", None, 5.0, None)], SCHEMA))
    assert [tuple(r) for r in arriving.global_stats_of(one).collect()] == [(5.0, 0.0, 0.0, 0.0)]


def test_skewed_keeps_its_columns(spark):
    rows = sample(spark).withColumn("ingest_seq", F.monotonically_increasing_id())
    assert skewed(rows).columns == rows.columns
