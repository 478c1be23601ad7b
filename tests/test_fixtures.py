"""Hand-made cases that the test tables cannot show."""

import math

import pytest
from pyspark.sql import functions as F

from gaugeworks.functions.text import row_key, split_line
from gaugeworks.operators import aggregates as agg
from gaugeworks.operators import keyed, serving
from gaugeworks.operators.anomalies import anomalies
from gaugeworks.operators.rolling import rolling_24h, trailing_averages
from gaugeworks.sources.readings import typed

NAN = float("nan")
TYPED = "sensor_id string, time timestamp, pm25 double, no2 double"
RAW = "ingest_seq long, sensor_id string, time string, pm25 string, no2 string"


def at(seconds):
    return F.timestamp_seconds(F.lit(seconds))


def raw(spark, rows):
    return spark.createDataFrame(rows, RAW)


def measured(spark, rows):
    """Readings from (sensor, pm25, no2), all at one time."""
    df = spark.createDataFrame(rows, "sensor_id string, pm25 double, no2 double")
    return df.withColumn("time", at(0))


def timed(spark, rows):
    """Readings from (sensor, epoch seconds or null, pm25)."""
    df = spark.createDataFrame(rows, "sensor_id string, s double, pm25 double")
    time = F.timestamp_micros((F.col("s") * 1_000_000).cast("long"))
    return df.select("sensor_id", time.alias("time"), "pm25", F.lit(None).cast("double").alias("no2"))


def as_dict(df, key, *values):
    return {r[key]: tuple(r[v] for v in values) for r in df.collect()}


# --- numbers and report averages ---------------------------------------------------------------


def test_malformed_number_becomes_null(spark):
    out = typed(raw(spark, [(1, "A", "2026-02-01T12:16:08.000", "abc", "1.5")])).first()
    assert out.pm25 is None and out.no2 == 1.5


def test_unparseable_only(spark):
    rows = raw(spark, [(1, "A", "2026-02-01T12:16:08.000", "abc", "")])
    assert as_dict(agg.sensor_averages(rows), "sensor_id", "pm25_avg", "pm25_count", "no2_avg", "no2_count") == {"A": (0.0, 0, 0.0, 0)}
    assert agg.per_sensor_summary(typed(rows)).first().pm25_avg is None


def test_no_measures(spark):
    rows = raw(spark, [(1, "A", "2026-02-01T12:16:08.000", "", "")])
    assert agg.sensor_averages(rows).count() == 0
    summary = agg.per_sensor_summary(typed(rows)).first()
    assert (summary.pm25_avg, summary.pm25_count, summary.no2_max, summary.no2_count) == (None, 0, None, 0)


def test_empty_id_and_time_are_dropped_from_reports(spark):
    rows = raw(spark, [(1, "", "2026-02-01T12:16:08.000", "1", ""), (2, "A", "", "3", ""), (3, "A", "2026-02", "5", "")])
    assert as_dict(agg.sensor_averages(rows), "sensor_id", "pm25_avg") == {"A": (4.0,)}
    assert as_dict(agg.daily_measures(rows), "date", "pm25_avg") == {"2026-02-01": (1.0,), "2026-02": (5.0,)}
    assert as_dict(agg.hourly_averages(rows), "hour", "pm25_avg") == {"2026-02-01T12": (1.0,)}


def test_null_date_group(spark):
    rows = typed(raw(spark, [(1, "A", "zzz", "1", ""), (2, "A", "2026-02-01T12:16:08.000", "3", "")]))
    daily = as_dict(agg.daily_averages(rows), "date", "pm25_avg", "records")
    assert daily.pop(None) == (1.0, 1) and len(daily) == 1
    assert agg.daily_measures(rows).count() == 1


def test_report_lines(spark):
    rows = raw(spark, [(1, "B", "2026-02-01T12:16:08.000", "1", "x"), (2, "A", "2026-02-01T12:16:08.000", "0.0625", "7")])
    lines = [r.value for r in agg.averages_report(agg.sensor_averages(rows), "sensor_id").collect()]
    assert lines == [
        "A\tpm25_avg=0.063, pm25_count=1, no2_avg=7.000, no2_count=1",
        "B\tpm25_avg=1.000, pm25_count=1, no2_avg=0.000, no2_count=0",
    ]


# --- exceedances -------------------------------------------------------------------------------


def test_exceedances(spark):
    rows = measured(
        spark,
        [("nan", NAN, None), ("nan", 40.0, None), ("equal", 35.4, 100.0), ("low", 1.0, 1.0), ("both", 36.0, 101.0), ("", 99.0, 999.0)],
    )
    out = as_dict(agg.sensor_exceedances(rows), "sensor_id", "pm25_exceedances", "no2_exceedances")
    assert out == {"nan": (1, 0), "both": (1, 1)}
    lines = [r.value for r in agg.exceedances_report(agg.sensor_exceedances(rows)).collect()]
    assert lines == ["both\tpm25_exceedances=1, no2_exceedances=1", "nan\tpm25_exceedances=1, no2_exceedances=0"]


def test_exceedances_on_text(spark):
    rows = raw(spark, [(1, "A", "t", "36", "NaN"), (2, "A", "t", "abc", "200"), (3, "B", "t", "", "")])
    out = as_dict(agg.sensor_exceedances(rows), "sensor_id", "pm25_exceedances", "no2_exceedances")
    assert out == {"A": (1, 1)}


# --- anomalies ---------------------------------------------------------------------------------

BASE = [("s", float(v), 10.0) for v in (1, 2, 3, 2, 1, 2, 3, 2, 1, 2)]


@pytest.mark.parametrize("rows", [[("A", 5.0, 5.0)], [("A", 4.0, 4.0)] * 5])
def test_no_deviation_flags_nothing(spark, rows):
    assert anomalies(measured(spark, rows)).count() == 0


def test_nan_disables_only_its_measure(spark):
    rows = [(s, v, NAN if i == 0 else n) for i, (s, v, n) in enumerate(BASE)] + [("hot", 50.0, 9000.0)]
    assert [r.sensor_id for r in anomalies(measured(spark, rows)).collect()] == ["hot"]
    assert anomalies(measured(spark, [("x", NAN, 1.0)] + BASE + [("hot", 50.0, None)])).count() == 0


def test_one_measure_fires_and_low_side_does_not(spark):
    rows = BASE + [("high", 50.0, None), ("low", -20.0, 10.0)]
    assert [(r.sensor_id, r.no2) for r in anomalies(measured(spark, rows)).collect()] == [("high", None)]


def test_single_value_std_is_zero_in_stats(spark):
    stats = agg.global_stats(measured(spark, [("A", 5.0, None)])).first()
    assert (stats.pm25_mean, stats.pm25_std, stats.no2_mean, stats.no2_std) == (5.0, 0.0, 0.0, 0.0)


# --- rolling averages --------------------------------------------------------------------------

FRAMES = {
    "edge": ([("A", 0.0, 1.0), ("A", 86400.0, 3.0), ("A", 86401.0, 5.0), ("A", 86401.0, 7.0)], [1.0, 2.0, 5.0, 5.0]),
    "peers": ([("A", 10.1, 1.0), ("A", 10.9, 3.0), ("A", 11.0, 5.0)], [2.0, 2.0, 3.0]),
    "no time": ([("A", None, 1.0), ("A", None, 3.0), ("A", 10.0, 5.0)], [2.0, 2.0, 5.0]),
    "sensors apart": ([("A", 1.0, 1.0), ("B", 2.0, 3.0), (None, 2.0, 9.0), (None, 3.0, 11.0)], [1.0, 3.0, 9.0, 10.0]),
    "before epoch": ([("A", -86400.0, 1.0), ("A", 0.0, 3.0), ("A", 1.0, 5.0)], [1.0, 2.0, 4.0]),
    "missing": ([("A", 1.0, None), ("A", 2.0, 4.0), ("A", 3.0, None)], [None, 4.0, 4.0]),
}
WAYS = {"half days": {}, "hours": {"slices": 24}, "days": {"slices": 1}, "seconds": {"slices": 86_400}}


@pytest.mark.parametrize("way", WAYS)
@pytest.mark.parametrize("case", FRAMES)
def test_frames(spark, case, way):
    rows, expected = FRAMES[case]
    out = trailing_averages(timed(spark, rows).withColumn("i", F.monotonically_increasing_id()), ("pm25",), **WAYS[way])
    assert [r.rolling_pm25 for r in out.orderBy("i").collect()] == expected


def test_rolling_columns(spark):
    assert rolling_24h(timed(spark, [("A", 1.0, 1.0)])).columns == ["sensor_id", "time", "rolling_pm25_24h", "rolling_no2_24h"]


# --- keyed table -------------------------------------------------------------------------------


def test_row_key_replaces_every_colon(spark):
    key = spark.range(1).select(row_key(F.lit("A:B"), F.lit("2026-02-01T12:16:08.000")).alias("k")).first().k
    assert key == "A_B_2026-02-01T12_16_08.000"


def test_cell_level_upsert(spark):
    schema = "ingest_seq long, rowkey string, pm25 string, no2 string"
    first = spark.createDataFrame([(1, "k", "1", "2"), (2, "j", None, "9")], schema)
    second = spark.createDataFrame([(3, "k", "3", None), (4, "l", "8", None)], schema)
    cells = ["pm25", "no2"]
    one_pass = keyed.reduce_batch(first.union(second), cells)
    stored = keyed.reduce_batch(first, cells)
    merged = keyed.upsert(stored, keyed.reduce_batch(second, cells), cells)
    again = keyed.upsert(merged, keyed.reduce_batch(second, cells), cells)
    expected = {"k": ("3", "2"), "j": (None, "9"), "l": ("8", None)}
    for table in (one_pass, merged, again):
        assert as_dict(table, "rowkey", *cells) == expected
        assert table.count() == 3


def limit_batch(spark):
    rows = [(i, "" if i % 3 == 0 else "A", f"2026-02-01T00:00:{i:02d}.000", "1", "") for i in range(40)]
    return keyed.to_cells(raw(spark, rows)).repartition(7)


@pytest.mark.parametrize("n", [0, 1, 2, 5, 6, 7, 26, 27, 100])
def test_ingest_limit_counts_accepted_rows(spark, n):
    batch = limit_batch(spark)
    out = keyed.first_accepted(batch, n, F.floor(F.col("ingest_seq") / 4), F.col("ingest_seq"))
    accepted = [i for i in range(40) if i % 3]
    assert sorted(r.ingest_seq for r in out.collect()) == accepted[:n]


def table(spark, ids):
    rows = [(i, s, f"2026-02-0{1 + i % 2}T12:16:08.00{i}", str(i), "") for i, s in enumerate(ids)]
    return keyed.to_cells(raw(spark, rows)).drop("ingest_seq")


def test_prefix_collision(spark):
    cells = table(spark, ["A", "A", "A_B"])
    assert keyed.latest_for_sensor(cells, "A").first().pm25 == "1"
    assert as_dict(keyed.latest_per_sensor(cells), "datasourceid", "pm25") == {"A": ("1",), "A_B": ("2",)}
    assert keyed.prefix_scan(cells, "A_").count() == 3
    assert keyed.latest_for_sensor(cells, "Z").count() == 0


def test_export_lines(spark):
    row = spark.createDataFrame(
        [("K_2026-02-01T12_16_08.000", "41.6", "-87.5", "POINT (-87.5 41.6)", 'the "old" pier', "K", "2026-02-01T12:16:08.000")],
        "rowkey string, lat string, lon string, location string, sensor_name string, datasourceid string, time string",
    )
    absent = [F.lit(None).cast("string").alias(c) for c in ("pm25", "no2", "humidity", "temp")]
    cells = row.select("*", *absent)
    assert [r.value for r in keyed.export_lines(keyed.export_day(cells, "2026-02-01")).collect()] == [
        'K_2026-02-01T12_16_08.000,,,,,41.6,-87.5,"POINT (-87.5 41.6)","the \'old\' pier",K,"2026-02-01T12:16:08.000"'
    ]
    assert keyed.export_day(cells, "2026-02-02").count() == 0
    assert keyed.export_day(cells, "").count() == 1
    bare = cells.withColumn("location", F.lit(None).cast("string")).withColumn("sensor_name", F.lit(None).cast("string"))
    assert ',"","",K,' in keyed.export_lines(bare).first().value


def test_families(spark):
    row = keyed.by_family(table(spark, ["A"])).first()
    assert row.m.pm25 == "0" and row.m.no2 is None and row.meta.datasourceid == "A" and row.g.lat is None


# --- presentation ------------------------------------------------------------------------------


def test_top_sensors_missing_average(spark):
    summary = agg.per_sensor_summary(measured(spark, [("neg", -1.0, None), ("none", None, 1.0), ("pos", 2.0, None)]))
    assert [r.sensor_id for r in serving.top_sensors(summary).collect()] == ["pos", "none", "neg"]
    assert [r.sensor_id for r in serving.top_sensors(summary, null_as_zero=False).collect()] == ["pos", "neg", "none"]
    assert serving.top_sensors(summary, 1).count() == 1


def test_display_and_json(spark):
    df = spark.createDataFrame([("a\"b\\c", 0.005, None), ("z", 2.0, 1)], "name string, v double, n int")
    assert [r.v for r in serving.display_rows(df).collect()] == [0.01, 2.0]
    assert serving.json_rows(df, "name", n=1).first().json == '{"name":"a\\"b\\\\c","v":"0.005","n":""}'


def test_rolling_value_falls_back(spark):
    df = spark.createDataFrame([(1.0, 2.0)], "pm25 double, rolling_pm25 double")
    assert df.select(serving.rolling_value(df).alias("v")).first().v == 2.0
    assert df.drop("rolling_pm25").select(serving.rolling_value(df.drop("rolling_pm25")).alias("v")).first().v == 1.0


def test_anomaly_points_drop_unknown_time(spark):
    df = measured(spark, [("A", 1.0, None)])
    assert serving.anomaly_points(df.union(df.withColumn("time", F.lit(None).cast("timestamp")))).count() == 1


def test_nan_average_is_kept(spark):
    assert math.isnan(agg.per_sensor_summary(measured(spark, [("A", NAN, 1.0), ("A", 1.0, 1.0)])).first().pm25_avg)


# --- line splitting ----------------------------------------------------------------------------


def toggled(line):
    fields, field, inside = [], "", False
    for c in line:
        if c == '"':
            inside = not inside
        elif c == "," and not inside:
            fields.append(field)
            field = ""
        else:
            field += c
    return fields + [field]


def test_split_line(spark):
    lines = ["", ",", "a,b", '"a,b",c', '"a","b,"', 'x"y,z"w,', '"open,a', 'a,"b""c",d', '"a"",b"', '""""', 'ä,"ö,ü",\t']
    lines += ['"1",' * 50_000, '"1,",' * 50_000]
    got = spark.createDataFrame([(x,) for x in lines], "v string").select("v", split_line(F.col("v")).alias("f")).collect()
    assert [r.f == toggled(r.v) for r in got] == [True] * len(lines)


def test_split_line_on_random_text(spark):
    import random

    pick = random.Random(5)
    lines = ["".join(pick.choice('a,"" ') for _ in range(pick.randint(0, 25))) for _ in range(3000)]
    got = spark.createDataFrame([(x,) for x in lines], "v string").select("v", split_line(F.col("v")).alias("f")).collect()
    assert all(r.f == toggled(r.v) for r in got)


def test_report_renders_nan(spark):
    rows = raw(spark, [(1, "A", "2026-02-01T12:16:08.000", "NaN", ""), (2, "A", "2026-02-01T12:16:08.000", "1", "2.0005")])
    (line,) = agg.averages_report(agg.sensor_averages(rows), "sensor_id").collect()
    assert line.value == "A\tpm25_avg=NaN, pm25_count=2, no2_avg=2.001, no2_count=1"


def test_special_numbers_in_reports(spark):
    texts = ["inf", "-INF", "nan", "infinity", "Infinity", "-Infinity", "NaN", "1e999", " 7 ", "x"]
    rows = raw(spark, [(i, f"{i}", "t", text, "") for i, text in enumerate(texts)])
    counted = as_dict(agg.sensor_averages(rows), "sensor_id", "pm25_count")
    assert [counted[str(i)][0] for i in range(len(texts))] == [0, 0, 0, 0, 1, 1, 1, 1, 1, 0]
    above = as_dict(agg.sensor_exceedances(rows), "sensor_id", "pm25_exceedances")
    assert above == {"4": (1,), "7": (1,)}
