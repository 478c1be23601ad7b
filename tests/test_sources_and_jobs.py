"""Scans of raw files, written results, the stored keyed table and whole jobs."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from gaugeworks.operators import aggregates as agg
from gaugeworks.operators import keyed, serving, stored
from gaugeworks.plans import jobs
from gaugeworks.session import fresh_folder, shared_folder
from gaugeworks.sources.readings import FIELD_POSITIONS, HEADERS, scan_block, scan_by_header, scan_positional, typed
from gaugeworks.sources.results import read_csv, read_result, write_csv


def line(width=43, **fields):
    """A raw line; fields are written as given."""
    cells = [""] * width
    for name, text in fields.items():
        cells[FIELD_POSITIONS[name]] = text
    return ",".join(cells)


def header(quote='"'):
    named = {FIELD_POSITIONS[name]: text for name, text in HEADERS.items()}
    return ",".join(f"{quote}{named.get(i, f'field{i}')}{quote}" for i in range(43))


def reading(sensor, time, pm25="", no2="", **more):
    return line(sensor_id=f'"{sensor}"', time=f'"{time}"', pm25=pm25, no2=no2, **more)


def save(path, lines):
    path.write_text("\n".join(lines) + "\n")
    return str(path)


def part_lines(folder):
    return [open(p).read().splitlines() for p in sorted(glob.glob(f"{folder}/part-*"))]


# --- scans -------------------------------------------------------------------------------------


def test_positional_scan(spark, tmp_path):
    path = save(
        tmp_path / "r.csv",
        [
            header(),
            line(sensor_id="short", time="t", width=42),
            line(sensor_id="exact", time="t", pm25="1.50"),
            line(sensor_id="long", time="t", width=50, no2="7"),
            line(sensor_id=" \tpadded\t ", time="t", sensor_name='"a, b"', location='"POINT (1 2)"'),
            header(),
            line(sensor_id="escaped", time="t", sensor_name='"x ""y"" z"'),
            line(sensor_id='mid"dle, x"', time="t", pm25=" abc "),
            "",
        ],
    )
    rows = {r.sensor_id: r for r in scan_positional(spark, path).collect()}
    assert list(rows) == ["exact", "long", "padded", "escaped", "middle, x"]
    assert (rows["exact"].pm25, rows["exact"].no2, rows["long"].no2) == ("1.50", "", "7")
    assert (rows["padded"].sensor_name, rows["padded"].location) == ("a, b", "POINT (1 2)")
    assert rows["escaped"].sensor_name == "x y z"
    assert rows["middle, x"].pm25 == "abc"


def test_unbalanced_quote_swallows_the_rest(spark, tmp_path):
    path = save(tmp_path / "r.csv", [line(sensor_id="A", time="t"), line(sensor_id='"B', time="t"), line(sensor_id="C", time="t")])
    assert [r.sensor_id for r in scan_positional(spark, path).collect()] == ["A", "C"]


def test_ingest_order_is_file_order(spark, tmp_path):
    rows = [reading(f"S{i}", "2026-02-01T00:00:00.000", str(i)) for i in range(3000)]
    path = save(tmp_path / "r.csv", [header(), *rows])
    with_blocks = spark.newSession()
    with_blocks.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    scan = scan_positional(with_blocks, path)
    assert scan.select(scan_block(F.col("ingest_seq"))).distinct().count() > 3
    assert [r.pm25 for r in scan.repartition(5).orderBy("ingest_seq").collect()] == [str(i) for i in range(3000)]
    seq = F.col("ingest_seq")
    for n in (1, 700, 2999, 3000, 9999):
        kept = keyed.first_accepted(scan, n, scan_block(seq), seq)
        assert sorted(int(r.pm25) for r in kept.collect()) == list(range(min(n, 3000)))


def test_header_scan(spark, tmp_path):
    path = save(
        tmp_path / "r.csv",
        [
            header(),
            reading("A", "2026-02-01T12:16:08.000", "1.5", "abc"),
            header(),
            reading("B", "zzz", "", "2"),
            line(time='"2026-02-01T12:16:08.000"', pm25="4"),
            line(sensor_id='"x ""y"", z"', no2="5"),
        ],
    )
    df = scan_by_header(spark, path)
    assert df.dtypes == [("sensor_id", "string"), ("time", "timestamp_ntz"), ("pm25", "double"), ("no2", "double")]
    rows = {r.sensor_id: (r.time is not None, r.pm25, r.no2) for r in df.collect()}
    assert rows == {"A": (True, 1.5, None), "B": (False, None, 2.0), None: (True, 4.0, None), 'x "y", z': (False, None, 5.0)}


def test_header_scan_reads_only_the_used_columns(spark, tmp_path):
    path = save(tmp_path / "r.csv", [header(), reading("A", "2026-02-01T12:16:08.000", "1.5")])
    plan = agg.global_stats(scan_by_header(spark, path))._jdf.queryExecution().toString()
    assert "ReadSchema: struct<datasourceid:string,no2concindividual_value:string,pm2_5concmassindividual_value:string>" in plan


# --- results -----------------------------------------------------------------------------------


def test_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("a", 1.5, None), ('b,"c"', None, 2)], "name string, v double, n long")
    for single in (False, True):
        write_csv(df, str(tmp_path / "out"), single)
        back = {r.name: (r.v, r.n) for r in read_csv(spark, str(tmp_path / "out")).collect()}
        assert back == {"a": ("1.5", None), 'b,"c"': (None, "2")}
    assert len(part_lines(tmp_path / "out")) == 1


# --- jobs --------------------------------------------------------------------------------------

DATA = [
    reading("A", "2026-02-01T10:00:00.000", "10", "1", sensor_name='"Pier ""9"""', location='"POINT (1 2)"'),
    reading("A", "2026-02-01T10:30:00.000", "50.25", "150"),
    reading("B", "2026-02-02T11:00:00.000", "bad", ""),
    reading("B", "2026-02-02T12:00:00.000", "20", ""),
    reading("C", "2026-02-03T00:00:00.000", "", ""),
    reading("", "2026-02-03T00:00:00.000", "40", ""),
]


@pytest.fixture
def source(tmp_path):
    return save(tmp_path / "readings.csv", [header(), *DATA])


def test_report_jobs(spark, source, tmp_path):
    expected = {
        jobs.sensor_averages_job: [
            "A\tpm25_avg=30.125, pm25_count=2, no2_avg=75.500, no2_count=2",
            "B\tpm25_avg=20.000, pm25_count=1, no2_avg=0.000, no2_count=0",
        ],
        jobs.daily_averages_job: [
            "2026-02-01\tpm25_avg=30.125, pm25_count=2, no2_avg=75.500, no2_count=2",
            "2026-02-02\tpm25_avg=20.000, pm25_count=1, no2_avg=0.000, no2_count=0",
            "2026-02-03\tpm25_avg=40.000, pm25_count=1, no2_avg=0.000, no2_count=0",
        ],
        jobs.hourly_averages_job: [
            "2026-02-01T10\tpm25_avg=30.125, pm25_count=2, no2_avg=75.500, no2_count=2",
            "2026-02-02T11\tpm25_avg=0.000, pm25_count=0, no2_avg=0.000, no2_count=0",
            "2026-02-02T12\tpm25_avg=20.000, pm25_count=1, no2_avg=0.000, no2_count=0",
            "2026-02-03T00\tpm25_avg=40.000, pm25_count=1, no2_avg=0.000, no2_count=0",
        ],
        jobs.exceedances_job: ["A\tpm25_exceedances=1, no2_exceedances=1"],
    }
    for job, lines in expected.items():
        out = str(tmp_path / job.__name__)
        job(spark, source, out)
        assert [text for part in part_lines(out) for text in part] == lines
        with pytest.raises(Exception, match="already exists"):
            job(spark, source, out)


def test_exceedance_thresholds_are_arguments(spark, source, tmp_path):
    jobs.exceedances_job(spark, source, str(tmp_path / "out"), pm25_threshold=15, no2_threshold=1000)
    lines = [text for part in part_lines(tmp_path / "out") for text in part]
    assert lines == ["A\tpm25_exceedances=1, no2_exceedances=0", "B\tpm25_exceedances=1, no2_exceedances=0"]


def test_summary_job(spark, source, tmp_path, capsys):
    out = str(tmp_path / "out")
    jobs.summary_job(spark, source, out, single_file=True)
    (per_sensor,) = part_lines(f"{out}/per_sensor")
    assert per_sensor == [
        "datasourceid,pm25_avg,pm25_min,pm25_max,pm25_count,no2_avg,no2_min,no2_max,no2_count",
        ",40.0,40.0,40.0,1,,,,0",
        "A,30.125,10.0,50.25,2,75.5,1.0,150.0,2",
        "B,20.0,20.0,20.0,1,,,,0",
        "C,,,,0,,,,0",
    ]
    (daily,) = part_lines(f"{out}/daily")
    assert daily == ["date,pm25_avg,no2_avg,records", "2026-02-01,30.125,75.5,2", "2026-02-02,20.0,,2", "2026-02-03,40.0,,2"]
    assert os.path.isdir(f"{out}/anomalies")
    jobs.summary_job(spark, source, out, show=True)  # overwrites
    assert "|2026-02-01|30.125" in capsys.readouterr().out


def test_rolling_job(spark, source, tmp_path):
    out = str(tmp_path / "out")
    jobs.rolling_job(spark, source, out, single_file=True)
    (lines,) = part_lines(out)
    assert lines[0] == "datasourceid,time,rolling_pm25_24h,rolling_no2_24h"
    assert len(lines) == 1 + len(DATA) and "A,2026-02-01T10:30:00.000Z,30.125,75.5" in lines


def test_keyed_table_jobs(spark, source, tmp_path, capsys):
    table = str(tmp_path / "table")
    jobs.ingest_job(spark, source, table, limit=2)
    assert stored.read_table(spark, table).count() == 2
    jobs.ingest_job(spark, source, table)
    jobs.ingest_job(spark, source, table)
    rows = stored.read_table(spark, table)
    assert rows.count() == 5
    untouched = stored.current_days(spark, table)["2026-02-02"]

    update = save(tmp_path / "update.csv", [header(), reading("A", "2026-02-01T10:00:00.000", "", "9"), reading("D", "odd time", "1")])
    jobs.ingest_job(spark, update, table)
    rows = stored.read_table(spark, table)
    assert rows.count() == 6
    assert stored.current_days(spark, table)["2026-02-02"] == untouched
    row = rows.filter("rowkey = 'A_2026-02-01T10_00_00.000'").first()
    assert (row.pm25, row.no2, row.sensor_name) == ("10", "9", "Pier 9")
    assert [r.rowkey for r in stored.prefix_scan(spark, table, "D_").collect()] == ["D_odd time"]

    jobs.count_job(spark, table)
    assert "6" in capsys.readouterr().out
    jobs.latest_job(spark, table, "A")
    assert "50.25" in capsys.readouterr().out

    out = str(tmp_path / "export")
    jobs.export_day_job(spark, table, "2026-02-01", out, single_file=True)
    (lines,) = part_lines(out)
    assert lines == [
        "rowkey,pm25,no2,humidity,temp,lat,lon,location,sensor_name,datasourceid,time",
        'A_2026-02-01T10_00_00.000,10,9,,,,,"POINT (1 2)","Pier 9",A,"2026-02-01T10:00:00.000"',
        'A_2026-02-01T10_30_00.000,50.25,150,,,,,"","",A,"2026-02-01T10:30:00.000"',
    ]


def test_ingest_limit(spark, source, tmp_path):
    for limit, rows in ((1, 1), (2, 2), (4, 4), (99, 5)):
        table = str(tmp_path / f"table{limit}")
        jobs.ingest_job(spark, source, table, limit)
        kept = sorted(r.rowkey for r in stored.read_table(spark, table).collect())
        keys = ["A_2026-02-01T10_00", "A_2026-02-01T10_30", "B_2026-02-02T11_00", "B_2026-02-02T12_00", "C_2026-02-03T00_00"]
        assert kept == [f"{key}_00.000" for key in keys[:rows]]


def test_merge_can_be_repeated(spark, source, tmp_path):
    table = str(tmp_path / "table")
    jobs.ingest_job(spark, source, table)
    update = save(tmp_path / "update.csv", [header(), reading("A", "2026-02-01T10:00:00.000", "", "9")])
    jobs.ingest_job(spark, update, table)
    before = sorted(map(str, stored.read_table(spark, table).collect()))
    jobs.ingest_job(spark, update, table)
    assert sorted(map(str, stored.read_table(spark, table).collect())) == before


def test_a_key_stays_one_row_whatever_day_its_time_shows(spark, tmp_path):
    """The id may show the day, or the time, or both, or neither; equal keys are one row, and none is left behind."""
    batches = [[("a_b", "2026-02-01")], [("a", "b_2026-02-01")], [("x_2026-02-01", "2026-03-01")], [("x", "2026-02-01_2026-03-01")], [("q", "r"), ("a_b", "2026-02-02")]]
    table = str(tmp_path / "table")
    for k, rows in enumerate(batches):
        path = save(tmp_path / f"{k}.csv", [header(), *(line(sensor_id=i, time=t, pm25=str(k)) for i, t in rows)])
        jobs.ingest_job(spark, path, table)
    rows = {r.rowkey: (r.pm25, r.day) for r in stored.read_table(spark, table).collect()}
    assert rows == {
        "a_b_2026-02-01": ("1", "2026-02-01"),
        "x_2026-02-01_2026-03-01": ("3", keyed.OTHER_DAY),
        "q_r": ("4", keyed.OTHER_DAY),
        "a_b_2026-02-02": ("4", "2026-02-02"),
    }
    assert stored.read_table(spark, table).count() == 4
    whole = stored.read_table(spark, table)
    for day in ("2026-02-01", "2026-02", "r", "2026-02-01_"):
        expected = sorted(r.rowkey for r in whole.drop("day").collect() if r.time.startswith(day))
        assert [r.rowkey for r in keyed.export_day(whole, day).collect()] == expected


def test_a_folder_is_ingested_in_the_order_of_its_files(spark, tmp_path):
    (tmp_path / "in").mkdir()
    time = "2026-02-01T10:00:00.000"
    save(tmp_path / "in/1.csv", [header(), reading("A", time, "old")])
    save(tmp_path / "in/2.csv", [header(), *(reading(f"S{i}", time, "1") for i in range(5000)), reading("A", time, "new")])
    save(tmp_path / "in/3.csv", [header(), reading("B", time, "1")])
    for limit, value in ((None, "new"), (1, "old"), (5001, "old"), (5002, "new")):
        table = str(tmp_path / f"table{limit}")
        jobs.ingest_job(spark, str(tmp_path / "in"), table, limit)
        rows = stored.read_table(spark, table)
        assert rows.filter("datasourceid = 'A'").first().pm25 == value
        assert limit is None or rows.count() == limit - (limit == 5002)


def test_parts_of_an_unsplit_file_are_bounded(spark, tmp_path, monkeypatch):
    import gzip

    from gaugeworks.sources import readings as sources

    monkeypatch.setattr(sources, "BLOCK_BITS", 4)
    path = tmp_path / "r.csv.gz"
    path.write_bytes(gzip.compress("\n".join([header(), *(reading(f"S{i}", "2026-02-01T00:00:00.000", str(i)) for i in range(500))]).encode()))
    scan = scan_positional(spark, str(path))
    seq = F.col("ingest_seq")
    assert scan.groupBy(scan_block(seq).alias("b")).count().agg(F.max("count")).first()[0] == 16
    assert sorted(int(r.pm25) for r in keyed.first_accepted(scan, 333, scan_block(seq), seq).collect()) == list(range(333))


def test_stored_table_scan_is_pruned_and_pushed(spark, source, tmp_path):
    table = str(tmp_path / "table")
    jobs.ingest_job(spark, source, table)
    rows = stored.read_table(spark, table)
    prefix = keyed.prefix_scan(rows, "A_")._jdf.queryExecution().toString()
    assert "StringStartsWith(rowkey,A_)" in prefix
    day = keyed.export_day(rows, "2026-02-01")._jdf.queryExecution().toString()
    assert "PartitionFilters: [day" in day and "IN (2026-02-01,other)" in day.replace("#", " ").replace("  ", " ")
    assert len(keyed.export_day(rows, "2026-02-01").inputFiles()) >= 1


def test_presentation_from_result_directories(spark, source, tmp_path):
    out = str(tmp_path / "out")
    jobs.summary_job(spark, source, f"{out}/spark")
    jobs.rolling_job(spark, source, f"{out}/rolling")
    summary = read_result(spark, f"{out}/spark/per_sensor")
    assert [r.sensor_id for r in serving.top_sensors(summary, 3).collect()] == [None, "A", "B"]
    daily = read_result(spark, f"{out}/spark/daily")
    assert [(str(r.date), r.pm25_avg) for r in serving.daily_points(daily).collect()][0] == ("2026-02-01", 30.125)
    rolled = read_result(spark, f"{out}/rolling")
    assert dict(rolled.dtypes)["time"] == "timestamp_ntz" and rolled.filter("sensor_id = 'A'").count() == 2
    assert rolled.select(serving.rolling_value(rolled).alias("v")).agg(F.max("v")).first()[0] == 40.0

    save(tmp_path / "odd.csv", ["datasourceid,time,pm25,no2", "A,2026-02-01T10:00:00.000Z,1.5,", "A,never,x,"])
    points = serving.anomaly_points(read_result(spark, str(tmp_path / "odd.csv"))).collect()
    assert [(r.sensor_id, r.pm25) for r in points] == [("A", 1.5)]


def test_served_rows_from_a_result_directory(spark, source, tmp_path):
    out = str(tmp_path / "out")
    jobs.summary_job(spark, source, out)
    rows = serving.json_rows(read_csv(spark, f"{out}/daily"), "date", n=1).collect()
    assert rows[0].json == '{"date":"2026-02-01","pm25_avg":"30.125","no2_avg":"75.5","records":"2"}'


def test_command_line(spark, source, tmp_path, capsys):
    table = str(tmp_path / "table")
    jobs.main(["ingest", source, table, "--limit", "3"])
    jobs.main(["count", table])
    assert "3" in capsys.readouterr().out


def test_typed_keeps_ingest_order(spark, source):
    assert typed(scan_positional(spark, source)).select("ingest_seq").distinct().count() == 6


def test_intermediate_tables_go_to_the_named_folder(spark, source, tmp_path, monkeypatch):
    class Named:
        """A session whose cluster names a folder (the setting is fixed once Spark runs)."""

        conf = {"spark.checkpoint.dir": f"{tmp_path}/shared/"}

    assert shared_folder(Named, "/any/out") == f"{tmp_path}/shared"
    class Unnamed:
        conf = {"spark.master": "local[2]"}

    class Cluster:
        conf = {"spark.master": "yarn"}

    assert shared_folder(Unnamed, "/any/out/") == "/any/out_staged"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(Cluster, "/any/out")
    used = []
    monkeypatch.setattr(jobs, "fresh_folder", lambda session, near: used.append(near) or fresh_folder(Named, near))
    jobs.summary_job(spark, source, str(tmp_path / "out"))
    jobs.ingest_job(spark, source, str(tmp_path / "table"))
    jobs.ingest_job(spark, source, str(tmp_path / "table"))
    assert len(used) == 2 and os.listdir(tmp_path / "shared") == []
    assert not os.path.exists(tmp_path / "out_staged") and not os.path.exists(tmp_path / "table_staged")
