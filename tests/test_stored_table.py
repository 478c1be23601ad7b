"""The stored table: merges that stop midway, what lookups open, and counts from footers."""

import os
import shutil

import pytest
from pyspark.sql import functions as F
from test_sources_and_jobs import header, reading, save

from gaugeworks.operators import keyed, stored
from gaugeworks.plans import jobs

DAYS = [f"2026-02-0{d}" for d in range(1, 6)]


def cells(spark, rows):
    """Reduced cells of (sensor, time, pm25, no2)."""
    raw = spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], "ingest_seq long, sensor_id string, time string, pm25 string, no2 string")
    return keyed.reduce_batch(keyed.to_cells(raw), list(keyed.CELLS))


def content(spark, path):
    return {r.rowkey: (r.pm25, r.no2) for r in stored.read_table(spark, path).collect()}


FIRST = [("A", f"{d}T10:00", str(k), "") for k, d in enumerate(DAYS)] + [("B", f"{DAYS[2]}T11:00", "7", ""), ("odd", "never", "1", "")]
SECOND = [("A", f"{d}T10:00", "", "9") for d in DAYS[1:4]] + [("C", f"{DAYS[1]}T00:00", "5", "5"), ("odd", "never", "", "2")]
BEFORE = {f"{s}_{t.replace(':', '_')}": (p, None) for s, t, p, _ in FIRST}
AFTER = BEFORE | {f"A_{d}T10_00": (str(k), "9") for k, d in enumerate(DAYS) if 1 <= k <= 3} | {f"C_{DAYS[1]}T00_00": ("5", "5"), "odd_never": ("1", "2")}


@pytest.fixture
def table(spark, tmp_path):
    path = str(tmp_path / "table")
    stored.write_table(cells(spark, FIRST), path)
    assert content(spark, path) == BEFORE
    return path


def merge(spark, path):
    stored.merge_into_table(spark, path, cells(spark, SECOND))


def test_a_merge_rewrites_only_its_days(spark, table):
    merge(spark, table)
    assert content(spark, table) == AFTER
    assert stored.current_days(spark, table) == {DAYS[0]: 1, DAYS[1]: 2, DAYS[2]: 2, DAYS[3]: 2, DAYS[4]: 1, keyed.OTHER_DAY: 2}
    assert sorted(d for d in os.listdir(f"{table}/gen=1") if d.startswith("day=")) == [f"day={DAYS[0]}", f"day={DAYS[4]}"]
    merge(spark, table)
    assert content(spark, table) == AFTER


def test_a_table_is_not_overwritten(spark, table):
    with pytest.raises(ValueError, match="there is a table"):
        stored.write_table(cells(spark, SECOND), table)
    assert content(spark, table) == BEFORE


@pytest.mark.parametrize("days_there", [0, 1, 2, 3])
def test_stopped_while_days_are_put_in_place(spark, table, tmp_path, days_there):
    """Spark's commit moves day after day and marks the folder last."""
    whole = str(tmp_path / "whole")
    shutil.copytree(table, whole)
    merge(spark, whole)
    os.makedirs(f"{table}/gen=2")
    for name in sorted(n for n in os.listdir(f"{whole}/gen=2") if n.startswith("day="))[:days_there]:
        shutil.copytree(f"{whole}/gen=2/{name}", f"{table}/gen=2/{name}")
    assert content(spark, table) == BEFORE
    merge(spark, table)
    assert content(spark, table) == AFTER


@pytest.mark.parametrize("removed", [0, 1, 2])
def test_stopped_while_old_days_are_removed(spark, table, monkeypatch, removed):
    calls = []

    def stop(spark, path):
        if "/day=" in path:
            calls.append(path)
            if len(calls) > removed:
                raise OSError("the driver dies here")
        shutil.rmtree(path.removeprefix("file:"), ignore_errors=True)

    with monkeypatch.context() as patch:
        patch.setattr(stored, "remove_folder", stop)
        with pytest.raises(OSError, match="dies"):
            merge(spark, table)
    assert content(spark, table) == AFTER
    merge(spark, table)
    assert content(spark, table) == AFTER
    assert set(stored._generations(spark, table)) == {1, 3}


def test_stopped_before_the_guide(spark, table, monkeypatch):
    with monkeypatch.context() as patch:
        patch.setattr(stored, "_guide_missing", lambda spark, path: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            merge(spark, table)
    assert content(spark, table) == AFTER
    lookups(spark, table)
    stored.merge_into_table(spark, table, cells(spark, [("B", f"{DAYS[2]}T11:00", "7", "")]))
    lookups(spark, table)
    assert not set(stored.current_days(spark, table).values()) - set(stored._generations(spark, table, "/_sensors"))


def lookups(spark, table):
    """All lookups against the whole table."""
    rows = stored.read_table(spark, table)
    for sensor in ("A", "C", "none"):
        expected = [tuple(r) for r in keyed.latest_for_sensor(rows, sensor).collect()]
        assert [tuple(r) for r in stored.latest_for_sensor(spark, table, sensor).collect()] == expected
    for prefix in ("A_2026-02-03", "", "zzz"):
        expected = sorted(map(tuple, keyed.prefix_scan(rows, prefix).collect()))
        assert sorted(map(tuple, stored.prefix_scan(spark, table, prefix).collect())) == expected
    expected = sorted(map(str, keyed.latest_per_sensor(rows).collect()))
    assert sorted(map(str, stored.latest_per_sensor(spark, table).select(rows.columns).collect())) == expected
    assert stored.count_rows(spark, table).first().row_count == rows.count()


def test_lookups(spark, table):
    lookups(spark, table)
    merge(spark, table)
    lookups(spark, table)


def opened(df):
    return {f.split("/day=")[1].split("/")[0] for f in df.inputFiles()}


def test_lookups_open_only_days_that_have_the_sensor(spark, table):
    merge(spark, table)
    assert opened(stored.latest_for_sensor(spark, table, "A")) == {DAYS[4]}
    assert opened(stored.latest_for_sensor(spark, table, "C")) == {DAYS[1]}
    assert stored.latest_for_sensor(spark, table, "none").inputFiles() == []
    assert opened(stored.prefix_scan(spark, table, "B_")) == {DAYS[2]}
    assert opened(stored.prefix_scan(spark, table, "odd")) == {keyed.OTHER_DAY}
    plan = stored.latest_for_sensor(spark, table, "A")._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(rowkey,A_2026-02-05T10_00)" in plan


def test_count_reads_footers_only(spark, table):
    count = stored.count_rows(spark, table)
    plan = count._jdf.queryExecution().toString()
    assert "PushedAggregation: [COUNT(*)]" in plan and count.first().row_count == len(FIRST)
    assert stored.count_rows(spark, table + "-none").first().row_count == 0


def test_limited_ingest_reads_the_first_files_only(spark, tmp_path, monkeypatch):
    (tmp_path / "in").mkdir()
    for k in range(1000):
        (tmp_path / f"in/{k:04} [x].csv").write_text("\n".join([header(), *(reading(f"S{k}_{i}", "2026-02-01T10:00:00.000", "1") for i in range(20))]) + "\n")
    scanned = []
    original = jobs.scan_first

    def watched(spark, path, n, keep):
        return original(spark, path, n, lambda raw: (scanned.extend(raw.inputFiles()), keep(raw))[1])

    monkeypatch.setattr(jobs, "scan_first", watched)
    for limit, most in ((1, 1), (55, 3), (100, 7)):
        scanned.clear()
        table = str(tmp_path / f"table{limit}")
        jobs.ingest_job(spark, str(tmp_path / "in"), table, limit)
        assert len(scanned) == most
        expected = {f"S{i // 20}_{i % 20}_2026-02-01T10_00_00.000" for i in range(limit)}
        assert {r.rowkey for r in stored.read_table(spark, table).collect()} == expected


def test_a_failing_job_leaves_no_folder(spark, tmp_path, monkeypatch):
    path = save(tmp_path / "r.csv", [header(), reading("A", "2026-02-01T10:00:00.000", "1")])
    monkeypatch.setattr(stored, "write_table", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        jobs.ingest_job(spark, path, str(tmp_path / "table"), 1)
    assert not os.path.exists(tmp_path / "table_staged") or os.listdir(tmp_path / "table_staged") == []


def test_many_merges_in_random_order_equal_one_upsert(spark, tmp_path):
    path = str(tmp_path / "table")
    rows = [(f"S{k % 4}", f"2026-02-0{1 + k * 7 % 5}T{k % 3:02}:00", str(k) if k % 3 else "", str(-k) if k % 2 else "") for k in range(60)]
    stored.write_table(cells(spark, rows[:10]), path)
    for k in range(10, 60, 10):
        stored.merge_into_table(spark, path, cells(spark, rows[k : k + 10]))
    expected = {r.rowkey: (r.pm25, r.no2) for r in cells(spark, rows).collect()}
    assert content(spark, path) == expected
    lookups(spark, path)
    assert stored.read_table(spark, path).where(F.col("day") != F.substring("time", 1, 10)).count() == 0
