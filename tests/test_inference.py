"""Inferred types against Spark's own, and values that are bad."""

import pytest
from test_sources_and_jobs import DATA, header, part_lines, save

from gaugeworks.plans import jobs
from gaugeworks.sources import inference
from gaugeworks.sources.results import write_csv, write_export

COLUMNS = {
    "whole": ["1", "-2", "+3", ""],
    "long": ["1", "3000000000", "", "5"],
    "real": ["1", "2.5", "-1e3", ""],
    "special": ["NaN", "Infinity", "1", "2"],
    "date": ["2026-02-01", "", "2026-12-31", "2024-02-29"],
    "time": ["2026-02-01T10:00:00", "2026-02-01 11:00:00.5", "", "2026-02-01T10:00:00"],
    "both": ["2026-02-01", "2026-02-01T10:00:00", "", "2026-02-02"],
    "flag": ["true", "FALSE", "", "True"],
    "text": ["a", "1", "", "2026-02-01"],
    "mixed": ["1", "2026-02-01", "", "true"],
    "nothing": ["", "", "", ""],
    "zeros": ["007", "0", "-0", ""],
    "odd date": ["2026-13-01", "2026-02-01", "", ""],
    "a.b`c": ["1", "2", "3", "4"],
}


def test_types_like_sparks_own(spark, tmp_path):
    names = list(COLUMNS)
    path = save(tmp_path / "x.csv", [",".join(names), *(",".join(COLUMNS[c][k] for c in names) for k in range(4))])
    own = inference.scan_inferred(spark, path)
    sparks = spark.read.options(header=True, inferSchema=True).csv(path)
    assert [(c, t.replace("timestamp_ntz", "timestamp")) for c, t in own.dtypes] == [(c, t.replace("timestamp_ntz", "timestamp")) for c, t in sparks.dtypes]
    safe = [f"`{c.replace('`', '``')}`" for c in names if c not in ("time", "both", "special")]
    assert own.select(*safe).collect() == sparks.select(*safe).collect()


def test_readings_file_like_sparks_own(spark, tmp_path):
    path = save(tmp_path / "r.csv", [header(), *DATA])
    own = dict(inference.scan_inferred(spark, path).dtypes)
    sparks = dict(spark.read.options(header=True, inferSchema=True).csv(path).dtypes)
    assert own == {c: t.replace("timestamp", "timestamp_ntz") if c == "time" else t for c, t in sparks.items()}
    assert own["time"] == "timestamp_ntz" and own["no2concindividual_value"] == "int"


def test_a_share_of_bad_values_becomes_null(spark, tmp_path):
    path = save(tmp_path / "x.csv", ["v", *(["bad"] + [str(k) for k in range(9)])])
    assert inference.scan_inferred(spark, path).dtypes == [("v", "string")]
    rows = inference.scan_inferred(spark, path, bad=0.1)
    assert rows.dtypes == [("v", "int")] and [r.v for r in rows.collect()] == [None, *range(9)]


def test_the_text_is_aggregated_once(spark, tmp_path):
    path = save(tmp_path / "x.csv", ["a,b", "1,x"])
    plan = inference.kinds(inference.read_text(spark, path))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan csv") == 1 and "partial_count" in plan


def test_empty_files(spark, tmp_path):
    path = save(tmp_path / "x.csv", ["a,b"])
    assert inference.scan_inferred(spark, path).dtypes == [("a", "string"), ("b", "string")]


def test_a_single_file_is_joined_from_sorted_parts(spark, tmp_path):
    out = str(tmp_path / "out")
    df = spark.range(20_000).selectExpr("(id * 7919) % 20000 AS n", "concat('x, \"', id) AS text")
    session = spark.newSession()
    session.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    write_csv(df, out, True, ("n",))
    (lines,) = part_lines(out)
    assert lines[0] == "n,text" and [int(x.split(",")[0]) for x in lines[1:]] == list(range(20_000))
    write_csv(df.limit(0), out, True, ("n",))
    assert part_lines(out) == [["n,text"]]
    ordered = df.orderBy("n")
    assert "SinglePartition" not in ordered._jdf.queryExecution().executedPlan().toString()
    write_export(ordered.selectExpr("concat(n, ',', text) AS value"), "n,text", out, True)
    assert part_lines(out)[0][1] == '0,x, "0'
    assert not [n for n in tmp_path.iterdir() if n.name.endswith("_staged") and any(n.iterdir())]


def test_a_failing_join_leaves_no_parts(spark, tmp_path, monkeypatch):
    from gaugeworks.sources import results

    monkeypatch.setattr(results, "join_files", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        write_csv(spark.range(3), str(tmp_path / "out"), True)
    assert not (tmp_path / "out_staged").exists() or list((tmp_path / "out_staged").iterdir()) == []


def test_all_reports_in_one_scan(spark, tmp_path):
    from gaugeworks.operators import aggregates as agg
    from gaugeworks.sources.readings import scan_positional

    source = save(tmp_path / "r.csv", [header(), *DATA])
    jobs.reports_job(spark, source, str(tmp_path / "all"))
    one_by_one = {
        "sensor_averages": jobs.sensor_averages_job,
        "daily_averages": jobs.daily_averages_job,
        "hourly_averages": jobs.hourly_averages_job,
        "exceedances": jobs.exceedances_job,
    }
    for name, job in one_by_one.items():
        job(spark, source, str(tmp_path / name))
        alone = [text for part in part_lines(tmp_path / name) for text in part]
        assert [text for part in part_lines(tmp_path / f"all/report={name}") for text in part] == alone != []
    jobs.reports_job(spark, source, str(tmp_path / "other"), pm25_threshold=15, no2_threshold=1000)
    lines = [text for part in part_lines(tmp_path / "other/report=exceedances") for text in part]
    assert lines == ["A\tpm25_exceedances=1, no2_exceedances=0", "B\tpm25_exceedances=1, no2_exceedances=0"]
    with pytest.raises(Exception, match="already exists"):
        jobs.reports_job(spark, source, str(tmp_path / "all"))
    plan = agg.all_reports(scan_positional(spark, source))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan text") == 1 and plan.count("hashpartitioning") == 1
