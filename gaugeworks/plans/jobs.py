"""Whole jobs from a raw readings file to written results.

    spark-submit jobs.py <job> <arguments>     (or python -m gaugeworks.plans.jobs …)

Each job is a function of a session and paths. Jobs that read the same raw file several times write
the few columns they need to Parquet once and work from that.
"""

from __future__ import annotations

import argparse
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeworks.operators import aggregates as agg
from gaugeworks.operators import keyed, serving, stored
from gaugeworks.operators.anomalies import anomalies
from gaugeworks.operators.rolling import rolling_24h
from gaugeworks.session import fresh_folder, get_session, remove_folder
from gaugeworks.sources.readings import scan_block, scan_by_header, scan_first, scan_positional
from gaugeworks.sources.results import write_csv, write_export, write_report, write_reports


class Staging:
    """Tables written once as Parquet to the shared folder and read back."""

    def __init__(self, spark: SparkSession, near: str):
        self.spark, self.near, self.folders = spark, near, []

    def keep(self, df: DataFrame) -> DataFrame:
        path = fresh_folder(self.spark, self.near)
        self.folders.append(path)
        df.write.parquet(path)
        return self.spark.read.parquet(path)


@contextmanager
def staging(spark: SparkSession, near: str) -> Iterator[Staging]:
    """Staged tables that are removed in the end, also when a job fails."""
    tables = Staging(spark, near)
    try:
        yield tables
    finally:
        for folder in tables.folders:
            remove_folder(spark, folder)


# --- text reports ------------------------------------------------------------------------------


def sensor_averages_job(spark: SparkSession, source: str, out: str) -> None:
    write_report(agg.averages_report(agg.sensor_averages(scan_positional(spark, source)), "sensor_id"), out)


def daily_averages_job(spark: SparkSession, source: str, out: str) -> None:
    write_report(agg.averages_report(agg.daily_measures(scan_positional(spark, source)), "date"), out)


def hourly_averages_job(spark: SparkSession, source: str, out: str) -> None:
    write_report(agg.averages_report(agg.hourly_averages(scan_positional(spark, source)), "hour"), out)


def exceedances_job(
    spark: SparkSession,
    source: str,
    out: str,
    pm25_threshold: float = agg.DEFAULT_THRESHOLDS["pm25"],
    no2_threshold: float = agg.DEFAULT_THRESHOLDS["no2"],
) -> None:
    thresholds = {"pm25": float(pm25_threshold), "no2": float(no2_threshold)}
    counts = agg.sensor_exceedances(scan_positional(spark, source), thresholds)
    write_report(agg.exceedances_report(counts), out)


def reports_job(
    spark: SparkSession,
    source: str,
    out: str,
    pm25_threshold: float = agg.DEFAULT_THRESHOLDS["pm25"],
    no2_threshold: float = agg.DEFAULT_THRESHOLDS["no2"],
) -> None:
    """The four reports above as folders ``report=…`` under ``out``, the source parsed once."""
    thresholds = {"pm25": float(pm25_threshold), "no2": float(no2_threshold)}
    write_reports(agg.all_reports(scan_positional(spark, source), thresholds), out)


# --- summaries ---------------------------------------------------------------------------------


def summary_job(spark: SparkSession, source: str, out: str, single_file: bool = False, show: bool = False) -> None:
    """Per-sensor summary, daily averages and anomalies under ``out``; ``show`` prints 20 rows of each."""
    with staging(spark, out) as tables:
        readings = tables.keep(scan_by_header(spark, source))
        results = {
            "per_sensor": (agg.per_sensor_summary(readings), (F.desc_nulls_last("pm25_avg"), "sensor_id")),
            "daily": (agg.daily_averages(readings), ("date",)),
            "anomalies": (anomalies(readings), ()),
        }
        for name, (result, order) in results.items():
            write_csv(result, f"{out}/{name}", single_file, order)
            if show:
                serving.preview(result).show(truncate=False)


def rolling_job(spark: SparkSession, source: str, out: str, single_file: bool = False) -> None:
    """Trailing 24-hour averages of every reading."""
    write_csv(rolling_24h(scan_by_header(spark, source)), out, single_file)


# --- keyed table -------------------------------------------------------------------------------


def first_rows(spark: SparkSession, source: str, limit: int, tables: Staging) -> DataFrame:
    """Cells of the first ``limit`` accepted rows of a file or folder; files behind them aren't read."""

    def keep(raw: DataFrame) -> tuple[DataFrame, int]:
        # counted and cut in separate scans, so the line numbers must be fixed first
        rows = tables.keep(keyed.to_cells(raw))
        return rows, rows.count()

    rows = scan_first(spark, source, limit, keep)
    if rows is None:
        return keyed.to_cells(scan_positional(spark, source))
    seq = F.col("ingest_seq")
    return keyed.first_accepted(rows, limit, scan_block(seq), seq)


def ingest_job(spark: SparkSession, source: str, table: str, limit: int | None = None) -> None:
    """Upsert a raw file or folder, or its first ``limit`` accepted rows, into the keyed table."""
    with staging(spark, table) as tables:
        batch = keyed.to_cells(scan_positional(spark, source)) if limit is None else first_rows(spark, source, limit, tables)
        reduced = keyed.reduce_batch(batch, list(keyed.CELLS))
        if stored.table_exists(spark, table):
            stored.merge_into_table(spark, table, tables.keep(reduced))
        else:
            stored.write_table(reduced, table)


def count_job(spark: SparkSession, table: str) -> None:
    stored.count_rows(spark, table).show()


def latest_job(spark: SparkSession, table: str, sensor_id: str) -> None:
    latest = stored.latest_for_sensor(spark, table, sensor_id)
    keyed.by_family(latest).show(1, truncate=False, vertical=True)


def export_day_job(spark: SparkSession, table: str, day: str, out: str, single_file: bool = False) -> None:
    rows = keyed.export_day(stored.read_table(spark, table), day)
    write_export(keyed.export_lines(rows), ",".join(keyed.EXPORT_COLUMNS), out, single_file)


# --- command line ------------------------------------------------------------------------------

# Job name: function, positional arguments, options.
JOBS = {
    "sensor-averages": (sensor_averages_job, ["source", "out"], {}),
    "daily-averages": (daily_averages_job, ["source", "out"], {}),
    "hourly-averages": (hourly_averages_job, ["source", "out"], {}),
    "exceedances": (exceedances_job, ["source", "out"], {"pm25_threshold": float, "no2_threshold": float}),
    "reports": (reports_job, ["source", "out"], {"pm25_threshold": float, "no2_threshold": float}),
    "summary": (summary_job, ["source", "out"], {"single_file": bool, "show": bool}),
    "rolling": (rolling_job, ["source", "out"], {"single_file": bool}),
    "ingest": (ingest_job, ["source", "table"], {"limit": int}),
    "count": (count_job, ["table"], {}),
    "latest": (latest_job, ["table", "sensor_id"], {}),
    "export-day": (export_day_job, ["table", "day", "out"], {"single_file": bool}),
}


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="gaugeworks")
    jobs = parser.add_subparsers(dest="job", required=True)
    for name, (_, positional, options) in JOBS.items():
        job = jobs.add_parser(name)
        for argument in positional:
            job.add_argument(argument)
        for option, kind in options.items():
            flag = "--" + option.replace("_", "-")
            if kind is bool:
                job.add_argument(flag, action="store_true", default=argparse.SUPPRESS)
            else:
                job.add_argument(flag, type=kind, default=argparse.SUPPRESS)
    arguments = vars(parser.parse_args(argv))
    run = JOBS[arguments.pop("job")][0]
    run(get_session(), **arguments)


if __name__ == "__main__":
    main()
