"""Result directories: headered CSV, text reports, and reading them back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeworks.session import fresh_folder, join_files, names_in, remove_folder
from gaugeworks.sources.readings import ID_HEADER

# Result files name the sensor column like the raw file does.
RESULT_NAMES = {"sensor_id": ID_HEADER}


def write_csv(df: DataFrame, path: str, single_file: bool = False, order: tuple[Column | str, ...] = ()) -> None:
    """Overwrite a headered CSV directory, under the column names of result files.

    With ``single_file`` the rows, sorted by ``order``, are one part file, see `write_joined`.
    """
    named = df.withColumnsRenamed(RESULT_NAMES)
    options = {"escape": '"', "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"}
    if single_file:
        ordered = df.orderBy(*order).withColumnsRenamed(RESULT_NAMES) if order else named
        write_joined(ordered, ",".join(named.columns), path, options)
    else:
        named.write.mode("overwrite").options(header=True, **options).csv(path)


def write_joined(df: DataFrame, header: str, path: str, options: dict[str, object]) -> None:
    """Overwrite a CSV directory with one part file: a header line, then all rows in the order of ``df``.

    Tasks write and sort parts, ranges of the order; their bytes are then joined as they are, so no task sees all rows. The parts'
    folder is removed also if that fails, and the joined file gets its name when it is whole.
    """
    spark = df.sparkSession
    folder = fresh_folder(spark, path)
    try:
        df.write.options(header=False, **options).csv(folder)
        remove_folder(spark, path)
        parts = [f"{folder}/{name}" for name in names_in(spark, folder) if name.startswith("part-")]
        join_files(spark, parts, f"{path}/part-00000.csv", f"{header}\n")
    finally:
        remove_folder(spark, folder)


def write_reports(reports: DataFrame, path: str) -> None:
    """Write ``report, value`` as one folder of text for each report, in one job; refuses an existing directory."""
    reports.write.mode("error").partitionBy("report").text(path)


def write_report(lines: DataFrame, path: str) -> None:
    """Write one text column; like the report jobs, refuses an existing directory."""
    lines.write.mode("error").text(path)


def write_export(lines: DataFrame, header: str, path: str, single_file: bool = False) -> None:
    """Overwrite a directory of ready-made CSV lines, each part file headed by ``header``.

    The lines are one column to Spark, so separator and quote are set to characters outside the data.
    """
    options = {"sep": "\u0001", "quote": "", "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    if single_file:
        write_joined(lines, header, path, options)
    else:
        lines.toDF(header).write.mode("overwrite").options(header=True, **options).csv(path)


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """Read a result directory back: every part file, all values as text."""
    return spark.read.option("header", True).option("escape", '"').csv(path)


def read_result(spark: SparkSession, path: str) -> DataFrame:
    """A result directory under canonical names and types; values that do not parse become null."""

    def typed(name: str) -> Column:
        if name in ("time", "date"):
            return F.col(name).try_cast("timestamp_ntz" if name == "time" else "date").alias(name)
        if name == "records" or name.endswith("_count"):
            return F.col(name).try_cast("long").alias(name)
        if name in ("pm25", "no2") or name.startswith("rolling_") or name.endswith(("_avg", "_min", "_max")):
            return F.col(name).try_cast("double").alias(name)
        return F.col(name)

    rows = read_csv(spark, path).withColumnsRenamed({header: name for name, header in RESULT_NAMES.items()})
    return rows.select(*[typed(name) for name in rows.columns])
