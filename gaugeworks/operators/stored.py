"""The keyed table in files: generations of days, and where each sensor is.

Rows are partitioned by the day that their row key shows, so a key is in one day for good, and a merge that reads the days of its
keys finds every one of them. A merge never touches what is there: it joins its days' rows with the batch and writes them, once, as
the next *generation*, a folder of its own::

    table/gen=7/day=2026-02-01/part-…    the days of the seventh merge, range-sorted by row key
    table/gen=7/_SUCCESS                 written by Spark when all of them are there
    table/_sensors/gen=7/part-…          for each sensor and day of that generation the first and last key

A generation counts once Spark has marked it, all its days at once; of a day, readers take the greatest such generation and open no
other. So whenever a merge stops, the table is as before it or as after it, and merging the batch again is always right. Older
generations of a day are removed afterwards; a removal that stops midway is finished by the next merge, as is a generation without
its mark. There is one writer at a time.

The sensors' table is a guide: it is derived from a generation after its mark, and a generation that lacks it is read without it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeworks.operators.keyed import CELLS, DAY, key_day, upsert
from gaugeworks.session import names_in, remove_folder

GENERATION, MARK, SENSORS = "gen", "_SUCCESS", "_sensors"
SENSOR = "datasourceid"
_ROWS = ", ".join(f"{c} string" for c in ("rowkey", *CELLS, DAY)) + f", {GENERATION} int"
_GUIDE = f"{SENSOR} string, {DAY} string, first_key string, last_key string, {GENERATION} int"


def _folder(path: str, generation: int, day: str | None = None) -> str:
    return f"{path}/{GENERATION}={generation}" + ("" if day is None else f"/{DAY}={day}")


def _generations(spark: SparkSession, path: str, below: str = "") -> dict[int, bool]:
    """All generations, and whether each is marked."""
    found = [int(name.partition("=")[2]) for name in names_in(spark, path + below) if name.startswith(f"{GENERATION}=")]
    return {g: MARK in names_in(spark, _folder(path + below, g)) for g in found}


def current_days(spark: SparkSession, path: str) -> dict[str, int]:
    """For each day of the table the generation that holds it. Lists folders only, as planning a scan does."""
    days: dict[str, int] = {}
    for generation, marked in sorted(_generations(spark, path).items()):
        if marked:
            names = names_in(spark, _folder(path, generation))
            days |= {name.partition("=")[2]: generation for name in names if name.startswith(f"{DAY}=")}
    return days


def table_exists(spark: SparkSession, path: str) -> bool:
    return any(_generations(spark, path).values())


def read_table(spark: SparkSession, path: str, days: set[str] | None = None) -> DataFrame:
    """The stored table, or some days of it, with ``day`` as text. Only current folders are listed and read."""
    return _read(spark, path, {d: g for d, g in current_days(spark, path).items() if days is None or d in days})


def _read(spark: SparkSession, path: str, days: dict[str, int]) -> DataFrame:
    if not days:
        return spark.createDataFrame([], _ROWS).drop(GENERATION)
    folders = [_folder(path, g, d) for d, g in sorted(days.items())]
    return spark.read.schema(_ROWS).option("basePath", path).parquet(*folders).drop(GENERATION)


def write_table(table: DataFrame, path: str) -> None:
    """Write a new table: a busy day is split over tasks by key range, a quiet one is one file."""
    spark = table.sparkSession
    if table_exists(spark, path):
        raise ValueError(f"there is a table in {path}")
    _write(spark, path, table)


def merge_into_table(spark: SparkSession, path: str, batch: DataFrame) -> None:
    """Upsert a batch of cells, reduced to one row per key and staged, into the stored table.

    The days of the batch come to the driver; they are folders of the new generation, which the driver lists anyway.
    """
    days = {r[0] for r in batch.select(key_day(F.col("rowkey"))).distinct().collect()}
    _write(spark, path, upsert(read_table(spark, path, days).drop(DAY), batch, list(CELLS)))


def _write(spark: SparkSession, path: str, table: DataFrame) -> None:
    known = _generations(spark, path)
    for generation in [g for g, marked in known.items() if not marked]:  # of a merge that stopped
        remove_folder(spark, _folder(path, generation))
    generation = max(known, default=0) + 1
    rows = table.select("rowkey", *CELLS, key_day(F.col("rowkey")).alias(DAY))
    writer = rows.repartitionByRange(DAY, "rowkey").sortWithinPartitions(DAY, "rowkey").write.partitionBy(DAY)
    writer.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "true").parquet(_folder(path, generation))
    _guide_missing(spark, path)
    remove_superseded(spark, path)


def remove_superseded(spark: SparkSession, path: str) -> None:
    """Remove older generations of days, and generations none of whose days is current."""
    current = current_days(spark, path)
    for generation, marked in sorted(_generations(spark, path).items()):
        if marked and generation not in current.values():
            remove_folder(spark, _folder(path, generation))
            remove_folder(spark, _folder(f"{path}/{SENSORS}", generation))
        elif marked:
            for name in names_in(spark, _folder(path, generation)):
                day = name.partition("=")[2]
                if name.startswith(f"{DAY}=") and current[day] != generation:
                    remove_folder(spark, _folder(path, generation, day))


# --- where sensors are -------------------------------------------------------------------------


def _guide_missing(spark: SparkSession, path: str) -> None:
    """Write the sensors' table of generations that lack it, sorted by sensor, so that a lookup skips row groups."""
    guided = _generations(spark, path, f"/{SENSORS}")
    for generation, marked in _generations(spark, path).items():
        if marked and not guided.get(generation):
            rows = _read(spark, path, {d: g for d, g in current_days(spark, path).items() if g == generation})
            keys = rows.groupBy(SENSOR, DAY).agg(F.min("rowkey").alias("first_key"), F.max("rowkey").alias("last_key"))
            writer = keys.repartitionByRange(SENSOR, DAY).sortWithinPartitions(SENSOR, DAY).write.mode("overwrite")
            writer.parquet(_folder(f"{path}/{SENSORS}", generation))


def _guide(spark: SparkSession, path: str, days: dict[str, int]) -> tuple[DataFrame, dict[str, int]]:
    """The guide's rows of the current ``days``, and the days that have none."""
    guided = {g for g, marked in _generations(spark, path, f"/{SENSORS}").items() if marked}
    folders = [_folder(f"{path}/{SENSORS}", g) for g in sorted(guided & set(days.values()))]
    bare = {d: g for d, g in days.items() if g not in guided}
    if not folders:
        return spark.createDataFrame([], _GUIDE), bare
    rows = spark.read.schema(_GUIDE).option("basePath", f"{path}/{SENSORS}").parquet(*folders)
    current = spark.createDataFrame([(d, g) for d, g in days.items()], f"{DAY} string, {GENERATION} int")
    return rows.join(F.broadcast(current), [DAY, GENERATION], "left_semi"), bare  # one row for each day


def days_with_prefix(spark: SparkSession, path: str, prefix: str) -> set[str]:
    """Days that may hold a key that starts with ``prefix``."""
    guide, bare = _guide(spark, path, current_days(spark, path))
    there = (F.col("last_key") >= prefix) & ((F.col("first_key") <= prefix) | F.col("first_key").startswith(prefix))
    return {r[0] for r in guide.where(there).select(DAY).distinct().collect()} | set(bare)


def prefix_scan(spark: SparkSession, path: str, prefix: str) -> DataFrame:
    """Rows whose key starts with ``prefix``: opens the days that may hold one, and there the filter reaches the Parquet scan."""
    return read_table(spark, path, days_with_prefix(spark, path, prefix)).filter(F.col("rowkey").startswith(prefix))


def latest_for_sensor(spark: SparkSession, path: str, sensor: str) -> DataFrame:
    """The row with the greatest key of one sensor, or none: a lookup by key in the one day that has it."""
    days = current_days(spark, path)
    guide, bare = _guide(spark, path, days)
    last = guide.where(F.col(SENSOR) == sensor).agg(F.max(F.struct("last_key", DAY))).first()[0]
    rows = _read(spark, path, bare | ({last[DAY]: days[last[DAY]]} if last else {})).where(F.col(SENSOR) == sensor)
    return (rows.where(F.col("rowkey") >= last["last_key"]) if last else rows).orderBy(F.desc("rowkey")).limit(1)


def latest_per_sensor(spark: SparkSession, path: str) -> DataFrame:
    """For each sensor the row with the greatest key: keys from the guide, then one join on the key in the days that have them.

    No row is carried through an aggregation.
    """
    days = current_days(spark, path)
    guide, bare = _guide(spark, path, days)
    unguided = _read(spark, path, bare).select(SENSOR, DAY, F.col("rowkey").alias("last_key"))
    keys = guide.select(SENSOR, DAY, "last_key").unionByName(unguided)
    last = keys.groupBy(SENSOR).agg(F.max(F.struct("last_key", DAY)).alias("last"))
    last = last.select(F.col("last.last_key").alias("rowkey"), F.col(f"last.{DAY}").alias(DAY))
    return _read(spark, path, days).join(last, ["rowkey", DAY], "left_semi")


def count_rows(spark: SparkSession, path: str) -> DataFrame:
    """The number of rows, from the files' footers: Spark pushes the count into its Parquet reader, and no row is read.

    Only the reader of its second source interface does so, which a session of its own is told to use.
    """
    folders = [_folder(path, g, d) for d, g in sorted(current_days(spark, path).items())]
    own = spark.newSession()
    own.conf.set("spark.sql.sources.useV1SourceList", "")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    if not folders:
        return spark.range(0).agg(F.count(F.lit(1)).alias("row_count"))
    return own.read.schema("rowkey string").parquet(*folders).agg(F.count(F.lit(1)).alias("row_count"))
