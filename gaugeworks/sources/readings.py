"""Scans of raw readings and the canonical ``readings`` table.

Canonical columns: ``ingest_seq, sensor_id, time, pm25, no2`` and, where the source has them,
``sensor_name, humidity, temp, lat, lon, location``. *Raw* readings hold every field as text, so
the text reports and the keyed table see exactly what was in the file; *typed* readings hold
doubles and a timestamp.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeworks.functions.text import split_line, strip_blank, to_number
from gaugeworks.functions.time import to_time

MEASURES = ("pm25", "no2")

# Positions and header names in the raw readings file.
MIN_FIELDS = 43
FIELD_POSITIONS = {
    "sensor_id": 0,
    "time": 1,
    "sensor_name": 2,
    "no2": 22,
    "pm25": 24,
    "humidity": 27,
    "temp": 31,
    "lat": 39,
    "lon": 40,
    "location": 41,
}
ID_HEADER = "datasourceid"
HEADERS = {
    "sensor_id": ID_HEADER,
    "time": "time",
    "pm25": "pm2_5concmassindividual_value",
    "no2": "no2concindividual_value",
}
NUMERIC = ("pm25", "no2", "humidity", "temp", "lat", "lon")


def scan_positional(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Raw readings by field position from text lines, tolerant of quotes and ragged rows.

    ``ingest_seq`` orders lines by file name, block and line, however the scan packs blocks into tasks: lines of one block
    are read by one task, one after the other.
    """
    place = F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("line"),
    )
    return parse_lines(spark.read.text(path).select("value", place.alias("ingest_seq")))


def source_files(spark: SparkSession, path: str) -> list[str]:
    """The files that a scan of ``path`` would read, in ingest order, as paths that name one file each."""
    files = sorted(spark.read.text(path).inputFiles())
    return [re.sub(r"([\[\]{}*?\\])", r"\\\1", unquote(f)) for f in files]


def scan_first(spark: SparkSession, path: str, n: int, keep: Callable[[DataFrame], tuple[DataFrame, int]]) -> DataFrame | None:
    """Raw readings of the first files that give ``n`` rows; None where there is no file.

    Files are scanned in ingest order in groups that double, and no group is scanned once there are enough rows. ``keep`` accepts
    rows of a group, stores them and counts them, so every file is parsed once at most.
    """
    files, kept, rows, size = source_files(spark, path), None, 0, 1
    while files and rows < n:
        accepted, count = keep(scan_positional(spark, files[:size]))
        kept = accepted if kept is None else kept.unionByName(accepted)
        files, rows, size = files[size:], rows + count, size * 2
    return kept


#: Lines of a part of a file block, see `scan_block`, as a power of two.
BLOCK_BITS = 17


def scan_block(ingest_seq: Column) -> Column:
    """An ordered, coarse part of ``scan_positional``'s order: at most 131,072 lines of one file block.

    A file that cannot be split, such as a compressed one, is one block of many such parts.
    """
    return F.struct(ingest_seq["file"], ingest_seq["start"], F.shiftright(ingest_seq["line"], BLOCK_BITS))


def parse_lines(lines: DataFrame, line: str = "value") -> DataFrame:
    """Raw readings from a column of text lines; drops headers and lines with too few fields.

    ``explode`` of the one split line keeps Spark from pushing the filters, and with them further
    copies of the split, below it.
    """
    others = [c for c in lines.columns if c != line]
    fields = F.col("_fields")
    return (
        lines.select(*others, F.explode(F.array(split_line(F.col(line)))).alias("_fields"))
        .filter(F.size(fields) >= MIN_FIELDS)
        .select(*others, *[strip_blank(fields[pos]).alias(name) for name, pos in FIELD_POSITIONS.items()])
        .filter(F.col("sensor_id") != ID_HEADER)
    )


def scan_by_header(spark: SparkSession, path: str, headers: dict[str, str] = HEADERS) -> DataFrame:
    """Typed readings from a CSV file by header name.

    Only the header line is read ahead (no inference pass). Keeps rows without id or time.
    """
    raw = spark.read.option("header", True).option("escape", '"').csv(path)
    raw = raw.filter(F.col(headers["sensor_id"]).isNull() | (F.col(headers["sensor_id"]) != ID_HEADER))
    return typed(raw.select(*[F.col(f"`{header}`").alias(name) for name, header in headers.items()]))


def typed(raw: DataFrame) -> DataFrame:
    """Raw text readings to typed ones; numbers and times that do not parse become null."""

    def convert(name: str) -> Column:
        if name == "time":
            return to_time(F.col(name)).alias(name)
        if name in NUMERIC:
            return to_number(F.col(name)).alias(name)
        return F.col(name)

    return raw.select(*[convert(name) for name in raw.columns])


def from_events(events: DataFrame) -> DataFrame:
    """Typed readings from the ``events`` table: two sparse, overlapping measures."""
    kind = F.col("event_type")
    return events.select(
        F.col("event_id").alias("ingest_seq"),
        F.col("user_id").cast("string").alias("sensor_id"),
        F.col("ts").alias("time"),
        F.when(kind.isin("view", "click", "purchase"), F.col("value")).alias("pm25"),
        F.when(kind.isin("purchase", "error"), F.col("value")).alias("no2"),
        F.col("props").alias("sensor_name"),
    )


def to_long(readings: DataFrame, measures: tuple[str, ...] = MEASURES) -> DataFrame:
    """One row per present measure: ``sensor_id, time, measure, value``."""
    return (
        readings.select("sensor_id", "time", *measures)
        .unpivot(["sensor_id", "time"], list(measures), "measure", "value")
        .filter(F.col("value").isNotNull())
    )
