"""Keyed table: one row per ``rowkey``, cells overwritten one by one.

A cell is a column; null means absent. Ingesting a key again replaces the cells that come with a
value and leaves the others. `gaugeworks.operators.stored` keeps such a table in files.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gaugeworks.functions.text import as_text, quoted, row_key

# Cells by family, and the column order of the day export.
FAMILIES = {
    "m": ("pm25", "no2", "humidity", "temp"),
    "g": ("lat", "lon", "location"),
    "meta": ("sensor_name", "datasourceid", "time"),
}
CELLS = tuple(cell for cells in FAMILIES.values() for cell in cells)
EXPORT_COLUMNS = ("rowkey", "pm25", "no2", "humidity", "temp", "lat", "lon", "location", "sensor_name", "datasourceid", "time")
QUOTED_COLUMNS = ("location", "sensor_name", "time")


# --- ingest ------------------------------------------------------------------------------------


def to_cells(raw: DataFrame) -> DataFrame:
    """Raw text readings as ``ingest_seq, rowkey`` and cells; drops readings without id or time.

    Every cell is text; empty text and fields the source lacks are absent cells.
    """
    accepted = raw.filter((F.col("sensor_id") != "") & (F.col("time") != ""))
    source = {cell: cell for cell in CELLS} | {"datasourceid": "sensor_id"}

    def cell(name: str) -> Column:
        if source[name] not in raw.columns:
            return F.lit(None).cast("string").alias(name)
        return F.nullif(F.col(source[name]).cast("string"), F.lit("")).alias(name)

    return accepted.select("ingest_seq", row_key(F.col("sensor_id"), F.col("time")).alias("rowkey"), *map(cell, CELLS))


def first_accepted(batch: DataFrame, n: int, block: Column, order: Column) -> DataFrame:
    """The first ``n`` rows in ingest order.

    No task gets ``n`` rows: rows are counted per ``block`` (an ordered, coarse part of ``order`` of bounded size, see
    `scan_block`), every block before the one holding row ``n`` is kept whole, and only that one block is ranked.
    """
    upto = W.orderBy("block").rowsBetween(W.unboundedPreceding, W.currentRow)  # one row per block
    counts = batch.groupBy(block.alias("block")).agg(F.count(F.lit(1)).alias("rows"))
    running = counts.withColumn("upto", F.sum("rows").over(upto))
    left = (F.lit(n) - F.col("upto") + F.col("rows")).alias("left")
    last = running.filter(F.col("upto") >= n).orderBy("block").limit(1).select(F.struct("block", left).alias("last"))
    whole = batch.filter(F.coalesce(block < last.scalar()["block"], F.lit(True)))
    ranked = batch.filter(block == last.scalar()["block"]).withColumn("_rank", F.row_number().over(W.orderBy(order)))
    return whole.unionByName(ranked.filter(F.col("_rank") <= last.scalar()["left"]).drop("_rank"))


def reduce_batch(batch: DataFrame, cells: list[str], key: str = "rowkey", seq: str = "ingest_seq") -> DataFrame:
    """One row per key: each cell takes its last present value in ingest order.

    Reduced map-side, so a key that holds much of the batch stays cheap. Text in the buffers rules out hash
    aggregation: each scan task sorts its rows by key first.
    """
    last = [F.max_by(c, F.when(F.col(c).isNotNull(), F.col(seq))).alias(c) for c in cells]
    return batch.groupBy(key).agg(*last)


def upsert(stored: DataFrame, batch: DataFrame, cells: list[str], key: str = "rowkey") -> DataFrame:
    """Merge a reduced batch into the stored table, cell by cell; the batch wins where present.

    Both sides hold a key once, so the join neither skews nor multiplies rows.
    """
    merged = [F.coalesce(F.col(f"new.{c}"), F.col(f"old.{c}")).alias(c) for c in cells]
    return stored.alias("old").join(batch.alias("new"), key, "full_outer").select(key, *merged)


# --- days --------------------------------------------------------------------------------------

DAY = "day"
# The day of keys that show no day, or several.
OTHER_DAY = "other"
DATE = "[0-9]{4}-[0-9]{2}-[0-9]{2}"


def key_day(rowkey: Column) -> Column:
    """The day that a key shows after an underscore, if it shows exactly one.

    A time that begins with a day puts it there, so a row whose time begins with day D has day D or the other one.
    """
    shown = F.regexp_extract_all(rowkey, F.lit(f"_({DATE})"), F.lit(1))
    return F.when(F.size(shown) == 1, shown[0]).otherwise(F.lit(OTHER_DAY))


# --- queries -----------------------------------------------------------------------------------


def table_count(table: DataFrame) -> DataFrame:
    """Number of rows of a keyed table."""
    return table.agg(F.count(F.lit(1)).alias("row_count"))


def prefix_scan(table: DataFrame, prefix: str) -> DataFrame:
    """Rows whose key starts with ``prefix`` (reaches the Parquet scan of a stored table)."""
    return table.filter(F.col("rowkey").startswith(prefix))


def latest_per_sensor(table: DataFrame, sensor: str = "datasourceid") -> DataFrame:
    """For each sensor the row with the greatest key."""
    rows = table.groupBy(sensor).agg(F.max_by(F.struct(*table.columns), "rowkey").alias("row"))
    return rows.select("row.*")


def latest_for_sensor(table: DataFrame, sensor_id: str, sensor: str = "datasourceid") -> DataFrame:
    """The row with the greatest key of one sensor, or none."""
    return table.filter(F.col(sensor) == sensor_id).orderBy(F.desc("rowkey")).limit(1)


def export_day(table: DataFrame, day: str) -> DataFrame:
    """Rows whose time starts with ``day``, in key order."""
    rows = table.filter(F.col("time").startswith(day))
    if DAY in table.columns and re.match(DATE, day):
        rows = rows.filter(F.col(DAY).isin(day[:10], OTHER_DAY))
    return rows.select(*EXPORT_COLUMNS).orderBy("rowkey")


def export_lines(rows: DataFrame) -> DataFrame:
    """Export rows as comma separated lines; text columns quoted, absent cells empty."""
    parts = [quoted(F.col(c)) if c in QUOTED_COLUMNS else as_text(F.col(c)) for c in EXPORT_COLUMNS]
    return rows.orderBy("rowkey").select(F.concat_ws(",", *parts).alias("value"))


def by_family(table: DataFrame) -> DataFrame:
    """Row key and one struct of cells per family."""
    return table.select("rowkey", *[F.struct(*cells).alias(family) for family, cells in FAMILIES.items()])
