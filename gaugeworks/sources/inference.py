"""Typed scan of a headered CSV file whose columns and types aren't known.

The text is read once to see what kinds of values each column has: every value is told apart in one pass, and only a count per column
and kind is shuffled. A column gets the narrowest type that takes its values; a second scan is typed. What Spark's own inference
decides from the same values is decided here too, but a column may also have a bounded share of bad values, which become null,
and times carry no zone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

EMPTY, INTEGER, LONG, DOUBLE, DATE, TIMESTAMP, BOOLEAN, TEXT = range(8)
#: Types, narrowest first, and the kinds of values that they take.
TYPES = {
    "int": {INTEGER},
    "bigint": {INTEGER, LONG},
    "double": {INTEGER, LONG, DOUBLE},
    "date": {DATE},
    "timestamp_ntz": {DATE, TIMESTAMP},
    "boolean": {BOOLEAN},
}


def kind_of(text: Column) -> Column:
    """What a value looks like; whole numbers beyond 64 bits count as doubles."""
    whole = text.rlike("^[+-]?[0-9]+$")
    return (
        F.when(text.isNull() | (text == ""), EMPTY)
        .when(whole & text.try_cast("int").isNotNull(), INTEGER)
        .when(whole & text.try_cast("long").isNotNull(), LONG)
        .when(text.try_cast("double").isNotNull(), DOUBLE)
        .when(text.rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}$") & text.try_cast("date").isNotNull(), DATE)
        .when(text.try_cast("timestamp_ntz").isNotNull(), TIMESTAMP)
        .when(F.lower(text).isin("true", "false"), BOOLEAN)
        .otherwise(TEXT)
    )


def column(name: str) -> Column:
    """A column by its exact name, whatever characters that has."""
    return F.col("`" + name.replace("`", "``") + "`")


def kinds(raw: DataFrame) -> DataFrame:
    """Values of each kind per column: ``column`` (its number), ``kind``, ``n``."""
    values = F.array(*[kind_of(column(c)) for c in raw.columns])
    return raw.select(F.posexplode(values).alias("column", "kind")).groupBy("column", "kind").agg(F.count(F.lit(1)).alias("n"))


def narrowest(counts: dict[int, int], bad: float = 0.0) -> str:
    """The type for a column of these kinds of values, of which a share of ``bad`` may be lost; text if none is known."""
    known = sum(n for kind, n in counts.items() if kind != EMPTY)
    if known:
        for name, taken in TYPES.items():
            lost = sum(n for kind, n in counts.items() if kind != EMPTY and kind not in taken)
            if lost <= bad * known:
                return name
    return "string"


def read_text(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("header", True).option("escape", '"').csv(path)


def infer_types(raw: DataFrame, bad: float = 0.0) -> dict[str, str]:
    """A type for each column. At most eight counts per column come to the driver."""
    found: dict[int, dict[int, int]] = {}
    for at, kind, n in kinds(raw).collect():
        found.setdefault(at, {})[kind] = n
    return {c: narrowest(found.get(k, {}), bad) for k, c in enumerate(raw.columns)}


def scan_inferred(spark: SparkSession, path: str, bad: float = 0.0) -> DataFrame:
    """All columns of a headered CSV file under inferred types; a value that isn't of its column's type is null."""
    raw = read_text(spark, path)
    types = infer_types(raw, bad)
    return raw.select(*[(column(c) if t == "string" else column(c).try_cast(t)).alias(c) for c, t in types.items()])
