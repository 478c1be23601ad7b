"""Analytics over timestamped sensor readings, written as Spark DataFrame operators."""

__version__ = "0.1.0"
