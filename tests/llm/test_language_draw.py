"""The training draw counts different texts with a letter, not rows."""

from pyspark.sql import functions as F

from gaugeworks.llm import language


def test_copies_leave_no_language_short(spark):
    copies = spark.range(6000).select(F.lit("aa").alias("lang"), F.lit("the same old text").alias("text"))
    others = spark.range(500).select(F.lit("aa").alias("lang"), F.concat(F.lit("other text "), F.col("id").cast("string")).alias("text"))
    three = spark.range(3000).select(F.lit("bb").alias("lang"), F.concat(F.lit("drei "), (F.col("id") % 3).cast("string")).alias("text"))
    empty = spark.range(3000).select(F.lit("cc").alias("lang"), F.col("id").cast("string").alias("text"))
    few = spark.createDataFrame([("cc", "é 1"), ("cc", "ü"), (None, "none"), ("dd", None), ("dd", "12 _")], "lang string, text string")
    docs = copies.union(others).union(three).union(empty).union(few)
    found = language.training_windows(docs, F.col("lang"), F.col("text"))
    texts = {lang: {piece for k, piece in found if k == lang} for lang, _ in found}
    assert {lang: len(t) for lang, t in texts.items()} == {"aa": 501, "bb": 3, "cc": 2}


def test_no_more_than_the_bound(spark):
    docs = spark.range(3000).select(F.lit("aa").alias("lang"), F.concat(F.lit("text "), F.col("id").cast("string")).alias("text"))
    found = language.training_windows(docs, F.col("lang"), F.col("text"), per_language=100)
    assert len({piece for _, piece in found}) == 100
