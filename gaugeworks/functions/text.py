"""Text rules: trimming, tolerant numbers, row keys, quoting, report rendering."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character up to and including the space counts as blank.
BLANK_CHARS = "".join(map(chr, range(0x21)))


def strip_blank(text: Column) -> Column:
    """Trim spaces and control characters on both ends (plain ``trim`` strips only spaces)."""
    return F.btrim(text, F.lit(BLANK_CHARS))


def to_number(text: Column) -> Column:
    """Text to double; what does not parse becomes null instead of raising under ANSI."""
    return text.try_cast("double")


# Spellings of special numbers that a cast takes, and those that the text reports take.
CAST_SPECIALS = "(?i)^[+-]?(inf|infinity|nan)$"
REPORT_SPECIALS = "^[+-]?(Infinity|NaN)$"


def to_report_number(text: Column) -> Column:
    """Like ``to_number``, but special numbers count only in their exact spelling."""
    value = to_number(text)
    special = F.isnan(value) | (F.abs(value) == F.lit(float("inf")))
    loose = special & strip_blank(text).rlike(CAST_SPECIALS) & ~strip_blank(text).rlike(REPORT_SPECIALS)
    return F.when(~F.coalesce(loose, F.lit(False)), value)


# Balanced quotes with no comma inside them. Possessive, so the match is one pass without recursion.
SIMPLE_QUOTES = '^(?:[^"]*+"[^",]*+")*+[^"]*+$'
# A field: unquoted pieces and quoted ones, which may hold commas. Possessive as well.
FIELD = r'(?:^|(?<=,))([^",]*+(?:"[^"]*+"[^",]*+)*+)'


def split_line(line: Column) -> Column:
    """Split a comma separated line into fields.

    A quote toggles quoted state and vanishes; commas count only outside quotes. Where quotes hide no
    comma they are simply removed; otherwise the fields are matched one by one.
    """
    bare = F.replace(line, F.lit('"'), F.lit(""))
    open_end = (F.length(line) - F.length(bare)) % 2 == 1
    fields = F.regexp_extract_all(F.when(open_end, F.concat(line, F.lit('"'))).otherwise(line), F.lit(FIELD), F.lit(1))
    return F.when(line.rlike(SIMPLE_QUOTES), F.split(bare, ",", -1)).otherwise(
        F.transform(fields, lambda field: F.replace(field, F.lit('"'), F.lit("")))
    )


def row_key(sensor_id: Column, time_text: Column) -> Column:
    """``<id>_<time>`` with every colon replaced, also inside the id."""
    return F.translate(F.concat(sensor_id, F.lit("_"), time_text), ":", "_")


def quoted(text: Column) -> Column:
    """Double-quoted text; inner double quotes become single quotes, absent becomes ``""``."""
    return F.concat(F.lit('"'), F.translate(F.coalesce(text, F.lit("")), '"', "'"), F.lit('"'))


def as_text(value: Column) -> Column:
    """Value as text, absent as the empty string."""
    return F.coalesce(value.cast("string"), F.lit(""))


def three_decimals(value: Column) -> Column:
    """``%.3f``. Rounding to 9 digits first removes summation-order noise just below a tie."""
    return F.format_string("%.3f", F.round(value, 9))
