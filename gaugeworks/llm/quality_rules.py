"""Quality rules: plain counts, and compression bands over whole texts and fixed chunks.

A text that zstandard shrinks far more than prose of its length is repetitive; one that it hardly shrinks is noise. Small
texts shrink less, so the band of accepted ratios (bytes before / bytes after) depends on the length. The same holds
for each chunk of `CHUNK` bytes, the last one being the final `CHUNK` bytes, so that every byte is in one: a text may have a tenth
of its bytes in chunks outside the chunk band, which lets a table or an address list pass and rejects a text of which a good part
repeats or is noise. A text shorter than a chunk is judged by its whole ratio.

Counts are over words ``[^\\x20\\x09-\\x0D]+``; a null text has none and is not kept. `repeated_words` is exact: windows
are grouped by a hash, and windows of equal hash are compared word by word.
"""

from __future__ import annotations

import numpy as np
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeworks.llm.columns import append_columns, free_name

SYMBOLS = b"#*$%&|<>"
MIN_WORDS = 20
WINDOW = 8
MAX_REPEATED_PERCENT = 30
LEVEL = 3
CHUNK = 4096
#: (from so many bytes, least ratio, largest ratio); below the first no band holds.
BANDS = ((128, 0.95, 2.4), (256, 1.1, 2.6), (512, 1.2, 2.9), (1024, 1.3, 3.2), (4096, 1.4, 3.8), (16384, 1.5, 4.5), (65536, 1.5, 6.0))
CHUNK_BAND = (1.3, 3.6)
MAX_ODD_CHUNKS = 0.1

_SPACE = b"\x20\x09\x0a\x0b\x0c\x0d"
_MULTIPLIERS = np.random.default_rng(9).integers(1, 2**63, WINDOW, dtype=np.uint64) | np.uint64(1)

RULES = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("word_chars", T.LongType()),
        T.StructField("n_symbols", T.LongType()),
        T.StructField("n_dup_lines", T.LongType()),
        T.StructField("n_repeat_words", T.LongType()),
        T.StructField("base_failed", T.BooleanType()),
        T.StructField("kept", T.BooleanType()),
        T.StructField("ratio", T.DoubleType()),
        T.StructField("n_chunks", T.LongType()),
        T.StructField("n_odd_chunks", T.LongType()),
    ]
)


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words that lie in a window of ``window`` words found twice or more, the first included."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
    if len(numbers) == len(words):
        return 0
    spread = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    spread ^= spread >> np.uint64(29)
    keys = np.zeros(n, np.uint64)
    for k in range(window):
        keys += spread[k : k + n] * _MULTIPLIERS[k % len(_MULTIPLIERS)]
    order = np.argsort(keys, kind="stable")
    same = np.flatnonzero(keys[order[1:]] == keys[order[:-1]])
    if not len(same):
        return 0
    views = np.lib.stride_tricks.sliding_window_view(ids, window)
    hit = np.zeros(n + 1, bool)
    exact = (views[order[same]] == views[order[same + 1]]).all(axis=1)
    if exact.all():
        hit[order[same]] = hit[order[same + 1]] = True
    else:  # two different windows share a hash: group the windows themselves
        _, place, count = np.unique(views, axis=0, return_inverse=True, return_counts=True)
        hit[:n] = count[place.ravel()] > 1
    covered = np.zeros(len(words) + 1, np.int64)
    starts = np.flatnonzero(hit)
    np.add.at(covered, starts, 1)
    np.add.at(covered, starts + window, -1)
    return int((np.cumsum(covered)[:-1] > 0).sum())


def duplicate_lines(text: bytes) -> int:
    lines = [x for x in text.split(b"\n") if x.strip(_SPACE)]
    return len(lines) - len(set(lines))


def band(size: int) -> tuple[float, float] | None:
    found = None
    for least, low, high in BANDS:
        if size >= least:
            found = (low, high)
    return found


def compression(text: bytes, squeeze) -> tuple[float | None, int, int, bool]:
    """Ratio of the whole text, chunks, chunks outside their band, and whether the text passes."""
    if not text:
        return None, 0, 0, True
    ratio = len(text) / len(squeeze(text))
    limits = band(len(text))
    passes = limits is None or limits[0] <= ratio <= limits[1]
    chunks = odd = odd_bytes = reach = 0
    if len(text) >= CHUNK:
        for start in range(0, len(text), CHUNK):
            at = min(start, len(text) - CHUNK)  # the last chunk may overlap the one before
            share = CHUNK / len(squeeze(text[at : at + CHUNK]))
            chunks += 1
            if not CHUNK_BAND[0] <= share <= CHUNK_BAND[1]:
                odd += 1
                odd_bytes += at + CHUNK - max(at, reach)
                reach = at + CHUNK
    return ratio, chunks, odd, passes and odd_bytes <= MAX_ODD_CHUNKS * len(text)


def rules(text: bytes | None, squeeze) -> dict:
    body = text or b""
    words = body.split()  # bytes: exactly the six characters of _SPACE separate
    solid = b"".join(words)
    repeats = repeated_words(words)
    failed = len(words) < MIN_WORDS or 100 * repeats > MAX_REPEATED_PERCENT * len(words)
    ratio, chunks, odd, passes = compression(body, squeeze)
    return {
        "n_words": len(words),
        "word_chars": len(solid.decode("utf-8", "replace")),
        "n_symbols": len(body) - len(body.translate(None, SYMBOLS)),
        "n_dup_lines": duplicate_lines(body),
        "n_repeat_words": repeats,
        "base_failed": failed,
        "kept": not failed and passes,
        "ratio": ratio,
        "n_chunks": chunks,
        "n_odd_chunks": odd,
    }


def quality(docs: DataFrame, text: str = "text", out: str = "rules") -> DataFrame:
    """``docs`` with a struct ``out`` of the counts, ratios and the verdict; one narrow pass."""

    def work(texts: list) -> list:
        squeeze = zstandard.ZstdCompressor(level=LEVEL).compress
        return [[rules(t, squeeze) for t in texts]]

    return append_columns(docs, [text], T.StructType([T.StructField(out, RULES)]), work)


def keep_good(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents that pass, with their own columns."""
    name = free_name(docs, "rules")
    return quality(docs, text, name).where(f"`{name}`.kept").select(*docs.columns)


def op9_quality_rules(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return quality(docs).select("doc_id", *[F.col(f"rules.{f.name}").alias(f.name) for f in RULES.fields])
