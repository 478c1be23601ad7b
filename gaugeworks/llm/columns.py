"""Shared helpers: columns computed in Arrow batches, byte-level words, staged tables.

Conventions of all operators of this subpackage:

* a null text is an empty text (operators that treat it otherwise say so);
* a text is always processed whole; repeated rows each get their own result row;
* an empty table gives an empty result with the same schema;
* columns that an operator doesn't read are carried or dropped untouched, and its own columns never clash with
  them: queries select what they read first, and appended columns get a free name (`free_name`).
"""

from __future__ import annotations

import contextlib
import ctypes
import os
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from gaugeworks.session import fresh_folder, remove_folder

#: Rows of a batch are worked on in slices of at most about this much text, so Python holds little beside the batch.
SLICE_BYTES = 4 << 20
#: Spark's limit of buckets in a table.
MOST_BUCKETS = 100_000
#: Spark's setting that removes a query's shuffle files when it ends; else they stay until the driver collects garbage.
FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_LOWER_WORDS = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)


def alnum_words(text: bytes) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of a UTF-8 text, A-Z lower-cased."""
    return text.translate(_LOWER_WORDS).split()


def spaced(text: bytes) -> bytes:
    """The text with everything but the characters of `alnum_words` turned into spaces; offsets stay."""
    return text.translate(_LOWER_WORDS)


def word_codes(texts: list[bytes | None], table: bytes = _LOWER_WORDS) -> tuple[np.ndarray, list[bytes], np.ndarray]:
    """Words of all texts, one after the other, as places in a list of distinct words; that list; and where each text begins (one
    more entry). ``table`` maps bytes, and those that separate words to a space."""
    sizes = np.array([len(t) if t else 0 for t in texts], np.int64) + 1
    data = np.frombuffer((b" ".join([t or b"" for t in texts]) + b" ").translate(table), np.uint8)
    solid = data != 0x20
    edges = np.flatnonzero(np.diff(solid.view(np.int8), prepend=0))
    starts, ends = edges[::2], edges[1::2]
    at = np.concatenate([[0], np.cumsum(ends - starts)])
    if at[-1] >= 2**31 - 1:
        raise ValueError("a batch of over 2 GB of text")
    words = pa.BinaryArray.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(at.astype(np.int32)), pa.py_buffer(data[solid])])
    coded = words.dictionary_encode()
    codes = coded.indices.to_numpy(zero_copy_only=False) if len(starts) else np.zeros(0, np.int32)
    return codes, as_bytes(coded.dictionary), np.concatenate([[0], np.searchsorted(starts, np.cumsum(sizes))])


def as_bytes(words: pa.BinaryArray) -> list[bytes]:
    """What `to_pylist` gives where nothing is null, without a scalar for each word."""
    _, at, data = words.buffers()
    at = np.frombuffer(at, np.int32)[words.offset : words.offset + len(words) + 1].tolist() if len(words) else [0]
    return list(map((data.to_pybytes() if data else b"").__getitem__, map(slice, at, at[1:])))


def word_hashes(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the `alnum_words` of all texts, one after the other, and where each text begins (one more entry)."""
    codes, distinct, at = word_codes(texts)
    return hashed(distinct)[codes], at


def hashed(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose bits all depend on all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or a variant of it that no column of ``df`` has, upper and lower case alike."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"{name}_"
    return name


def append_columns(
    df: DataFrame, inputs: list[str], added: T.StructType, work: Callable[..., list]
) -> DataFrame:
    """``df`` with the columns ``added``, computed in Arrow batches.

    ``work`` gets one list of Python values for each column of ``inputs`` (strings as UTF-8 bytes) and returns one list
    or Arrow array for each added column. One narrow pass: rows keep their place and partition, nothing is shuffled.
    """
    schema = T.StructType(df.schema.fields + added.fields)
    arrow = to_arrow_schema(schema)
    types = [arrow.field(i).type for i in range(len(df.columns), len(arrow))]
    strings = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    places = [df.columns.index(c) for c in inputs]
    sized = [i for i, c in zip(places, inputs) if c in strings]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, sized):
                values = [as_values(batch.column(i)) for i in places]
                out = [x if isinstance(x, pa.Array) else pa.array(x, t) for x, t in zip(work(*values), types)]
                yield pa.RecordBatch.from_arrays([*batch.columns, *out], names=arrow.names)

    return df.mapInArrow(run, schema)


def as_values(column: pa.Array) -> list:
    if pa.types.is_string(column.type):
        column = column.cast(pa.binary())
    elif pa.types.is_large_string(column.type):
        column = column.cast(pa.large_binary())
    return column.to_pylist()


def slices(batch: pa.RecordBatch, sized: list[int], size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in pieces of about ``size`` bytes in the columns ``sized``; a row is never cut."""
    total = sum(batch.column(i).nbytes for i in sized)
    rows = max(1, int(batch.num_rows * size / max(total, size)))
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)
        release()


def share_code(spark: SparkSession) -> None:
    """Let Python workers started from now on import this package, also where only the driver's path leads to it."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    known = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in known:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, known)])


def release() -> None:
    """Give memory that is free in this process back to the machine: workers of several operators share an executor's."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only glibc has it
        ctypes.CDLL("libc.so.6").malloc_trim(0)


@contextlib.contextmanager
def _freed(spark: SparkSession) -> Iterator[None]:
    before = spark.conf.get(FREED, None)
    spark.conf.set(FREED, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(FREED)
        else:
            spark.conf.set(FREED, before)


def staged(df: DataFrame, spark: SparkSession | None = None, by: str | None = None) -> DataFrame:
    """``df`` written to the shared folder and read back: cuts lineage, survives lost executors, and frees the shuffles on the way.

    With ``by``, a column of long numbers, it is kept in as many buckets of that column as there are shuffle partitions, so that
    grouping by it doesn't move it again.
    """
    spark = spark or df.sparkSession
    folder = fresh_folder(spark, f"{spark.conf.get('spark.sql.warehouse.dir')}/llm")
    if by is None:
        with _freed(spark):
            df.write.parquet(folder)
        return spark.read.schema(df.schema).parquet(folder)
    name = f"staged_{os.path.basename(folder)}"
    buckets = min(int(spark.conf.get("spark.sql.shuffle.partitions")), MOST_BUCKETS)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    spark.sql(f"CREATE TABLE `{name}` ({columns}) USING parquet CLUSTERED BY (`{by}`) INTO {buckets} BUCKETS LOCATION '{folder}'")
    with _freed(spark):
        df.write.insertInto(name)
    return spark.table(name)


def discard(df: DataFrame) -> None:
    """Remove a table that `staged` gave and that nothing reads any more."""
    for folder in {os.path.dirname(f) for f in df.inputFiles()}:
        remove_folder(df.sparkSession, folder)
        df.sparkSession.sql(f"DROP TABLE IF EXISTS `staged_{os.path.basename(folder)}`")
