"""Shards of near equal bytes by histogram sort.

Every row has a 64-bit key: the first `GROUP_BITS` bits are a hash of its text, the others one of its place, so that equal texts lie
together, and a group that is too large for its share can still be cut anywhere. The rows are sorted by key into shards without
sampling: the space of keys is cut by probes into cells, and every round counts the exact bytes and rows of all cells over all
partitions, where each task sends one row for each cell that it met. Then cells are refined with `PROBES` further probes each:

* those in which a boundary between shards falls, until one of the cell's ends is within `TOLERANCE` of the wanted bytes or the cell
  holds one row;
* those with more bytes than a range may have, until they have less or hold one row.

A boundary is put between two texts where one within the tolerance is known, else between two rows. At last the rows are exchanged
once: shards consist of ranges of about `RANGE_BYTES`, a task sorts a range, and the known rows of the ranges before it give the
first slot. So no task holds a shard, and the driver only sees counts of cells: at most `PROBES` for each of `MOST_RANGES` ranges
and for each boundary.

A null text has no bytes and is empty. A row's size is its text's bytes plus one. Repeated rows each get a slot. Rows are written
once before counting, as all rounds have to see the same places. An empty table gives an empty result.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gaugeworks.llm.columns import free_name, staged

SHARDS = 16
GROUP_BITS = 40
#: Probes in a cell that is refined.
PROBES = 64
#: Of a shard's bytes.
TOLERANCE = 1e-3
RANGE_BYTES = 32 << 20
MOST_RANGES = 1 << 15

SPACE = 1 << 64


@dataclass
class Cells:
    """Cells between ``starts`` (the first is 0) with what they hold."""

    starts: list[int]
    size: list[int]
    rows: list[int]

    def ends(self) -> list[int]:
        return [*self.starts[1:], SPACE]

    def before(self) -> list[int]:
        """Bytes before each cell, and of all."""
        return [0, *np.cumsum(np.array(self.size, object)).tolist()]


def probes(start: int, end: int, n: int = PROBES) -> list[int]:
    """Starts of ``n`` equal cells, or of as many as there are keys."""
    width = end - start
    n = min(n, width)
    return [start + width * k // n for k in range(n)]


def to_refine(cells: Cells, wanted: list[int], slack: int, most: int) -> set[int]:
    """Numbers of the cells that the next round refines."""
    before, ends = cells.before(), cells.ends()

    def divisible(k: int) -> bool:
        return cells.rows[k] > 1 and ends[k] - cells.starts[k] > 1

    found = {k for k in range(len(cells.starts)) if cells.size[k] > most and divisible(k)}
    for want in wanted:
        k = min(bisect_right(before, want) - 1, len(cells.starts) - 1)
        if min(want - before[k], before[k + 1] - want) > slack and divisible(k):
            found.add(k)
    return found


def boundaries(cells: Cells, wanted: list[int], slack: int) -> list[int]:
    """For each of ``wanted`` the number of the cell that begins a shard: the nearest, or one between texts within ``slack``."""
    before = cells.before()
    group = SPACE >> GROUP_BITS
    out = [0]
    for want in wanted:
        k = bisect_right(before, want) - 1
        near = [j for j in (k, k + 1) if out[-1] <= j <= len(cells.starts)] or [out[-1]]
        whole = [j for j in near if (j == len(cells.starts) or cells.starts[j] % group == 0) and abs(before[j] - want) <= slack]
        out.append(min(whole or near, key=lambda j: abs(before[j] - want)))
    return out[1:]


def counted(keyed: DataFrame, key: str, size: str, starts: list[int]) -> Cells:
    """Exact bytes and rows of the cells between ``starts``."""
    probes_ = np.array(starts, np.uint64)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, rows = np.zeros(len(probes_), np.int64), np.zeros(len(probes_), np.int64)
        for batch in batches:
            cell = np.searchsorted(probes_, batch.column(0).to_numpy().view(np.uint64), side="right") - 1
            np.add.at(sums, cell, batch.column(1).to_numpy())
            rows += np.bincount(cell, minlength=len(rows))
        met = np.flatnonzero(rows)
        yield pa.RecordBatch.from_pydict({"cell": met.astype(np.int32), "size": sums[met], "rows": rows[met]})

    found = keyed.select(key, size).mapInArrow(count, "cell int, size long, rows long").groupBy("cell").agg(F.sum("size"), F.sum("rows"))
    sums, rows = [0] * len(starts), [0] * len(starts)
    for cell, s, r in found.collect():  # one row for each cell
        sums[cell], rows[cell] = s, r
    return Cells(starts, sums, rows)


def refined(keyed: DataFrame, key: str, size: str, shards: int, tolerance: float, range_bytes: int) -> tuple[Cells, list[int], int]:
    """Cells fine enough for ``shards`` near equal shards, the bytes wanted before each shard but the first, and the slack."""
    cells = counted(keyed, key, size, probes(0, SPACE))
    total = sum(cells.size)
    wanted = [total * k // shards for k in range(1, shards)]
    slack = int(tolerance * total / shards)
    most = max(range_bytes, total // MOST_RANGES)
    while again := to_refine(cells, wanted, slack, most):
        ends = cells.ends()
        starts = [p for k, start in enumerate(cells.starts) for p in (probes(start, ends[k]) if k in again else [start])]
        cells = counted(keyed, key, size, starts)
    return cells, wanted, slack


def ranges(cells: Cells, firsts: list[int], most: int) -> list[tuple[int, int, int]]:
    """(first key, shard, rows of the shard before) of ranges of about ``most`` bytes; ``firsts`` are cells that begin shards 1, 2, …"""
    out, size, rows, shard = [(0, 0, 0)], 0, 0, 0
    for k, start in enumerate(cells.starts):
        while shard < len(firsts) and firsts[shard] <= k:
            shard, size, rows = shard + 1, 0, 0
            out.append((start, shard, 0))
        if size and size + cells.size[k] > most:
            out.append((start, shard, rows))
            size = 0
        size, rows = size + cells.size[k], rows + cells.rows[k]
    return out


def row_key(text: Column, place: Column) -> Column:
    """The key as a long whose bits, read as unsigned, are in order."""
    low = (1 << 64 - GROUP_BITS) - 1
    return F.xxhash64(text).bitwiseAND(F.lit(~low)).bitwiseOR(F.xxhash64(place).bitwiseAND(F.lit(low)))


def sharded(docs: DataFrame, text: str = "text", shards: int = SHARDS, tolerance: float = TOLERANCE, range_bytes: int = RANGE_BYTES, names: tuple[str, str, str] = ("size", "shard", "slot")) -> DataFrame:
    """``docs`` with their size, their shard and their place in it, both from 0; each partition is a run of ranges in the order of slots.

    Written partitioned by shard, it is the shards.
    """
    size, shard, slot = (free_name(docs, n) for n in names)
    key, place = free_name(docs, "shard_key"), free_name(docs, "shard_place")
    body = F.coalesce(F.col(text), F.lit(""))
    placed = docs.withColumn(place, F.monotonically_increasing_id())
    keyed = staged(placed.withColumns({size: (F.octet_length(body) + 1).cast("long"), key: row_key(body, F.col(place))}))
    cells, wanted, slack = refined(keyed, key, size, shards, tolerance, range_bytes)
    most = max(range_bytes, sum(cells.size) // MOST_RANGES)
    cut = ranges(cells, boundaries(cells, wanted, slack), most)
    # Where shards are empty, several ranges begin at one key, and the last of them has the rows.
    number = free_name(keyed, "shard_range")
    at = keyed.withColumn(number, range_of(F.col(key), [first for first, _, _ in cut]))
    known = docs.sparkSession.createDataFrame([(k, s, r) for k, (_, s, r) in enumerate(cut)], f"{number} int, {shard} int, before long")
    order = W.partitionBy(number).orderBy(_signed(F.col(key)), place)
    numbered = at.withColumn(slot, F.row_number().over(order).cast("long"))
    joined = numbered.join(F.broadcast(known), number)  # at most MOST_RANGES ranges and a few for each shard
    return joined.select(*docs.columns, size, shard, (F.col(slot) - 1 + F.col("before")).alias(slot))


def _signed(key: Column) -> Column:
    """The key as a signed number of the same order."""
    return key.bitwiseXOR(F.lit(-(1 << 63)))


def range_of(key: Column, firsts: list[int]) -> Column:
    """The last place in the ordered ``firsts`` whose key isn't above ``key``, by binary search."""
    known = F.split(F.lit(",".join(str(first - (1 << 63)) for first in firsts)), ",").cast("array<long>")
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(len(firsts).bit_length()))])
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when(F.get(known, at + step) <= _signed(key), at + step).otherwise(at))


def op12_sharding(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    crc = F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32")
    law, none = F.lit("bytes").alias("law"), F.lit(None).cast("int").alias("grown_shard")
    return sharded(docs).select("doc_id", "size", crc, law, "shard", "slot", none)
