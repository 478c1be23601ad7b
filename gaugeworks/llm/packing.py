"""Best-fit packing of documents into sequences by a grouping genetic algorithm on islands.

A document's ids and its end id are cut into pieces of at most ``size`` ids; only a longer document is cut. A full piece is a
sequence of its own. The others are dealt by a hash into blocks of about `BLOCK` pieces, and each block is one small packing
problem, solved by several islands:

* an individual is a set of bins (a grouping of the block's pieces); one island starts from best-fit decreasing, every other
  individual from best fit in an order disturbed in its own way, so that islands differ;
* crossover injects whole well-filled bins of one parent into the other, drops the other's bins that hold a piece twice, and
  best-fits the displaced pieces; mutation empties a few badly filled bins and best-fits their pieces;
* the fitness rewards few and well-filled bins;
* each island is a row that any task can work on. It breeds until `PATIENCE` children in a row bring no better best one, at
  most `GENERATIONS` of them; then it sends its best individual to the next island of its block, for `EPOCHS` epochs. The
  best island's bins count. A block is done as soon as an island needs no more bins than the lengths allow at least.

A block's well-filled bins are final. What lies in the others goes, with that of the other blocks, to the next level, which is
packed in the same way. Where more than three quarters of the pieces lie in such bins, they hardly fit together better elsewhere: then
only an eighth of each block's bins, the emptiest, goes on. The last level is a single block. A level that gets hardly smaller
(its bins are as large as blocks) doubles the pieces of a block.

Null and empty texts are the end id alone. Rows with equal ids are packed as rows of their own. An empty table gives no pieces.
"""

from __future__ import annotations

import random
from bisect import bisect_left, insort
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gaugeworks.llm.columns import append_columns, staged
from gaugeworks.llm.tokens import REMEMBERED, encoder, ids_crc32

SIZE = 4096
END = 1
BLOCK = 2048
ISLANDS = 3
POPULATION = 6
GENERATIONS = 100
PATIENCE = 25
EPOCHS = 3
#: Bins that are at least so full stay; the pieces of others are packed again with those of other blocks.
WELL_FILLED = 0.995

Bins = list[list[int]]


def best_fit(lengths: list[int], items: list[int], bins: Bins, size: int) -> Bins:
    """``items``, longest first, each into the fullest bin that has room, else a new one. Changes ``bins``."""
    room = sorted((size - sum(lengths[i] for i in b), k) for k, b in enumerate(bins))
    for i in sorted(items, key=lambda i: (-lengths[i], i)):
        at = bisect_left(room, (lengths[i], -1))
        if at < len(room):
            left, k = room.pop(at)
        else:
            left, k = size, len(bins)
            bins.append([])
        bins[k].append(i)
        insort(room, (left - lengths[i], k))
    return bins


def disturbed(lengths: list[int], rng: random.Random, size: int) -> Bins:
    """Best fit in an order that follows the length more or less roughly."""
    least = rng.uniform(0.5, 1)
    room: list[tuple[int, int]] = []
    bins: Bins = []
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i] * rng.uniform(least, 1)):
        at = bisect_left(room, (lengths[i], -1))
        left, k = room.pop(at) if at < len(room) else (size, len(bins))
        if k == len(bins):
            bins.append([])
        bins[k].append(i)
        insort(room, (left - lengths[i], k))
    return bins


def fitness(lengths: list[int], bins: Bins, size: int) -> tuple[int, float]:
    """Fewer bins first, then fuller ones."""
    return -len(bins), sum((sum(lengths[i] for i in b) / size) ** 2 for b in bins)


def crossover(lengths: list[int], giver: Bins, taker: Bins, rng: random.Random, size: int) -> Bins:
    full = sorted(giver, key=lambda b: -sum(lengths[i] for i in b))[: max(1, len(giver) // 2)]
    injected = rng.sample(full, max(1, len(full) // 5))
    taken = {i for b in injected for i in b}
    kept = [b for b in taker if taken.isdisjoint(b)]
    placed = taken.union(*kept)
    return best_fit(lengths, [i for i in range(len(lengths)) if i not in placed], [list(b) for b in (*injected, *kept)], size)


def mutation(lengths: list[int], bins: Bins, rng: random.Random, size: int) -> Bins:
    order = sorted(range(len(bins)), key=lambda k: sum(lengths[i] for i in bins[k]))
    emptied = {*order[: max(1, len(order) // 20)], rng.randrange(len(bins))}
    return best_fit(lengths, [i for k in emptied for i in bins[k]], [list(b) for k, b in enumerate(bins) if k not in emptied], size)


def least_bins(lengths: list[int], size: int) -> int:
    return max(-(-sum(lengths) // size), sum(2 * n > size for n in lengths))


def evolve(
    lengths: list[int], population: list[Bins], seed: int, size: int = SIZE, individuals: int = POPULATION, generations: int = GENERATIONS, patience: int = PATIENCE, first: bool = True
) -> list[Bins]:
    """The island's population after some generations, best first; one individual if it has the least possible bins.

    An empty population is filled, with best-fit decreasing if this is the ``first`` island.
    """
    rng = random.Random(seed)
    if not lengths:
        return [[]]
    least = least_bins(lengths, size)
    if not population:
        plain = best_fit(lengths, list(range(len(lengths))), [], size)
        if len(plain) == least:
            return [plain]
        population = [plain] if first else []

    def rated(bins: Bins) -> tuple[tuple[int, float], Bins]:
        return fitness(lengths, bins, size), bins

    scored = [rated(p) for p in population]
    while len(scored) < individuals:
        scored.append(rated(disturbed(lengths, rng, size)))
    scored.sort(key=lambda x: x[0], reverse=True)
    del scored[individuals:]
    waited = 0
    for _ in range(generations):
        if len(scored[0][1]) == least or waited >= patience:
            break
        giver, taker = rng.sample(range(len(scored)), 2)
        child = crossover(lengths, scored[giver][1], scored[taker][1], rng, size)
        if rng.random() < 0.5:
            child = mutation(lengths, child, rng, size)
        child = rated(child)
        waited = 0 if child[0] > scored[0][0] else waited + 1
        # A child takes the worst place, unless it is worse still or here already.
        if child[0] > scored[-1][0] and all(child[0] != other for other, _ in scored):
            scored[-1] = child
            scored.sort(key=lambda x: x[0], reverse=True)
    return [p for _, p in scored][: 1 if len(scored[0][1]) == least else None]


def as_places(bins: Bins, n: int) -> list[int]:
    out = [0] * n
    for k, b in enumerate(bins):
        for i in b:
            out[i] = k
    return out


def as_bins(places: list[int]) -> Bins:
    bins: Bins = [[] for _ in range(max(places, default=-1) + 1)]
    for i, k in enumerate(places):
        bins[k].append(i)
    return [b for b in bins if b]


PIECE = "piece int, start long, length long, ids_crc32 long"


def cut(docs: DataFrame, tokenizer: str, text: str = "text", size: int = SIZE, end: int = END, out: str = "pieces", remembered: int = REMEMBERED) -> DataFrame:
    """``docs`` with an array ``out`` of its pieces; one narrow pass. A process remembers ``remembered`` words."""
    from pyspark.sql import types as T

    def work(texts: list) -> list:
        flat, at = encoder(tokenizer, remembered).encode(texts, end)
        return [[[_piece(k, flat[a:b], size) for k in range(max(1, -(-int(b - a) // size)))] for a, b in zip(at, at[1:])]]

    return append_columns(docs, [text], T.StructType([T.StructField(out, T.ArrayType(T.StructType.fromDDL(PIECE)))]), work)


def _piece(k: int, ids, size: int) -> dict:
    part = ids[k * size : (k + 1) * size]
    return {"piece": k, "start": k * size, "length": len(part), "ids_crc32": ids_crc32(part)}


ISLAND = "block long, island int, rows array<long>, lengths array<int>, population array<array<int>>"


def _islands(islands: DataFrame, size: int, epoch: int, tasks: int) -> DataFrame:
    """One epoch of every island."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                grown = evolve(r["lengths"], [as_bins(p) for p in r["population"]], hash((r["block"], r["island"], epoch)), size, first=r["island"] == 0)
                r["population"] = [as_places(p, len(r["lengths"])) for p in grown]
                yield pa.RecordBatch.from_pylist([r], schema=batch.schema)

    return islands.repartition(tasks, "block", "island").mapInArrow(run, ISLAND)


def _pack_level(pieces: DataFrame, blocks: int, size: int, islands: int, epochs: int) -> DataFrame:
    """``pieces`` (row, length) packed block by block: row, block, bin, offset, filled."""
    spark = pieces.sparkSession
    dealt = pieces.groupBy(F.pmod(F.xxhash64("row"), F.lit(blocks)).alias("block")).agg(F.array_sort(F.collect_list(F.struct("row", "length"))).alias("p"))
    rows = dealt.select(
        "block",
        F.explode(F.sequence(F.lit(0), F.lit(islands - 1))).alias("island"),
        F.col("p.row").alias("rows"),
        F.col("p.length").cast("array<int>").alias("lengths"),
        F.array().cast("array<array<int>>").alias("population"),
    )
    # The work of an island doesn't show in its bytes, so tasks aren't left to adaptive coalescing.
    tasks = min(blocks * islands, max(4 * spark.sparkContext.defaultParallelism, blocks * islands // 64))
    settled: list[DataFrame] = []  # islands of blocks that one of them has solved
    for epoch in range(epochs):
        if epoch:
            best = rows.select("block", ((F.col("island") + 1) % islands).alias("island"), F.element_at("population", 1).alias("guest"))
            rows = rows.join(best, ["block", "island"]).select(
                "block", "island", "rows", "lengths", F.array_union("population", F.array("guest")).alias("population")
            )
        rows = staged(_islands(rows, size, epoch, tasks))
        if epoch + 1 < epochs:
            state = rows.groupBy("block").agg(F.min(F.size("population")).alias("individuals"))
            settled.append(rows.join(state.where("individuals = 1"), "block", "left_semi"))
            rows = staged(rows.join(state.where("individuals > 1"), "block", "left_semi"))
            if rows.isEmpty():
                break
    for part in settled:
        rows = rows.unionByName(part)
    first = F.element_at("population", 1)
    ranked = rows.select("block", "rows", "lengths", first.alias("places"), F.array_max(first).alias("last_bin"), "island")
    chosen = ranked.groupBy("block").agg(F.min_by(F.struct("rows", "lengths", "places"), F.struct("last_bin", "island")).alias("c"))

    def lay(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                c = r["c"]
                out = []
                for k, b in enumerate(as_bins(c["places"])):
                    at, load = 0, sum(c["lengths"][i] for i in b)
                    for i in b:
                        out.append((c["rows"][i], r["block"], k, at, load / size))
                        at += c["lengths"][i]
                columns = list(zip(*out))
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["row", "block", "bin", "offset", "filled"])

    return chosen.mapInArrow(lay, "row long, block long, bin long, offset long, filled double")


def pack(pieces: DataFrame, size: int = SIZE, block: int = BLOCK, islands: int = ISLANDS, epochs: int = EPOCHS) -> DataFrame:
    """``pieces`` (a unique long ``row``, ``length``, anything else) with ``sequence_id`` and ``offset``."""
    spark = pieces.sparkSession
    full = pieces.where(F.col("length") >= size).select("row", (-F.col("row") - 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    rest = pieces.where(F.col("length") < size).select("row", F.col("length").cast("int").alias("length"))
    done = [full]
    level = 0
    while count := rest.count():
        blocks = -(-count // block)
        packed = staged(_pack_level(rest, blocks, size, islands, epochs), spark)
        bins = packed.groupBy("block", "bin").agg(F.first("filled").alias("filled"), F.count("*").alias("n"))
        loose = bins.where(F.col("filled") < WELL_FILLED)
        last = blocks == 1
        if not last and (loose.agg(F.sum("n")).first()[0] or 0) > 0.75 * count:
            emptiest = W.partitionBy("block").orderBy("filled", "bin")
            share = F.ceil(F.count("*").over(W.partitionBy("block")) / 8)
            loose = loose.withColumn("place", F.row_number().over(emptiest)).withColumn("share", share).where("place <= share")
        again = staged(packed.join(loose.select("block", "bin"), ["block", "bin"], "left_semi").select("row"), spark)
        final = packed if last else packed.join(loose.select("block", "bin"), ["block", "bin"], "left_anti")
        number = (F.lit(level << 56) + F.col("block") * F.lit(1 << 20) + F.col("bin")).alias("sequence_id")
        done.append(final.select("row", number, "offset"))
        if last:
            break
        rest = staged(rest.join(again, "row"), spark)
        if rest.count() > 0.9 * count:
            block *= 2
        level += 1
    placed = done[0]
    for d in done[1:]:
        placed = placed.unionByName(d)
    return pieces.join(placed, "row")


def pack_documents(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text", size: int = SIZE, remembered: int = REMEMBERED) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    rows = cut(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), tokenizer, size=size, remembered=remembered)
    pieces = rows.select("doc_id", F.explode("pieces").alias("p")).select("doc_id", "p.*")
    pieces = staged(pieces.withColumn("row", F.monotonically_increasing_id()))
    return pack(pieces, size).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op4_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), remembered=700_000)  # nothing else runs here
