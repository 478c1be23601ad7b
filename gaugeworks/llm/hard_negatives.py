"""Hard negatives by best-first search in STR-packed R-trees.

Vectors are made of whole numbers. An anchor's positives are the rows of its label with the greatest inner products; a positive's
hard negatives are the best rows of other labels whose inner product lies in a window below the positive's.

The rows are packed by sort-tile-recursive: dealt by label, then by slabs of the coordinate that varies most, then by the next one, into
regions of at most about `REGION` rows; and inside a region by label and further coordinates into leaves of `LEAF` rows, with `FANOUT`
nodes to a parent. A node has a minimum bounding box, its labels' range and its smallest id. An anchor's inner product with
anything in a box lies in the sum of the coordinates' intervals: upper = sum of max(a*low, a*high), lower likewise.
A search takes nodes from a queue, the greatest upper bound first. It leaves out boxes whose labels are of no use, boxes outside the
windows, and boxes strictly below the k-th best so far (or equal to it, with larger ids only); ties go to the smaller id.

Anchors are met with regions in blocks: a block is what a region has of anchors. Positives are sought in the regions that have the
block's labels, negatives in all. A task holds one region and at most `BLOCKS` blocks; Spark merges the best of all regions by
top-k windows, which cut each task's rows before the shuffle. The regions are a table and nothing is collected.

Scores are exact: products of whole numbers in doubles while they stay below 2^53, in Python's integers beyond; a score must fit a long.
Rows with a null id, label, vector or component, or with a component that isn't finite, take no part. A shorter vector counts as
ending in zeros. Other rows are those with another id; repeated rows each take part, as anchors too. An empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gaugeworks.llm.columns import release, staged

POSITIVES, NEGATIVES = 5, 5
#: A negative's score lies between LOW / 100 and HIGH / 100 of the positive's.
LOW, HIGH = 80, 100
REGION = 1 << 18
#: Small tables are cut into up to so many regions, of so many rows at least.
REGIONS, SMALL_REGION = 48, 1024
LEAF, FANOUT = 128, 16
#: Coordinates by which a region's rows are tiled.
TILED = 3
BLOCKS = 256
#: Rows on which the coordinates of slabs are chosen.
SAMPLE = 10_000


# ---- one region -----------------------------------------------------------------------------------------------------


def tiles(vectors: np.ndarray, rows: np.ndarray, coordinates: list[int]) -> Iterator[np.ndarray]:
    """``rows`` in leaves, by sort-tile-recursive over ``coordinates``."""
    leaves = math.ceil(len(rows) / LEAF)
    if leaves <= 1 or not coordinates:
        yield from (rows[k : k + LEAF] for k in range(0, len(rows), LEAF))
        return
    slabs = math.ceil(leaves ** (1 / len(coordinates)))
    step = LEAF * math.ceil(leaves / slabs)
    rows = rows[np.argsort(vectors[rows, coordinates[0]], kind="stable")]
    for k in range(0, len(rows), step):
        yield from tiles(vectors, rows[k : k + step], coordinates[1:])


def packing_order(vectors: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rows in the order of their leaves, and where leaves begin. A leaf has one label."""
    leaves = []
    for label in np.unique(labels):
        rows = np.flatnonzero(labels == label)
        coordinates = np.argsort(-vectors[rows].var(axis=0), kind="stable")[:TILED].tolist()
        leaves += tiles(vectors, rows, coordinates)
    sizes = np.cumsum([0, *map(len, leaves)])
    return np.concatenate(leaves), sizes[:-1]


def exact(numbers: np.ndarray) -> np.ndarray:
    """Python's integers."""
    out = np.empty(numbers.shape, object)
    out.reshape(-1)[:] = [int(x) for x in numbers.reshape(-1)]
    return out


@dataclass
class Level:
    """Nodes of one height: the first child of each (of rows or nodes, one more entry) and what bounds it."""

    first: np.ndarray
    low: np.ndarray
    high: np.ndarray
    labels: tuple[np.ndarray, np.ndarray]  # smallest and largest
    ids: np.ndarray  # smallest


class RTree:
    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, leaves: np.ndarray):
        self.ids, self.labels, self.vectors = ids, labels, vectors
        first, low, high, ranges, smallest = leaves, vectors, vectors, (labels, labels), ids
        self.levels: list[Level] = []
        size = len(ids)
        while True:
            low, high = np.minimum.reduceat(low, first, axis=0), np.maximum.reduceat(high, first, axis=0)
            ranges = (np.minimum.reduceat(ranges[0], first), np.maximum.reduceat(ranges[1], first))
            smallest = np.minimum.reduceat(smallest, first)
            self.levels.append(Level(np.append(first, size), low, high, ranges, smallest))
            if len(first) == 1:
                break
            size, first = len(first), np.arange(0, len(first), FANOUT)

    def search(self, anchor: np.ndarray, useful, windows: list[tuple[int, int]], k: int, wanted) -> list[list[tuple[int, int]]]:
        """For each window (low, high) of scores the ``k`` best (score, id) in it.

        ``useful`` tells from the smallest and largest labels which nodes may hold rows to look for, ``wanted`` from labels and ids
        which rows are such.
        """
        up, down = np.maximum(anchor, 0), np.minimum(anchor, 0)
        best: list[list[tuple[int, int]]] = [[] for _ in windows]  # (-score, id), ordered
        queue: list[tuple[int, int, int, int, int]] = []  # -upper, height, node, lower, smallest id

        def push(height: int, nodes: slice) -> None:
            level = self.levels[height]
            upper = level.high[nodes] @ up + level.low[nodes] @ down
            lower = level.low[nodes] @ up + level.high[nodes] @ down
            there = useful(level.labels[0][nodes], level.labels[1][nodes])
            for j in np.flatnonzero(there).tolist():
                node = nodes.start + j
                heapq.heappush(queue, (-int(upper[j]), height, node, int(lower[j]), int(level.ids[node])))

        def hopeful(upper: int, lower: int, smallest: int) -> bool:
            for (low, high), top in zip(windows, best):
                if lower <= high and upper >= low:
                    score = min(upper, high)
                    if len(top) < k or (-score, smallest) < top[-1]:
                        return True
            return False

        push(len(self.levels) - 1, slice(0, 1))
        while queue:
            upper, height, node, lower, smallest = heapq.heappop(queue)
            if not hopeful(-upper, lower, smallest):
                continue
            a, b = self.levels[height].first[node : node + 2].tolist()
            if height:
                push(height - 1, slice(a, b))
                continue
            scores = self.vectors[a:b] @ anchor
            fit = wanted(self.labels[a:b], self.ids[a:b])
            for w, (low, high) in enumerate(windows):
                rows = np.flatnonzero(fit & (scores >= low) & (scores <= high))
                if len(best[w]) == k:
                    rows = rows[scores[rows] >= -best[w][-1][0]]
                if len(rows):
                    found = sorted([*best[w], *((-int(s), int(i)) for s, i in zip(scores[rows], self.ids[a:b][rows]))])
                    best[w] = found[:k]
        return [[(-s, i) for s, i in top] for top in best]


# ---- on Spark -------------------------------------------------------------------------------------------------------

_REGION_SCHEMA = "region int, labels array<long>, ids binary, row_labels binary, leaves binary, vectors binary, a_labels array<long>, a_ids binary, a_row_labels binary, a_vectors binary"


def _usable(df: DataFrame, vec_id: str, vector: str, label: str, anchor: Column) -> DataFrame:
    v = F.col(vector).cast("array<double>")
    odd = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = df.where(F.col(vec_id).isNotNull() & F.col(label).isNotNull() & F.col(vector).isNotNull() & ~odd)
    return rows.select(F.col(vec_id).cast("long").alias("id"), F.col(label).cast("long").alias("label"), v.alias("v"), F.coalesce(anchor, F.lit(False)).alias("anchor"))


def _slab_coordinates(rows: DataFrame, n: int) -> tuple[int, int, list[float]]:
    """The two coordinates that vary most and the cuts of the first into slabs, on a sample; results don't depend on it."""
    some = rows.where(F.pmod(F.xxhash64("id"), F.lit(max(1, n // SAMPLE))) == 0).select(F.posexplode("v").alias("at", "x"))
    spread = some.groupBy("at").agg(F.var_pop("x").alias("spread"), F.percentile_approx("x", [k / 8 for k in range(1, 8)]).alias("cuts"))
    top = spread.orderBy(F.desc("spread"), "at").limit(2).collect()
    if not top:
        return 0, 0, []
    return top[0].at, top[-1].at, sorted(set(top[0].cuts))


def regions(rows: DataFrame, scale: int, n: int, width: int) -> DataFrame:
    """A row for each region: packed rows in the order of their leaves, and its anchors. Staged."""
    parts = max(-(-n // REGION), min(REGIONS, -(-n // SMALL_REGION)), 1)
    first, second, cuts = _slab_coordinates(rows, n)

    def coordinate(at: int) -> Column:
        return F.coalesce(F.get("v", F.lit(at)), F.lit(0.0))

    slab = F.size(F.filter(F.array(*map(F.lit, cuts)), lambda c: c < coordinate(first))) if cuts else F.lit(0)
    dealt = rows.repartitionByRange(parts, "label", slab, coordinate(second), "id", F.xxhash64("id", "v"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, labels, anchors, vectors = [], [], [], []
        for batch in batches:
            if batch.num_rows:
                v = batch.column(2)
                lengths = v.value_lengths().to_numpy()
                matrix = np.zeros((len(lengths), width))
                matrix[np.repeat(np.arange(len(lengths)), lengths), np.concatenate([np.arange(k) for k in lengths])] = np.floor(v.flatten().to_numpy() * scale)
                for out, x in zip((ids, labels, anchors), (batch.column(0), batch.column(1), batch.column(3))):
                    out.append(x.to_numpy(zero_copy_only=False))
                vectors.append(small(matrix))
        if not ids:
            return
        i, of, chosen, matrix = map(np.concatenate, (ids, labels, anchors, vectors))
        order, leaves = packing_order(matrix.astype(np.float64), of)
        i, of, chosen, matrix = i[order], of[order], chosen[order], matrix[order]
        row = {"region": TaskContext.get().partitionId(), "labels": np.unique(of).tolist(), "ids": i.tobytes(), "row_labels": of.tobytes(), "leaves": leaves.tobytes(), "vectors": as_bytes(matrix)}
        row |= {"a_labels": np.unique(of[chosen]).tolist(), "a_ids": i[chosen].tobytes(), "a_row_labels": of[chosen].tobytes(), "a_vectors": as_bytes(matrix[chosen])}
        yield pa.RecordBatch.from_pylist([row], schema=_arrow(_REGION_SCHEMA))
        release()

    return staged(dealt.select("id", "label", "v", "anchor").mapInArrow(pack, _REGION_SCHEMA))


def _arrow(schema: str) -> pa.Schema:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64())}
    return pa.schema([(name, kinds[kind]) for name, kind in (field.split(" ") for field in schema.split(", "))])


def small(matrix: np.ndarray) -> np.ndarray:
    """The same whole numbers in two bytes where they fit."""
    return matrix.astype(np.int16) if matrix.size and np.abs(matrix).max() < 1 << 15 else matrix


def as_bytes(matrix: np.ndarray) -> bytes:
    return matrix.dtype.char.encode() + np.ascontiguousarray(matrix).tobytes()


def of_bytes(data: bytes, width: int, rows: int) -> np.ndarray:
    return np.frombuffer(data, np.dtype(chr(data[0])), offset=1).reshape(rows, width).astype(np.float64)


def _numbers(data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.int64)


def _tree(row: dict, width: int) -> RTree:
    ids = _numbers(row["ids"])
    return RTree(ids, _numbers(row["row_labels"]), of_bytes(row["vectors"], width, len(ids)), _numbers(row["leaves"]))


def _met(regions_: DataFrame, blocks: DataFrame, pairs: DataFrame, search, schema: str, width: int, groups: int) -> DataFrame:
    """``search(tree, block)`` gives rows of ``schema`` for each pair (block, to) of a block and a region."""
    arrow = _arrow(schema)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = [[] for _ in arrow]
        for region in left.to_pylist() if right.num_rows else []:
            tree = _tree(region, width)
            for k in range(right.num_rows):
                for row in search(tree, right.slice(k, 1).to_pylist()[0]):
                    for column, value in zip(out, row):
                        column.append(value)
        return pa.table([pa.array(c, f.type) for c, f in zip(out, arrow)], schema=arrow)

    sent = pairs.join(blocks, "block").withColumn("part", F.pmod("block", F.lit(groups)))
    there = regions_.select(F.col("region").alias("to"), "ids", "row_labels", "leaves", "vectors", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("part"))
    return there.groupBy("to", "part").cogroup(sent.groupBy("to", "part")).applyInArrow(run, schema)


def _anchors(block: dict, width: int, tree: RTree):
    """(number, id, label, vector) of each anchor of a block, the tree's numbers exact beside it."""
    ids, labels = _numbers(block["a_ids"]), _numbers(block["a_row_labels"])
    vectors = of_bytes(block["a_vectors"], width, len(ids))
    largest = [float(np.abs(x).max()) if x.size else 0.0 for x in (vectors, tree.vectors)]
    if width * largest[0] * largest[1] * HIGH >= 2.0**53:
        vectors, tree = exact(vectors), RTree(tree.ids, tree.labels, exact(tree.vectors), tree.levels[0].first[:-1])
    return tree, zip(range(len(ids)), ids.tolist(), labels.tolist(), vectors)


def hard_negatives(df: DataFrame, anchor: Column, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label", scale: int = 256, positives: int = POSITIVES, negatives: int = NEGATIVES) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score; a component x counts as floor(scale * x)."""
    rows = _usable(df, vec_id, vector, label, anchor)
    n, width = rows.agg(F.count("*"), F.max(F.size("v"))).first()
    width = width or 0
    packed = regions(rows, scale, n, width)
    blocks = packed.where(F.size("a_labels") > 0).select(F.col("region").alias("block"), "a_ids", "a_row_labels", "a_vectors", "a_labels")
    most = packed.agg(F.max("region")).first()[0] or 0
    groups = -(-(most + 1) // BLOCKS)

    def positive(tree: RTree, block: dict) -> Iterator[tuple]:
        tree, anchors = _anchors(block, width, tree)
        everything = [(-(1 << 63), (1 << 63) - 1)]
        for at, own, of, vector in anchors:
            found = tree.search(vector, lambda a, b: (a <= of) & (of <= b), everything, positives, lambda x, i: (x == of) & (i != own))
            yield from ((block["block"], at, score, i) for score, i in found[0])

    def negative(tree: RTree, block: dict) -> Iterator[tuple]:
        tree, anchors = _anchors(block, width, tree)
        known: dict[int, list] = {}
        for p in block["found"]:
            known.setdefault(p["at"], []).append(p)
        for at, own, of, vector in anchors:
            found = sorted((p["place"], p["score"], p["id"]) for p in known.get(at, ()))
            windows = [(-(-LOW * s // 100), s * HIGH // 100) for _, s, _ in found]
            best = tree.search(vector, lambda a, b: (a != of) | (b != of), windows, negatives, lambda x, i: x != of)
            for (place, s, p), top in zip(found, best):
                yield from ((block["block"], at, place, own, p, s, score, i) for score, i in top)

    same = blocks.select("block", F.explode("a_labels").alias("l")).join(packed.select(F.col("region").alias("to"), F.explode("labels").alias("l")), "l")
    order = (F.desc("score"), F.asc("id"))
    near = _met(packed, blocks.drop("a_labels"), same.select("block", "to").distinct(), positive, "block int, at int, score long, id long", width, groups)
    near = near.withColumn("place", F.row_number().over(W.partitionBy("block", "at").orderBy(*order))).where(F.col("place") <= positives)
    known = staged(near).groupBy("block").agg(F.collect_list(F.struct("at", "place", "score", "id")).alias("found"))  # a region's anchors
    everywhere = blocks.select("block", F.explode(F.sequence(F.lit(0), F.lit(most))).alias("to"))
    schema = "block int, at int, place int, anchor_id long, positive_id long, positive_score long, score long, id long"
    far = _met(packed, blocks.drop("a_labels").join(known, "block"), everywhere, negative, schema, width, groups)
    far = far.withColumn("rank", F.row_number().over(W.partitionBy("block", "at", "place").orderBy(*order))).where(F.col("rank") <= negatives)
    return far.select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def op11_hard_negatives(spark, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", "label")
    moved = vectors.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return hard_negatives(moved, F.col("vec_id") % 100 == 0)


OP11_SQL = f"""
WITH e AS (
  SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
s AS (
  SELECT a.r, a.vec_id AS anchor_id, b.r AS o, b.vec_id, a.label = b.label AS same,
    CAST(coalesce(list_sum(list_transform(list_zip(a.v, b.v), lambda z: z[1] * z[2])), 0) AS BIGINT) AS score
  FROM e a JOIN e b ON a.vec_id <> b.vec_id AND a.vec_id % 100 = 0
),
p AS (
  SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id, o) AS place
  FROM s WHERE same QUALIFY place <= {POSITIVES}
)
SELECT p.anchor_id, p.vec_id AS positive_id, CAST(row_number() OVER (PARTITION BY p.r, p.place ORDER BY s.score DESC, s.vec_id, s.o) AS INTEGER) AS rank,
  s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score
FROM p JOIN s ON p.r = s.r AND NOT s.same AND {LOW} * p.score <= 100 * s.score AND 100 * s.score <= {HIGH} * p.score
QUALIFY rank <= {NEGATIVES}
"""
