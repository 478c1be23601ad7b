"""MinHash near-dedup with dart signatures, banded joins and exact verification.

The elements of a text are its shingles of five words (`alnum_words`; a text of one to four words is one shingle), weighted by
how often they occur; the similarity of two texts is the weighted Jaccard similarity, the sum of the smaller over the sum of
the larger weights. Texts are linked from `SIMILARITY` on, and classes are the connected components of links.

Signatures. Every element has a region: its weight wide, and divided into cells [0, 1), [1, 2), [2, 4) ... A seeded process throws
darts into a cell, in an order of rising ranks and at a rate of the cell's width; a dart counts if it falls below the element's
weight. Each dart carries a coordinate, and a text keeps the earliest dart of every coordinate. Two texts agree in a coordinate
with a probability of their similarity. A text only follows its darts up to a rank by which all its coordinates are expected to be
hit (or further, if one is not), so that the work is the number of elements plus a few darts per coordinate.

From signatures to classes, without all pairs of a group:

1. Texts with equal words are one node, whatever their number.
2. Nodes that agree in all coordinates of a band share a bucket. Buckets of one node are dropped.
3. Stars (twice, with different centres): in every bucket that holds several components, each node of another component than the
   centre's is a candidate of the centre; of a node's candidates, the one that agrees in most coordinates is verified on the
   whole texts. Verified links join components. This is linear in the bucket.
4. The rest: in buckets that still hold several components, each node outside the bucket's largest component is compared with
   every node of other components. Both sides are dealt into chunks of about `CHUNK` nodes, and a group is one chunk against
   one, whatever the bucket's size. Pairs that agree in `LEAST_AGREEMENT` of the coordinates (five standard deviations below the
   threshold) are verified on all their shingles inside the group, in the first band that they share, and only links leave it.
   No partner is dropped.

So every pair of nodes that shares a bucket is either inside one component, or verified, or too far apart by its signatures. A pair
at the threshold shares no bucket with a probability of 5e-5, (1 - 0.8^5)^25, and is too far apart by its signatures with one of 4e-7.

What is joined with whole documents is sent to all tasks only after a count shows that it is small (`SMALL_ROWS`).

A null text is empty. A text without words is only like texts of the same characters. Null ids are grouped like others. An empty
table gives an empty result. Repeated rows are copies.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeworks.llm.columns import alnum_words, append_columns, free_name, mixed, staged, word_hashes

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 25, 5
COORDINATES = BANDS * ROWS
LEAST_AGREEMENT = 0.62
CHUNK = 512
ROUNDS = 2
#: A table of ids and hashes with at most so many rows (about 30 MB) is broadcast.
SMALL_ROWS = 500_000

_U = np.uint64
_MULTIPLIERS = np.random.default_rng(3).integers(1, 2**63, SHINGLE, dtype=np.uint64) | _U(1)


# ---- signatures -----------------------------------------------------------------------------------------------------


def elements(hashes: np.ndarray, at: np.ndarray, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, hash and weight of every different shingle, given the texts' `word_hashes`."""
    owner, shingle = [], []
    counts = np.diff(at)
    if len(hashes) >= size:
        sums = np.zeros(len(hashes) - size + 1, np.uint64)
        for k in range(size):
            sums += hashes[k : len(hashes) - size + 1 + k] * _MULTIPLIERS[k]
        whole = np.repeat(np.arange(len(counts)), counts)
        inside = whole[: len(sums)] == whole[size - 1 :]
        owner.append(whole[: len(sums)][inside])
        shingle.append(sums[inside])
    for k in np.flatnonzero((counts > 0) & (counts < size)):
        owner.append(np.array([k]))
        shingle.append((hashes[at[k] : at[k + 1]] * _MULTIPLIERS[: counts[k]]).sum(keepdims=True))
    if not owner:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0)
    owners, shingles = np.concatenate(owner), mixed(np.concatenate(shingle))
    order = np.lexsort((shingles, owners))
    owners, shingles = owners[order], shingles[order]
    first = np.ones(len(owners), bool)
    first[1:] = (owners[1:] != owners[:-1]) | (shingles[1:] != shingles[:-1])
    starts = np.flatnonzero(first)
    return owners[starts], shingles[starts], np.diff(np.append(starts, len(owners))).astype(np.float64)


def dart_signatures(owners: np.ndarray, keys: np.ndarray, weights: np.ndarray, n: int, k: int = COORDINATES) -> np.ndarray:
    """Signatures, one row of ``k`` dart numbers for each of ``n`` weighted sets; empty sets have zeros.

    ``owners`` are the sets of the elements ``keys``, with positive real ``weights``.
    """
    best = np.full(n * k, np.inf)
    found = np.zeros(n * k, np.uint64)
    total = np.bincount(owners, weights, n)
    limit = np.divide(k * (np.log(k) + 3), total, out=np.zeros(n), where=total > 0)
    todo = total > 0
    while todo.any():
        some = todo[owners]
        _throw(owners[some], keys[some], weights[some], limit, k, best, found)
        todo &= np.isinf(best.reshape(n, k)).any(axis=1)
        limit[todo] *= 2
        best.reshape(n, k)[todo] = np.inf
    return found.reshape(n, k)


def _throw(owners, keys, weights, limit, k, best, found) -> None:
    cell = 0
    low, width = 0.0, 1.0
    while len(owners):
        rank = np.zeros(len(owners))
        mine, key, weight = owners, keys ^ mixed(np.full(1, cell + 1, np.uint64)), weights
        step = 0
        while len(mine):
            dart = mixed(key + _U(step * 0x9E3779B97F4A7C15 % 2**64))
            gap = ((dart >> _U(11)).astype(np.float64) + 0.5) * 2.0**-53
            rank = rank - np.log(gap) / width
            on = rank < limit[mine]
            mine, key, weight, rank, dart = mine[on], key[on], weight[on], rank[on], dart[on]
            number = mixed(dart ^ _U(0xD6E8FEB86659FD93))
            depth = (number >> _U(11)).astype(np.float64) * 2.0**-53
            hits = np.flatnonzero(low + depth * width < weight)
            place = mine[hits] * k + (mixed(number[hits]) % _U(k)).astype(np.int64)
            np.minimum.at(best, place, rank[hits])
            won = best[place] == rank[hits]
            found[place[won]] = number[hits][won]
            step += 1
        low, width, cell = low + width, max(low + width, 1.0), cell + 1
        on = weights > low
        owners, keys, weights = owners[on], keys[on], weights[on]


def band_keys(signatures: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    out = np.zeros((len(signatures), bands), np.uint64)
    for r in range(rows):
        out = mixed(out + signatures[:, r :: rows][:, :bands] + _U(r + 1))
    return out.view(np.int64)


def similarity(a: bytes | None, b: bytes | None, size: int = SHINGLE) -> float:
    """Exact weighted Jaccard similarity of two texts; 0 if one has no words."""
    x, y = (_shingles(alnum_words(t or b""), size) for t in (a, b))
    both = sum((x & y).values())
    return both / (x.total() + y.total() - both) if both else 0.0


def _shingles(words: list[bytes], size: int) -> Counter:
    return Counter(zip(*(words[k:] for k in range(size)))) if len(words) >= size else Counter([tuple(words)] if words else [])


# ---- classes --------------------------------------------------------------------------------------------------------

NODE = T.StructField("node", T.BinaryType())
SIGNED = T.StructType([NODE, T.StructField("signature", T.BinaryType()), T.StructField("bands", T.ArrayType(T.LongType()))])


def signed(texts: list[bytes | None]) -> list:
    """Node, signature and band keys of each text; without words the last two are null.

    A node is the same for texts of equal words; for texts without words, of equal characters.
    """
    hashes, at = word_hashes(texts)
    ends = at.tolist()
    nodes = [
        xxhash.xxh3_128_digest(hashes[a:b].tobytes() if b > a else b"no words" + (t or b"")) for t, a, b in zip(texts, ends, ends[1:])
    ]
    owners, keys, weights = elements(hashes, at)
    signatures = dart_signatures(owners, keys, weights, len(texts))
    full = [b > a for a, b in zip(ends, ends[1:])]
    bands = band_keys(signatures)
    return [
        nodes,
        [s.tobytes() if f else None for s, f in zip(signatures.astype("<u4"), full)],
        pa.array([x if f else None for x, f in zip(bands, full)], pa.list_(pa.int64())),
    ]


SHINGLED = T.StructType([T.StructField("keys", T.BinaryType()), T.StructField("weights", T.BinaryType())])


def shingles(texts: list[bytes | None]) -> list:
    """Ordered hashes of each text's different shingles, and how often they occur, as bytes."""
    owners, keys, weights = elements(*word_hashes(texts))
    at = np.searchsorted(owners, np.arange(len(texts) + 1))
    return [[part[a:b].astype(kind).tobytes() for a, b in zip(at, at[1:])] for part, kind in ((keys, "<u8"), (weights, "<u4"))]


class ShingleIndex:
    """Weighted Jaccard similarity of a text to many, by their `shingles`."""

    def __init__(self, rows: list[tuple[bytes, bytes]]):
        keys = [np.frombuffer(k, "<u8") for k, _ in rows]
        weights = [np.frombuffer(w, "<u4").astype(np.int64) for _, w in rows]
        self.totals = np.array([w.sum() for w in weights], np.int64)
        owner = np.repeat(np.arange(len(rows)), [len(k) for k in keys])
        every = np.concatenate(keys) if rows else np.zeros(0, np.uint64)
        order = np.argsort(every, kind="stable")
        self.keys, self.owner = every[order], owner[order]
        self.weights = np.concatenate(weights)[order] if rows else np.zeros(0, np.int64)

    def similarities(self, keys: bytes, weights: bytes) -> np.ndarray:
        mine, weight = np.frombuffer(keys, "<u8"), np.frombuffer(weights, "<u4").astype(np.int64)
        low, high = np.searchsorted(self.keys, mine, "left"), np.searchsorted(self.keys, mine, "right")
        counts = high - low
        at = np.repeat(low - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
        both = np.bincount(self.owner[at], np.minimum(np.repeat(weight, counts), self.weights[at]), len(self.totals))
        return both / np.maximum(self.totals + weight.sum() - both, 1)


def small(df: DataFrame, rows: int = SMALL_ROWS) -> DataFrame:
    """``df``, a staged table, marked for broadcast if it has few rows."""
    return F.broadcast(df) if df.count() <= rows else df


def agreement(a: bytes, b: bytes) -> float:
    return float((np.frombuffer(a, "<u4") == np.frombuffer(b, "<u4")).mean())


def components(links: DataFrame) -> DataFrame:
    """(node, label) of every node in ``links`` (a, b); the label is the component's smallest node.

    Large-star and small-star steps alternate until nothing changes; each is two aggregations or joins over the links.
    """
    edges = staged(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct())
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").unionByName(least.select("a", F.col("m").alias("b")))
        edges = staged(small.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    star = edges.select(F.col("a").alias("node"), F.col("b").alias("label"))
    return star.unionByName(star.select(F.col("label").alias("node"), "label")).distinct()


def _verified(pairs: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) of nodes whose whole texts are similar enough."""
    joined = pairs.join(texts.select(F.col("node").alias("a"), F.col("body").alias("x")), "a").join(texts.select(F.col("node").alias("b"), F.col("body").alias("y")), "b")
    scored = append_columns(
        joined, ["x", "y"], T.StructType([T.StructField("similarity", T.DoubleType())]), lambda xs, ys: [[similarity(x, y) for x, y in zip(xs, ys)]]
    )
    return staged(scored.where(F.col("similarity") >= threshold).select("a", "b", "similarity"))


def _agreeing(pairs: DataFrame, signed: DataFrame, least: float) -> DataFrame:
    """(a, b, agreement) of the pairs whose signatures agree in a share ``least``."""
    sides = pairs.join(signed.select(F.col("node").alias("a"), F.col("signature").alias("x")), "a").join(signed.select(F.col("node").alias("b"), F.col("signature").alias("y")), "b")
    scored = append_columns(
        sides, ["x", "y"], T.StructType([T.StructField("agreement", T.DoubleType())]), lambda xs, ys: [[agreement(x, y) for x, y in zip(xs, ys)]]
    )
    return scored.where(F.col("agreement") >= least).select("a", "b", "agreement")


def _several(members: DataFrame, labels: DataFrame, salt: int) -> DataFrame:
    """Members, with their labels, of buckets with more than one label; with the bucket's size and centre."""
    named = members.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    buckets = named.groupBy("band", "bucket").agg(
        F.count("*").alias("size"),
        F.min("label").alias("l1"),
        F.max("label").alias("l2"),
        F.min(F.struct(F.xxhash64(F.lit(salt), "node").alias("h"), "node", "label")).alias("centre"),
    )
    return named.join(buckets.where("l1 <> l2").select("band", "bucket", "size", "centre"), ["band", "bucket"])


def _merge(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Labels after joining the components that ``links`` (a, b) connect."""

    def named(side: str) -> DataFrame:
        return labels.select(F.col("node").alias(side), F.col("label").alias(f"label_{side}"))

    pairs = links.select("a", "b").join(named("a"), "a", "left").join(named("b"), "b", "left")
    pairs = pairs.select(F.coalesce("label_a", "a").alias("a"), F.coalesce("label_b", "b").alias("b"))
    new = components(pairs).select(F.col("node").alias("label"), F.col("label").alias("to"))
    old = labels.join(new, "label", "left").select("node", F.coalesce("to", "label").alias("label"))
    alone = new.select(F.col("label").alias("node"), F.col("to").alias("label")).join(labels.select("node"), "node", "left_anti")
    return staged(old.unionByName(alone))


PAIR = "a binary, b binary"


def _far_links(several: DataFrame, nodes: DataFrame, least: float, threshold: float) -> DataFrame:
    """Links between different components, see step 4 above. ``nodes`` has signature, bands, keys and weights of a node."""
    counts = several.groupBy("band", "bucket", "label").agg(F.count("*").alias("n"))
    sizes = counts.groupBy("band", "bucket").agg(F.max(F.struct("n", "label")).alias("top"), F.sum("n").alias("all"))
    rows = several.select("band", "bucket", "node", "label").join(sizes, ["band", "bucket"])
    outside = F.col("label") != F.col("top.label")
    lefts = F.ceil(F.col("all") / CHUNK).cast("int")
    rights = F.ceil((F.col("all") - F.col("top.n")) / CHUNK).cast("int")
    key = ["band", "bucket", "left", "right"]
    one = rows.select(
        "band", "bucket", F.pmod(F.xxhash64("node"), lefts).cast("int").alias("left"), F.explode(F.sequence(F.lit(0), rights - 1)).alias("right"), F.lit(0).alias("side"), outside.alias("outside"), "node", "label"
    )
    other = rows.where(outside).select(
        "band", "bucket", F.explode(F.sequence(F.lit(0), lefts - 1)).alias("left"), F.pmod(F.xxhash64("node"), rights).cast("int").alias("right"), F.lit(1).alias("side"), outside.alias("outside"), "node", "label"
    )
    dealt = one.unionByName(other).join(nodes, "node").select(*key, "side", "outside", "node", "label", "signature", "bands", "keys", "weights")

    def group(rows: list[dict]) -> list[tuple[bytes, bytes]]:
        band = rows[0]["band"]
        sides = [[r for r in rows if r["side"] == k] for k in (0, 1)]
        signatures, bands, labels = (
            [np.array([f(r) for r in side]) for side in sides]
            for f in (lambda r: np.frombuffer(r["signature"], "<u4"), lambda r: r["bands"], lambda r: r["label"].hex())
        )
        index = ShingleIndex([(r["keys"], r["weights"]) for r in sides[1]])
        out = []
        for k, r in enumerate(sides[0]):
            far = np.flatnonzero(labels[1] != labels[0][k])
            far = far[(signatures[1][far] == signatures[0][k]).mean(axis=1) >= least]
            far = far[(bands[1][far, :band] != bands[0][k][:band]).all(axis=1)]
            # Two nodes outside meet twice, once on either side.
            far = [j for j in far if not r["outside"] or r["node"] < sides[1][j]["node"]]
            if far:
                near = index.similarities(r["keys"], r["weights"])
                out += [(r["node"], sides[1][j]["node"]) for j in far if near[j] >= threshold]
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[dict] = []
        now = None
        for batch in batches:
            found = []
            for r in batch.to_pylist():
                this = (r["band"], r["bucket"], r["left"], r["right"])
                if this != now and kept:
                    found += group(kept)
                    kept = []
                now = this
                kept.append(r)
            yield pairs(found)
        if kept:
            yield pairs(group(kept))

    def pairs(found: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.binary()) for k in (0, 1)], names=["a", "b"])

    return dealt.repartition(*key).sortWithinPartitions(*key).mapInArrow(run, "a binary, b binary").distinct()


def near_classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = SIMILARITY) -> tuple[DataFrame, DataFrame]:
    """(id, hash, node) of every row, and (node, label) of the nodes that are linked to others.

    ``hash`` is xxhash64 of the text. Both tables are staged.
    """
    rows = docs.select(F.col(doc_id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("body")).withColumn("hash", F.xxhash64("body"))
    keyed = staged(append_columns(rows, ["body"], SIGNED, signed).drop("body"))
    banded = keyed.select("node", F.posexplode("bands").alias("band", "bucket"))
    shared = banded.groupBy("band", "bucket").agg(F.min("node").alias("x"), F.max("node").alias("y")).where("x <> y").select("band", "bucket")
    members = staged(banded.join(shared, ["band", "bucket"]).distinct())
    near = small(staged(members.select("node").distinct()))
    nodes = keyed.join(near, "node")
    signed_nodes = staged(nodes.select("node", "signature", "bands").dropDuplicates(["node"]))
    places = small(staged(nodes.groupBy("node").agg(F.min(F.struct("id", "hash")).alias("p")).select("node", "p.id", "p.hash")))
    texts = rows.join(places, [rows["id"].eqNullSafe(places["id"]), rows["hash"] == places["hash"]]).select("node", "body")
    texts = staged(texts.dropDuplicates(["node"]))
    labels = docs.sparkSession.createDataFrame([], T.StructType([NODE, T.StructField("label", T.BinaryType())]))
    for salt in range(ROUNDS):
        stars = _several(members, labels, salt).where(F.col("label") != F.col("centre.label")).select(F.col("centre.node").alias("a"), F.col("node").alias("b")).distinct()
        best = _agreeing(stars, signed_nodes, LEAST_AGREEMENT).groupBy("b").agg(F.max_by("a", F.struct("agreement", "a")).alias("a"))
        labels = _merge(labels, _verified(staged(best.select("a", "b")), texts, threshold))
    shingled = append_columns(texts, ["body"], SHINGLED, shingles).drop("body")
    rest = _far_links(_several(members, labels, ROUNDS), signed_nodes.join(shingled, "node"), LEAST_AGREEMENT, threshold)
    return keyed.select("id", "hash", "node"), _merge(labels, staged(rest))


def classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = SIMILARITY) -> DataFrame:
    """One row per document: doc_id, class_id (the smallest id of its class) and class_size."""
    keyed, labels = near_classes(docs, doc_id, text, threshold)
    named = keyed.join(labels, "node", "left").select("id", F.coalesce("label", "node").alias("label"))
    sizes = named.groupBy("label").agg(F.min("id").alias("class_id"), F.count("*").alias("class_size"))
    return named.join(sizes, "label").select(F.col("id").alias("doc_id"), "class_id", "class_size")


def without_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = SIMILARITY) -> DataFrame:
    """``docs`` with one document of each class: the one with the smallest id, of equal ids that with the smallest hash."""
    keyed, labels = near_classes(docs, doc_id, text, threshold)
    named = keyed.join(labels, "node", "left").select("id", "hash", F.coalesce("label", "node").alias("label"))
    first = named.groupBy("label").agg(F.min(F.struct("id", "hash")).alias("first"))
    place = F.struct("id", "hash")
    copies = small(staged(named.join(first, "label").where(place != F.col("first")).select("id", "hash").distinct()))
    again = small(staged(keyed.groupBy("id", "hash").count().where("count > 1").select("id", "hash")))
    h = free_name(docs, "text_hash")
    hashed = docs.withColumn(h, F.xxhash64(F.coalesce(F.col(text), F.lit(""))))

    def same(df: DataFrame) -> list:
        return [hashed[doc_id].eqNullSafe(df["id"]), hashed[h] == df["hash"]]

    kept = hashed.join(copies, same(copies), "left_anti")
    single = kept.join(again, same(again), "left_anti").select(*docs.columns)
    # Rows that are equal in id and text: only these are brought together.
    group = free_name(docs, "row")
    repeated = kept.join(again, same(again), "left_semi").groupBy(doc_id, h).agg(F.first(F.struct(*[F.col(f"`{c}`") for c in docs.columns])).alias(group))
    return single.unionByName(repeated.select(f"{group}.*"))


def op3_near_dedup(spark, sf_dir: str) -> DataFrame:
    return classes(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
