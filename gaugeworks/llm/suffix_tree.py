"""Language-model scoring by a probabilistic suffix tree over tokens.

Tokens are words ``[^\\x20\\x09-\\x0D]+`` (A-Z lower-cased) and an end. The tree's symbols are the end, frequent words (a share of
`SYMBOL_SHARE` of all training tokens), and classes of the other words by their last two bytes, as far as a class is as frequent;
the rest is one class. So there are at most two symbols per `SYMBOL_SHARE` however large the corpus is, and a new word still says
something through its ending. Inside a class a word keeps its share by its own count plus one, and all new words together count
like one word that was never seen. The probability of a token is that of its symbol, given the symbols before it, times its share of
the symbol.

Contexts are the last one to `DEPTH` symbols; a text begins as if after an end. Of symbols, contexts that make up `CONTEXT_SHARE` of
all training tokens are candidates, which again bounds their number. A candidate is retained if its next symbols diverge enough from
those of its suffix: the log likelihood that they gain must exceed one per distinct next symbol (Akaike's criterion). Suffixes of
retained contexts are retained. Distributions are smoothed with the suffix's, weighted by the number of distinct next symbols; the
shortest is that of the counts plus one. What the longest retained suffix says is where the contexts of words begin.

Contexts of the words themselves, one to `DEPTH`, are candidates from `LEAST` training occurrences on, however large the corpus is.
The same test decides, against what the next shorter context of words gives at the same places (the symbols', at first), and the same
smoothing holds. A token is scored by its longest context of words that passes; contexts are looked up by hash, so that none needs
its suffixes to pass.

What it gathers grows with the corpus: the counts of all words, and of all contexts of words with what follows them. None of it is
collected or broadcast. Texts are packed into blocks of about `BLOCK_BYTES`; a block sends each of its distinct words once, the counts
are summed by word (a frequent word has one row per block), and come back to the block in the order of its words. For each depth a
block sends each distinct context with its next word once, then each distinct context once, to a bucket of hashes that adds them up and
answers in the block's order; so a frequent context has one entry per block too. A context that is longer is sent only where the
shorter one came back often enough. Words and contexts are told apart by 64-bit hashes. Only the symbols and the counts after
candidate contexts of symbols, both bounded as above, come to the driver and go back to the tasks.

A null text is empty and has the end alone. Repeated rows each count. Without training texts all that is known is that a text may
end or go on. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from gaugeworks.llm.columns import as_values, discard, hashed, mixed, release, slices, staged, word_codes

DEPTH = 3
SYMBOL_SHARE = 5e-4
CONTEXT_SHARE = 2e-4
#: Training occurrences of a context of words.
LEAST = 2
BLOCK_BYTES = 5 << 20
#: Places of the corpus for each bucket of hashes.
BUCKET = 1 << 20
#: Symbols are below 2 / SYMBOL_SHARE + 2, so a context of three fits a 64-bit number.
BITS = 12
END, REST = 0, 1

#: A-Z lower-cased, the six separators as spaces.
_TABLE = bytes(b + 32 if 0x41 <= b <= 0x5A else 0x20 if b == 0x20 or 0x09 <= b <= 0x0D else b for b in range(256))


def shape_of(word: bytes) -> int:
    """The last two bytes."""
    return int.from_bytes(word[-2:], "big")


@dataclass
class Symbols:
    """``words``: hashes of frequent words, ordered; ``shapes``: shapes of frequent classes, ordered. Their symbols follow `REST`."""

    words: np.ndarray
    shapes: np.ndarray
    mass: np.ndarray  # by symbol: the counts of its words, one more for each, and one for new words in a class
    counts: np.ndarray  # by symbol: the counts alone

    def of(self, words: np.ndarray, shapes: np.ndarray) -> np.ndarray:
        """Symbols of words, given by hash, with their shapes."""
        out = np.full(len(words), REST, np.uint16)
        for names, values, start in ((self.shapes, shapes, 2 + len(self.words)), (self.words, words, 2)):
            if len(names):
                at = np.minimum(np.searchsorted(names, values), len(names) - 1)
                hit = names[at] == values
                out[hit] = start + at[hit]
        return out


def choose_symbols(frequent: list[tuple[int, int, int]], shapes: list[tuple[int, int, int]], ends: int, least: float) -> Symbols:
    """From frequent words (hash, shape, count) and all shapes (shape, count of words, their sum, frequent words included)."""
    words = np.array(sorted(h for h, _, _ in frequent), np.int64)
    count = {h: c for h, _, c in frequent}
    own: dict[int, list[int]] = {}
    for _, s, c in frequent:
        x = own.setdefault(s, [0, 0])
        x[0] += 1
        x[1] += c
    others = {s: (n - own.get(s, (0, 0))[0], c - own.get(s, (0, 0))[1]) for s, n, c in shapes}
    kept = np.array(sorted(s for s, (n, c) in others.items() if n and c + n >= least), np.int64)
    rest = [others[s] for s in others.keys() - set(kept.tolist())]
    counts = [ends, sum(c for _, c in rest), *(count[h] for h in words.tolist()), *(others[s][1] for s in kept.tolist())]
    mass = [ends + 1, sum(n + c for n, c in rest) + 1, *(count[h] + 1 for h in words.tolist()), *(sum(others[s]) + 1 for s in kept.tolist())]
    if len(mass) > 1 << BITS:
        raise ValueError(f"{len(mass)} symbols; a larger symbol_share gives fewer")
    return Symbols(words, kept, np.array(mass, np.float64), np.array(counts, np.float64))


def contexts(symbols: np.ndarray, depth: int) -> np.ndarray:
    """The ``depth`` symbols before each place, the last one lowest; -1 where the text is too young. Texts end with `END`."""
    before = np.concatenate([[END], symbols[:-1]]).astype(np.int64) if len(symbols) else np.zeros(0, np.int64)
    out = before.copy()
    young = before == END  # here only the end before the text is behind
    for j in range(1, depth):
        earlier = np.concatenate([np.zeros(j, np.int64), before[:-j]]) if len(before) > j else np.zeros(len(before), np.int64)
        out |= earlier << BITS * j
        out[young] = -1
        young = young | (earlier == END)
    return out


def followers(symbols: np.ndarray, depth: int, candidates: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place in ``candidates`` << BITS | next symbol, count) of all places whose context is a candidate."""
    code = contexts(symbols, depth)
    if not len(candidates) or not len(code):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.minimum(np.searchsorted(candidates, code), len(candidates) - 1)
    hit = candidates[at] == code
    return np.unique(at[hit] << BITS | symbols[hit].astype(np.int64), return_counts=True)


@dataclass
class Tree:
    """Node 0 is nowhere, node 1 the empty context. Deeper nodes have larger numbers."""

    children: np.ndarray  # (nodes, symbols): the node that an earlier symbol leads to, 0 for none
    logs: np.ndarray  # (nodes, symbols): log10 of the next symbol's probability
    depth: int

    def score(self, symbols: np.ndarray, step: int = 1 << 20) -> np.ndarray:
        """log10 probability of each symbol of texts that end with `END`."""
        width = self.children.shape[1]
        children, logs = self.children.reshape(-1), self.logs.reshape(-1)
        out = np.empty(len(symbols))
        before = np.concatenate([np.full(self.depth, END, symbols.dtype), symbols])
        for a in range(0, len(symbols), step):
            n = min(step, len(symbols) - a)
            node = longest = np.ones(n, np.int64)
            for j in range(1, self.depth + 1):
                earlier = before[a + self.depth - j : a + self.depth - j + n]
                node = children.take(node * width + earlier)
                longest = np.maximum(longest, node)
                node = np.where(earlier == END, 0, node)  # nothing is behind a text's start
            out[a : a + n] = logs.take(longest * width + symbols[a : a + n])
        return out


def build(mass: np.ndarray, levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> Tree:
    """The tree from the symbols' masses and, for each depth, (contexts, next symbols, counts). All suffixes must be there."""
    width = len(mass)
    names = [np.zeros(1, np.int64)]
    dists = [(mass / mass.sum())[None, :]]
    keeps, parents = [np.ones(1, bool)], [np.zeros(1, np.int64)]
    for d, (context, symbol, n) in enumerate(levels, 1):
        own, row = np.unique(context, return_inverse=True)
        counts = np.zeros((len(own), width))
        counts[row, symbol] = n
        parent = np.searchsorted(names[d - 1], own & ((1 << BITS * (d - 1)) - 1))
        above = dists[d - 1][parent]
        distinct, sums = (counts > 0).sum(axis=1), counts.sum(axis=1)
        gain = (counts * np.log(np.where(counts > 0, counts / sums[:, None] / above, 1))).sum(axis=1)
        keeps.append(gain > distinct)
        dists.append((counts + distinct[:, None] * above) / (sums + distinct)[:, None])
        names.append(own)
        parents.append(parent)
    for d in range(len(levels), 1, -1):
        keeps[d - 1][parents[d][keeps[d]]] = True
    children = np.zeros((2 + sum(int(k.sum()) for k in keeps[1:]), width), np.int64)
    logs = [np.zeros((1, width)), np.log10(dists[0])]
    numbers, size = [np.ones(1, np.int64)], 2
    for d in range(1, len(levels) + 1):
        kept = np.flatnonzero(keeps[d])
        number = np.zeros(len(names[d]), np.int64)
        number[kept] = size + np.arange(len(kept))
        children[numbers[d - 1][parents[d][kept]], names[d][kept] >> BITS * (d - 1)] = number[kept]
        logs.append(np.log10(dists[d][kept]))
        numbers.append(number)
        size += len(kept)
    return Tree(children, np.concatenate(logs), max(len(levels), 1))


# ---- on Spark -------------------------------------------------------------------------------------------------------


def _squeezed(values: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(values).tobytes())


def _one_by_one(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Rows, each a block: a worker holds one beside the batch, and gives back what the last one took."""
    for batch in batches:
        for k in range(batch.num_rows):
            yield batch.slice(k, 1).to_pylist()[0]
            release()


def _array(kind: T.DataType) -> T.ArrayType:
    return T.ArrayType(kind)


def _blocks(docs: DataFrame, block_bytes: int) -> DataFrame:
    """Blocks of ``docs`` (id, held, body), packed where they are: documents, words as places among the block's distinct words,
    and these in the order of their hashes with their shapes and training counts; how many they are and how often they are spoken."""
    schema = T.StructType(
        [
            T.StructField("block", T.LongType()),
            T.StructField("ids", _array(docs.schema["id"].dataType)),
            T.StructField("held", _array(T.BooleanType())),
            T.StructField("lengths", _array(T.IntegerType())),
            *(T.StructField(c, T.BinaryType()) for c in ("codes", "words", "shapes", "counts")),
            *(T.StructField(c, T.LongType()) for c in ("distinct", "spoken")),
        ]
    )
    arrow = to_arrow_schema(schema)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, rows, size = 0, [], 0

        def close() -> pa.RecordBatch:
            ids, held, texts = zip(*rows)
            codes, words, at = word_codes(list(texts), _TABLE)
            lengths = np.diff(at)
            hashes = hashed(words)
            order = np.argsort(hashes, kind="stable")
            place = np.empty(len(order), np.uint32)
            place[order] = np.arange(len(order), dtype=np.uint32)
            codes = place[codes]
            counts = np.bincount(codes[np.repeat(~np.array(held, bool), lengths)], minlength=len(words))
            shapes = np.fromiter(map(shape_of, words), np.uint16, len(words))[order]
            row = [
                (TaskContext.get().partitionId() << 32) + number,
                list(ids),
                list(held),
                lengths,
                _packed(codes.astype("<u4")),
                _packed(hashes[order].astype("<u8")),
                _packed(shapes.astype("<u2")),
                _packed(counts.astype("<i8")),
                len(words),
                int(counts.sum()),
            ]
            return pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(row, arrow)], schema=arrow)

        for whole in batches:
            for batch in slices(whole, [2]):
                for doc, held, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), as_values(batch.column(2))):
                    rows.append((doc, held, body or b""))
                    size += len(rows[-1][2]) + 16
                    if size >= block_bytes:
                        yield close()
                        number, rows, size = number + 1, [], 0
        if rows:
            yield close()

    return staged(docs.mapInArrow(pack, schema), by="block")


_TOTALS = T.StructType(
    [
        T.StructField("of", T.LongType()),
        T.StructField("bucket", T.IntegerType()),
        T.StructField("counts", T.BinaryType()),
        T.StructField("frequent", _array(T.StructType([T.StructField("word", T.LongType()), T.StructField("shape", T.IntegerType()), T.StructField("c", T.LongType())]))),
        T.StructField("kinds", _array(T.StructType([T.StructField("shape", T.IntegerType()), T.StructField("n", T.LongType()), T.StructField("c", T.LongType())]))),
    ]
)


def _word_totals(blocks: DataFrame, buckets: int, least: float) -> DataFrame:
    """Training counts of words, added up by buckets of hashes: answered to each block in its order; and, in one more row without a
    block, the words with ``least`` and the sums by shape. Staged."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _one_by_one(batches):
            words = _unpacked(row["words"], "<u8")
            parts = _parts(row["block"], words, _unpacked(row["counts"], "<i8"), _unpacked(row["shapes"], "<u2").astype("<i8"), np.zeros(0, "<f8"), buckets)
            yield from _table(_SENT, parts).to_batches()

    def add(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["block"])
        keys = [_unpacked(r["keys"], "<u8") for r in rows]
        distinct, place = np.unique(np.concatenate(keys), return_inverse=True)
        counts = np.bincount(place, np.concatenate([_unpacked(r["counts"], "<i8") for r in rows]), len(distinct)).astype(np.int64)
        shapes = np.zeros(len(distinct), np.int64)
        shapes[place] = np.concatenate([_unpacked(r["also"], "<i8") for r in rows])
        at = np.cumsum([0, *map(len, keys)])
        out = [{"of": r["block"], "bucket": r["bucket"], "counts": _packed(counts[place[a:b]])} for r, a, b in zip(rows, at, at[1:])]
        often = np.flatnonzero(counts >= least)
        known = np.flatnonzero(counts)
        kinds, kind = np.unique(shapes[known], return_inverse=True)
        sums = np.bincount(kind, counts[known], len(kinds)).astype(np.int64)
        frequent = [{"word": w, "shape": s, "c": c} for w, s, c in zip(distinct[often].view(np.int64).tolist(), shapes[often].tolist(), counts[often].tolist())]
        by_kind = [{"shape": s, "n": n, "c": c} for s, n, c in zip(kinds.tolist(), np.bincount(kind, minlength=len(kinds)).tolist(), sums.tolist())]
        return _table(_TOTALS, [*out, {"bucket": rows[0]["bucket"], "frequent": frequent, "kinds": by_kind}])

    sent = blocks.select("block", "words", "shapes", "counts").mapInArrow(send, _SENT)
    return staged(sent.groupBy("bucket").applyInArrow(add, _TOTALS))


def _symbol_blocks(blocks: DataFrame, totals: DataFrame, symbols: Symbols, n: int, v: int) -> DataFrame:
    """Per block: documents with their sums that need word counts, their tokens as places among the end and the block's distinct
    words, and these with their hashes, training counts and symbols. Staged."""
    kind = blocks.schema["ids"].dataType
    doubles, longs = _array(T.DoubleType()), _array(T.LongType())
    documents = [("block", T.LongType()), ("ids", kind), ("held", _array(T.BooleanType())), ("n_tokens", longs), ("n_known", longs), ("base", doubles)]
    schema = T.StructType([T.StructField(c, t) for c, t in [*documents, *((c, T.BinaryType()) for c in ("codes", "words", "counts", "own"))]])
    arrow = to_arrow_schema(schema)
    ends = int(symbols.counts[END])

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        for row in _one_by_one(left.to_batches()):
            lengths = np.array(row["lengths"], np.int64)
            codes, words = _unpacked(row["codes"], "<u4"), _unpacked(row["words"], "<u8")
            answers = sorted(right.to_pylist(), key=lambda r: r["bucket"])
            c = np.concatenate([np.zeros(0, "<i8"), *(_unpacked(r["counts"], "<i8") for r in answers)])
            own = symbols.of(words.view(np.int64), _unpacked(row["shapes"], "<u2").astype(np.int64))
            docs, owner, at = len(lengths), np.repeat(np.arange(len(lengths)), lengths), np.cumsum(lengths)
            out.append(
                {
                    "block": row["block"],
                    "ids": row["ids"],
                    "held": row["held"],
                    "n_tokens": lengths + 1,
                    "n_known": np.bincount(owner, (c > 0)[codes], docs).astype(np.int64) + (ends > 0),
                    "base": np.bincount(owner, np.log10((c + 1) / (n + v + 1))[codes], docs) + np.log10((ends + 1) / (n + v + 1)),
                    "codes": _packed(np.insert(codes + np.uint32(1), at, 0).astype("<u4")),
                    "words": _packed(np.concatenate([[np.uint64(0)], words]).astype("<u8")),
                    "counts": _packed(np.concatenate([[ends], c]).astype("<i8")),
                    "own": _packed(np.concatenate([[END], own]).astype("<u2")),
                }
            )
        return pa.Table.from_pylist(out, schema=arrow)

    answered = totals.where("of is not null").select(F.col("of").alias("block"), "bucket", "counts")
    return staged(blocks.drop("counts", "distinct", "spoken").groupBy("block").cogroup(answered.groupBy("block")).applyInArrow(run, schema))


def _training_symbols(row: dict) -> np.ndarray:
    symbols = _unpacked(row["own"], "<u2").astype(np.int64)[_unpacked(row["codes"], "<u4")]
    return symbols[_training(row)]


def learn(symbol_blocks: DataFrame, symbols: Symbols, depth: int = DEPTH, share: float = CONTEXT_SHARE) -> Tree:
    """The tree of the training texts, one pass over the symbols for each depth."""
    least = max(1.0, share * symbols.counts.sum())
    levels = []
    candidates = np.flatnonzero(symbols.counts >= least).astype(np.int64)
    for d in range(1, depth + 1):
        if not len(candidates):
            break

        def count(batches: Iterator[pa.RecordBatch], d: int = d, candidates: np.ndarray = candidates) -> Iterator[pa.RecordBatch]:
            for row in _one_by_one(batches):
                keys, n = followers(_training_symbols(row), d, candidates)
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(n, pa.int64())], names=["key", "n"])

        rows = symbol_blocks.select("held", "n_tokens", "codes", "own").mapInArrow(count, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).toPandas()
        rows = rows.sort_values("key")
        key, n = rows["key"].to_numpy(np.int64), rows["n"].to_numpy(np.float64)
        context, symbol = candidates[key >> BITS], key & ((1 << BITS) - 1)
        levels.append((context, symbol, n))
        longer = (context << BITS | symbol)[(n >= least) & (symbol != END)]
        # The end before a text is not the end of another: a context never goes on behind it.
        candidates = np.sort(longer)
    return build(symbols.mass, levels)


# ---- contexts of words ----------------------------------------------------------------------------------------------


def _packed(values: np.ndarray) -> bytes:
    """Squeezed, first bytes first: most numbers are small, and hashes are in order."""
    return _squeezed(values.view(np.uint8).reshape(len(values), values.dtype.itemsize).T)


def _unpacked(data: bytes, kind: str) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).reshape(-1)


_DOCUMENTS = ("ids", "held", "n_tokens", "n_known", "base")
_SENT = T.StructType([T.StructField("block", T.LongType()), T.StructField("bucket", T.IntegerType()), *(T.StructField(c, T.BinaryType()) for c in ("keys", "counts", "also", "sums"))])
_BACK = T.StructType([*(T.StructField(c, t) for c, t in (("block", T.LongType()), ("of", T.IntegerType()), ("bucket", T.IntegerType()))), *_SENT.fields[3:]])


@dataclass
class Places:
    """The places of a block whose context of ``depth`` words is a candidate, in the order of the text."""

    codes: np.ndarray  # of all places; 0 is the end
    words: np.ndarray  # hashes by code
    at: np.ndarray
    lower: np.ndarray  # the probability of the token, given the next shorter context
    best: np.ndarray  # given the longest that passed

    @classmethod
    def of(cls, row: dict) -> Places:
        at = np.flatnonzero(np.unpackbits(_unpacked(row["open"], "u1")))
        lower = _unpacked(row["lower"], "<f4").astype(float)
        best = lower.copy()
        best[np.flatnonzero(np.unpackbits(_unpacked(row["apart"], "u1")))] = _unpacked(row["best"], "<f4")
        return cls(_unpacked(row["codes"], "<u4"), _unpacked(row["words"], "<u8"), at, lower, best)

    def row(self) -> dict:
        marks = np.zeros(len(self.codes), bool)
        marks[self.at] = True
        lower, best = self.lower.astype("<f4"), self.best.astype("<f4")
        apart = lower != best  # where the last context didn't pass
        return {"open": _packed(np.packbits(marks)), "lower": _packed(lower), "apart": _packed(np.packbits(apart)), "best": _packed(best[apart])}

    def keys(self, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of each place's context, and of the context with the token."""
        stream = np.concatenate([self.words[:1], self.words[self.codes]])  # the end before the first text
        context = np.zeros(len(self.at), np.uint64)
        for j in range(depth):
            context = mixed(context * np.uint64(0x9E3779B97F4A7C15) + stream[self.at - j] + np.uint64(1))
        return context, mixed(context * np.uint64(0x9E3779B97F4A7C15) + stream[self.at + 1] + np.uint64(1))


class Grouped:
    """What a block sends of its places: distinct grams (contexts with the next word), distinct contexts, and the gram of each place."""

    def __init__(self, places: Places, training: np.ndarray, depth: int):
        self.places, self.seen = places, training[places.at]
        self.context_at, grams = places.keys(depth)
        self.grams, self.gram = np.unique(grams, return_inverse=True)
        self.counts = np.bincount(self.gram[self.seen], minlength=len(self.grams)).astype(np.int64)

    def join_contexts(self) -> Grouped:
        """Adds the contexts, in order, and that of each gram: grams of a hash have one context, whichever place it is read from."""
        of = np.empty(len(self.grams), np.uint64)
        of[self.gram] = self.context_at
        self.contexts, self.context_of = np.unique(of, return_inverse=True)
        return self

    def of_contexts(self, totals: np.ndarray, mine: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """By context: occurrences here; distinct next words of the grams this block answers for (``mine``); and its part of what the
        context gains in log likelihood: what these grams say, less what the shorter context said at the places here."""
        mine = (mine > 0) & (totals > 0)
        size, owner = len(self.contexts), self.context_of
        logs = np.bincount(owner[self.gram[self.seen]], np.log(self.places.lower[self.seen]), size)
        gain = np.bincount(owner[mine], totals[mine] * np.log(totals[mine]), size) - logs
        count = np.bincount(owner, self.counts, size).astype(np.int64)
        return count, np.bincount(owner[mine], minlength=size).astype(np.int64), gain


def _parts(block: int, keys: np.ndarray, counts: np.ndarray, also: np.ndarray, sums: np.ndarray, buckets: int) -> list[dict]:
    """Rows of `_SENT` for each bucket of hashes: ranges of equal size, so the keys' order stays."""
    ends = np.searchsorted(keys >> np.uint64(32), [(k << 32) // buckets for k in range(1, buckets)] + [1 << 32])
    starts = [0, *ends[:-1].tolist()]
    return [
        {"block": block, "bucket": k, "keys": _packed(keys[a:b].view("<u8")), "counts": _packed(counts[a:b]), "also": _packed(also[a:b]), "sums": _packed(sums[a:b].astype("<f8"))}
        for k, (a, b) in enumerate(zip(starts, ends.tolist()))
        if b > a
    ]


def _added(table: pa.Table, second: bool) -> pa.Table:
    """One bucket: sums by key, answered to each block in its order. First, the counts, and to one of the blocks that have the key
    that it answers for it; then both counts, and whether a context of this count passes."""
    rows = sorted(table.to_pylist(), key=lambda r: r["block"])
    keys = [_unpacked(r["keys"], "<u8") for r in rows]
    distinct, place = np.unique(np.concatenate(keys), return_inverse=True)
    counts = np.bincount(place, np.concatenate([_unpacked(r["counts"], "<i8") for r in rows]), len(distinct)).astype(np.int64)
    if second:
        also = np.bincount(place, np.concatenate([_unpacked(r["also"], "<i8") for r in rows]), len(distinct)).astype(np.int64)
        sums = np.bincount(place, np.concatenate([_unpacked(r["sums"], "<f8") for r in rows]), len(distinct))
        passes = sums - counts * np.log(np.maximum(counts, 1)) > also
        answer = passes[place]
    else:
        last = np.empty(len(distinct), np.int64)
        last[place] = np.arange(len(place))
        answer = np.zeros(len(place), bool)
        answer[last] = True
    at = np.cumsum([0, *map(len, keys)])
    return _table(
        _BACK,
        [
            {"block": r["block"], "of": 1 + second, "bucket": r["bucket"], "counts": _packed(counts[place[a:b]]), "also": _packed(also[place[a:b]] if second else np.zeros(0, "<i8")), "sums": _packed(answer[a:b].view("u1"))}
            for r, a, b in zip(rows, at, at[1:])
        ],
    )


def _table(schema: T.StructType, rows: list[dict]) -> pa.Table:
    return pa.Table.from_pylist(rows, schema=to_arrow_schema(schema))


def _answers(table: pa.Table, of: int, kinds: tuple[str, ...]) -> list[np.ndarray]:
    """The columns of the answers of all buckets, in the order of the keys."""
    rows = sorted((r for r in table.to_pylist() if r["of"] == of), key=lambda r: r["bucket"])
    return [np.concatenate([np.zeros(0, k), *(_unpacked(r[c], k) for r in rows)]) for c, k in zip(("counts", "also", "sums"), kinds)]


def _training(row: dict) -> np.ndarray:
    return np.repeat(~np.array(row["held"], bool), row["n_tokens"])


def _sums_by_text(row: dict, at: np.ndarray, values: np.ndarray) -> np.ndarray:
    owner = np.searchsorted(np.cumsum(row["n_tokens"]), at, side="right")
    return np.bincount(owner, values, len(row["n_tokens"]))


def _settled(row: dict, places: Places, stay: np.ndarray) -> dict:
    """What changes in ``row`` when the places ``stay`` remain: the others' scores are added to their texts'."""
    done = np.array(row["done"]) + _sums_by_text(row, places.at[~stay], np.log10(places.best[~stay]))
    left = Places(places.codes, places.words, places.at[stay], places.lower[stay], places.best[stay])
    return {"done": done.tolist(), **left.row()}


def _open(tokens: DataFrame, tree: Tree, symbols: Symbols, least: int) -> DataFrame:
    """Blocks before the first depth: what the symbols say of each token, and places after a frequent enough word. Staged."""
    documents = [tokens.schema[c] for c in ("block", *_DOCUMENTS)]
    binary = [T.StructField(c, T.BinaryType()) for c in ("codes", "words", "open", "lower", "apart", "best")]
    schema = T.StructType([*documents, T.StructField("done", _array(T.DoubleType())), *binary])
    arrow = to_arrow_schema(schema)
    log_mass = np.log10(symbols.mass)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _one_by_one(batches):
            codes, counts = _unpacked(row["codes"], "<u4"), _unpacked(row["counts"], "<i8")
            own = _unpacked(row["own"], "<u2")
            inside = np.log10(counts + 1) - log_mass[own]  # of its symbol, a word's share
            inside[0] = 0  # the end is all of its own
            known = np.exp((tree.score(own[codes]) + inside[codes]) * np.log(10))
            places = Places(codes, _unpacked(row["words"], "<u8"), np.arange(len(codes)), known, known)
            row["done"] = [0.0] * len(row["ids"])
            row |= _settled(row, places, counts[np.concatenate([[0], codes[:-1]])] >= least)
            yield pa.RecordBatch.from_pylist([{f.name: row[f.name] for f in arrow}], schema=arrow)

    return staged(tokens.mapInArrow(run, schema), by="block")


def _deeper(state: DataFrame, depth: int, buckets: int, least: int, last: T.StructType | None, n: int) -> DataFrame:
    """Blocks after the contexts of ``depth`` words, staged; after the ``last`` depth, rows of this schema instead."""
    arrow = to_arrow_schema(last or state.schema)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _one_by_one(batches):
            own = Grouped(Places.of(row), _training(row), depth)
            nothing = np.zeros(0, "<i8")
            yield from _table(_SENT, _parts(row["block"], own.grams, own.counts, nothing, nothing, buckets)).to_batches()

    def send_contexts(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        for row in _one_by_one(left.to_batches()):
            own = Grouped(Places.of(row), _training(row), depth).join_contexts()
            totals, _, mine = _answers(right, 1, ("<i8", "<i8", "u1"))
            out += _parts(row["block"], own.contexts, *own.of_contexts(totals, mine), buckets)
        return _table(_SENT, out)

    def take(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        for row in _one_by_one(left.to_batches()):
            places = Places.of(row)
            own = Grouped(places, _training(row), depth).join_contexts()
            totals, _, _ = _answers(right, 1, ("<i8", "<i8", "u1"))
            count, distinct, passes = (x[own.context_of] for x in _answers(right, 2, ("<i8", "<i8", "u1")))
            given = ((totals / (count + distinct))[own.gram] + (distinct / (count + distinct))[own.gram] * places.lower) if len(places.at) else places.lower
            places = Places(places.codes, places.words, places.at, given, np.where(passes[own.gram] > 0, given, places.best))
            if last:
                done = _settled(row, places, np.zeros(len(places.at), bool))["done"]
                columns = [row["ids"], row["held"], row["n_tokens"], row["n_known"], [n] * len(done), row["base"], done]
                out += [dict(zip(arrow.names, r)) for r in zip(*columns)]
            else:
                longer = np.zeros(len(places.codes) + 1, bool)
                longer[places.at[(totals[own.gram] >= least) & (places.codes[places.at] > 0)] + 1] = True
                out.append({f.name: row[f.name] for f in arrow} | _settled(row, places, longer[places.at]))
        return pa.Table.from_pylist(out, schema=arrow)

    first = staged(state.mapInArrow(send, _SENT).groupBy("bucket").applyInArrow(lambda t: _added(t, False), _BACK))
    blocks = state.groupBy("block")
    contexts_ = blocks.cogroup(first.groupBy("block")).applyInArrow(send_contexts, _SENT)
    second = staged(contexts_.groupBy("bucket").applyInArrow(lambda t: _added(t, True), _BACK))
    out = staged(blocks.cogroup(first.unionAll(second).groupBy("block")).applyInArrow(take, last or state.schema), by=None if last else "block")
    for table in (first, second, state):
        discard(table)
    return out


def scores(docs: DataFrame, held_out: Column, doc_id: str = "doc_id", text: str = "text", block_bytes: int = BLOCK_BYTES, symbol_share: float = SYMBOL_SHARE, context_share: float = CONTEXT_SHARE, depth: int = DEPTH, least: int = LEAST, bucket: int = BUCKET) -> DataFrame:
    """Per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score; learned where not ``held_out``."""
    blocks = _blocks(docs.select(F.col(doc_id).alias("id"), held_out.alias("held"), F.col(text).alias("body")), block_bytes)
    ends = blocks.select(F.explode("held").alias("h")).where(~F.col("h")).count()
    distinct, spoken = blocks.agg(F.sum("distinct"), F.sum("spoken")).first()
    n = (spoken or 0) + ends
    totals = _word_totals(blocks, max(1, -(-(distinct or 0) // bucket)), max(1.0, symbol_share * n))
    frequent = [tuple(r[0]) for r in totals.select(F.explode("frequent")).collect()]  # at most 1 / symbol_share
    kinds = totals.select(F.explode("kinds").alias("k")).groupBy("k.shape").agg(F.sum("k.n"), F.sum("k.c"))
    shapes = [tuple(r) for r in kinds.collect()]  # at most 65,536 and 256
    v = sum(k for _, k, _ in shapes) + (ends > 0)
    symbols = choose_symbols(frequent, shapes, ends, max(1.0, symbol_share * n))
    tokens = _symbol_blocks(blocks, totals, symbols, n, v)
    for table in (blocks, totals):
        discard(table)
    tree = learn(tokens, symbols, share=context_share)
    places = tokens.select(F.explode("n_tokens").alias("n")).agg(F.sum("n")).first()[0] or 0
    state = _open(tokens, tree, symbols, least)
    schema = T.StructType(
        [T.StructField("doc_id", blocks.schema["ids"].dataType.elementType), T.StructField("held_out", T.BooleanType())]
        + [T.StructField(c, T.LongType()) for c in ("n_tokens", "n_known", "train_tokens")]
        + [T.StructField(c, T.DoubleType()) for c in ("base_score", "score")]
    )
    discard(tokens)  # all that is needed of it is in the state
    for d in range(1, depth + 1):
        state = _deeper(state, d, max(1, -(-places // bucket)), least, schema if d == depth else None, n)
    return state


def op1_suffix_tree(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    held = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 7 == 2
    return scores(docs, held)
