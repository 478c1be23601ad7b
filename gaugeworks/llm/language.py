"""Language identification by a byte convolutional network, trained in numpy.

The network reads windows of `WINDOW` bytes (A-Z lower-cased, zero-padded): an embedding of bytes, filters of several widths,
the maximum of each filter over the window after a rectifier, and a softmax over the learned languages. A text is cut into
consecutive windows, all of them; its prediction is the mean of the windows' probabilities, weighted by their bytes.

Training uses a sample: `PER_LANGUAGE` different texts with a letter of every language (all where there are fewer), those of the
smallest hashes, and at most `PER_TEXT` windows of each, which are cut in the tasks, so that the sample's size is bounded by these parameters and the number of languages. Some windows are
shortened, so that short texts are learned too. Training is deterministic for given rows.

For prediction the first layer is folded into tables by byte pairs, so that a filter of four bytes costs two look-ups.

A null text, and one without a letter, is `und` with score 0; so is every text if nothing could be learned. Empty tables give empty
results; a null language isn't learned from.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeworks.llm.columns import append_columns, as_values, slices, staged

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 16
EMBEDDING = 8
PER_LANGUAGE = 600
PER_TEXT = 4
EPOCHS = 6
UNKNOWN = "und"

_LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
_JAVA_LETTER = r"\p{L}"


def has_letter(text: bytes | None) -> bool:
    """Whether there is a character of category L; numbers such as \u00bd or \u2160 are none."""
    return bool(text) and any(map(str.isalpha, text.decode("utf-8", "replace")))


def windows_of(texts: list[bytes], window: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All windows of all texts, the text of each, and its bytes. An empty text has one empty window."""
    counts = np.array([max(1, -(-len(t) // window)) for t in texts], np.int64)
    ends = np.cumsum(counts)
    flat = np.zeros(int(counts.sum()) * window, np.uint8)
    owner = np.repeat(np.arange(len(texts)), counts)
    sizes = np.full(len(owner), window, np.int64)
    for k, t in enumerate(texts):
        at = int(ends[k] - counts[k]) * window
        flat[at : at + len(t)] = np.frombuffer(t.translate(_LOWER), np.uint8)
        sizes[ends[k] - 1] = len(t) - (counts[k] - 1) * window
    return flat.reshape(-1, window), owner, np.maximum(sizes, 1)


@dataclass
class Network:
    languages: list[str]
    embedding: np.ndarray  # (256, EMBEDDING)
    filters: list[np.ndarray]  # for each width (width, EMBEDDING, FILTERS)
    bias: np.ndarray  # (widths, FILTERS)
    out: np.ndarray  # (widths * FILTERS, languages)
    out_bias: np.ndarray

    def parameters(self) -> list[np.ndarray]:
        return [self.embedding, *self.filters, self.bias, self.out, self.out_bias]

    def tables(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """By byte pair: the first two bytes of every width; the last two of width 4. By byte: the last of width 3."""
        e = self.embedding
        two, three, four = self.filters
        first = [(e @ f[0])[:, None, :] + (e @ f[1])[None, :, :] for f in (two, three, four)]
        last = (e @ four[2])[:, None, :] + (e @ four[3])[None, :, :]
        pair = np.concatenate([x.reshape(65536, -1) for x in first], axis=1).astype(np.float32)
        return pair, last.reshape(65536, -1).astype(np.float32), (e @ three[2]).astype(np.float32)

    def probabilities(self, windows: np.ndarray, tables=None, together: int = 32) -> np.ndarray:
        pair, last, single = tables or self.tables()
        n, size = windows.shape
        pooled = np.empty((n, len(WIDTHS) * FILTERS), np.float32)
        f = FILTERS
        for at in range(0, n, together):
            w = windows[at : at + together].astype(np.int32)
            pairs = (w[:, :-1] << 8) | w[:, 1:]
            first = pair.take(pairs, axis=0)
            out = pooled[at : at + together]
            out[:, :f] = first[:, :, :f].max(axis=1)
            out[:, f : 2 * f] = (first[:, :-1, f : 2 * f] + single.take(w[:, 2:], axis=0)).max(axis=1)
            out[:, 2 * f :] = (first[:, :-2, 2 * f :] + last.take(pairs[:, 2:], axis=0)).max(axis=1)
        hidden = np.maximum(pooled + self.bias.reshape(-1).astype(np.float32), 0)
        return softmax(hidden @ self.out.astype(np.float32) + self.out_bias.astype(np.float32))


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train(windows: np.ndarray, labels: np.ndarray, languages: list[str], epochs: int = EPOCHS, seed: int = 5) -> Network:
    """Stochastic training with Adam on whole and shortened windows."""
    rng = np.random.default_rng(seed)
    c = len(languages)
    net = Network(
        languages,
        rng.normal(0, 0.5, (256, EMBEDDING)),
        [rng.normal(0, (2 / (w * EMBEDDING)) ** 0.5, (w, EMBEDDING, FILTERS)) for w in WIDTHS],
        np.zeros((len(WIDTHS), FILTERS)),
        rng.normal(0, 0.2, (len(WIDTHS) * FILTERS, c)),
        np.zeros(c),
    )
    net.embedding[0] = 0
    moment = [(np.zeros_like(p), np.zeros_like(p)) for p in net.parameters()]
    weight = len(labels) / (c * np.maximum(np.bincount(labels, minlength=c), 1))  # languages count alike
    step = 0
    for epoch in range(epochs):
        for batch in np.array_split(rng.permutation(len(labels)), max(1, len(labels) // 64)):
            x, y = windows[batch].copy(), labels[batch]
            keep = np.where(rng.random(len(x)) < 0.5, x.shape[1], np.exp(rng.uniform(np.log(6), np.log(x.shape[1]), len(x))).astype(int))
            x[np.arange(x.shape[1])[None, :] >= keep[:, None]] = 0
            grads = _gradients(net, x, y, weight[y])
            step += 1
            rate = 0.01 if epoch < epochs - 2 else 0.003
            for p, g, (m, v) in zip(net.parameters(), grads, moment):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
            net.embedding[0] = 0
    return net


def _gradients(net: Network, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> list[np.ndarray]:
    n = len(x)
    rows = np.arange(n)[:, None]
    embedded = net.embedding.astype(np.float32)[x]
    best, pooled = [], []
    for w, f, b in zip(WIDTHS, net.filters, net.bias):
        patches = np.lib.stride_tricks.sliding_window_view(embedded, w, axis=1)  # (n, places, EMBEDDING, w)
        value = patches.reshape(n, -1, EMBEDDING * w) @ f.transpose(1, 0, 2).reshape(EMBEDDING * w, FILTERS).astype(np.float32)
        at = value.argmax(axis=1)
        best.append(at)
        pooled.append(value[rows, at, np.arange(FILTERS)[None, :]] + b)
    before = np.concatenate(pooled, axis=1)
    hidden = np.maximum(before, 0)
    error = softmax(hidden @ net.out + net.out_bias)
    error[np.arange(n), y] -= 1
    error *= weight[:, None] / n
    back = (error @ net.out.T) * (before > 0)
    g_embedding = np.zeros_like(net.embedding)
    g_filters, g_bias = [], []
    for k, (w, f) in enumerate(zip(WIDTHS, net.filters)):
        part = back[:, k * FILTERS : (k + 1) * FILTERS]
        g_bias.append(part.sum(axis=0))
        g = np.zeros_like(f)
        for j in range(w):
            seen = x[rows, best[k] + j]  # the byte under place j of the filter, for every window and filter
            np.add.at(g_embedding, seen, part[:, :, None] * f[j].T[None, :, :])
            g[j] = np.einsum("nf,nfe->ef", part, net.embedding[seen])
        g_filters.append(g)
    return [g_embedding, *g_filters, np.array(g_bias), hidden.T @ error, error.sum(axis=0)]


def training_windows(docs: DataFrame, language: Column, text: Column, per_language: int = PER_LANGUAGE, per_text: int = PER_TEXT, window: int = WINDOW) -> list:
    """Rows (language, window) of a bounded sample, in a fixed order."""
    rows = docs.select(language.cast("string").alias("lang"), text.alias("body")).where("lang IS NOT NULL AND body IS NOT NULL")
    rows = rows.select("lang", "body", F.xxhash64("body").alias("key"))
    space = 1 << 30
    # Different texts, told apart by their hash: copies are reduced in the scan, and only hashes are shuffled.
    known = staged(rows.where(F.col("body").rlike(_JAVA_LETTER)).select("lang", "key").distinct())
    place = F.pmod("key", F.lit(space))
    counts = known.groupBy("lang").agg(F.ceil(F.lit(2 * per_language * space) / F.count("*")).alias("share"))  # one row a language
    near = known.join(F.broadcast(counts), "lang").where(place < F.col("share")).select("lang", place.alias("place"), "key").collect()
    taken: dict[str, list] = {}
    for r in sorted(near):
        taken.setdefault(r.lang, []).append(r.key)
    keys = [(lang, key) for lang, own in taken.items() for key in own[:per_language]]
    drawn = rows.join(F.broadcast(rows.sparkSession.createDataFrame(keys, "lang string, key long")), ["lang", "key"])
    different = drawn.select("lang", "body").dropDuplicates()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, [1]):
                out = []
                for lang, body in zip(batch.column(0).to_pylist(), as_values(batch.column(1))):
                    if has_letter(body):
                        last = max(0, len(body) - window)
                        out += [(lang, body[at : at + window]) for at in sorted({int(p) for p in np.linspace(0, last, per_text)})]
                yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in out], pa.string()), pa.array([b for _, b in out], pa.binary())], names=["lang", "piece"])

    return sorted((r.lang, bytes(r.piece)) for r in different.mapInArrow(cut, "lang string, piece binary").collect())


def learn(docs: DataFrame, language: Column, text: Column, **sizes) -> Network | None:
    rows = training_windows(docs, language, text, **sizes)
    if not rows:
        return None
    languages = sorted({lang for lang, _ in rows})
    windows, _, _ = windows_of([b for _, b in rows])
    return train(windows, np.array([languages.index(lang) for lang, _ in rows]), languages)


def predict(docs: DataFrame, net: Network | None, text: str = "text", out: str = "language") -> DataFrame:
    """``docs`` with a struct ``out`` (lang, score); one narrow pass. The network goes with the plan: a few kilobytes."""
    kind = T.StructType([T.StructField("lang", T.StringType()), T.StructField("score", T.DoubleType())])

    def work(texts: list) -> list:
        found = [{"lang": UNKNOWN, "score": 0.0} for _ in texts]
        known = [k for k, t in enumerate(texts) if has_letter(t)] if net else []
        if known:
            windows, owner, sizes = windows_of([texts[k] for k in known])
            sums = np.zeros((len(known), len(net.languages)))
            np.add.at(sums, owner, net.probabilities(windows, _tables(net)) * sizes[:, None])
            shares = sums / sums.sum(axis=1, keepdims=True)
            for k, best, score in zip(known, shares.argmax(axis=1), shares.max(axis=1)):
                found[k] = {"lang": net.languages[best], "score": min(float(score), 1.0)}
        return [found]

    return append_columns(docs, [text], T.StructType([T.StructField(out, kind)]), work)


_folded: dict[int, tuple] = {}


def _tables(net: Network) -> tuple:
    key = hash(b"".join(p.tobytes() for p in net.parameters()))
    if key not in _folded:
        _folded.clear()
        _folded[key] = net.tables()
    return _folded[key]


def op5_language(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    held = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 4 == 2
    net = learn(docs.where(~held), F.col("lang"), F.col("text"))
    return predict(docs.select("doc_id", "text"), net).select(
        "doc_id", held.alias("held_out"), F.col("language.lang").alias("lang_pred"), F.col("language.score").alias("score")
    )
