"""Phrase collocations: candidates from mergeable Misra-Gries summaries, then exact counts.

Texts (A-Z lower-cased) fall into pieces at ``[.,;:!?\\x0A-\\x0D]`` and pieces into words ``[^\\x20\\x09]+``. A gram is one to
`LONGEST` consecutive words of a piece, in one language. Grams are hashed to 64 bits, and the hashes' space is cut into equal
ranges, the hash partitions. The work takes two passes over the texts:

1. Tasks summarise their grams, one summary for each hash partition: distinct hashes (their first `KEY_BITS` bits) with counts.
   A partition merges what it gets into one Misra-Gries summary: counts of equal keys are added, and where more than the capacity
   remain, the count of the first one beyond it is subtracted from all. As the capacity exceeds mass / least, all that is ever
   subtracted, the error, is below ``least``; so every gram that occurs ``least`` times survives with count + error >= ``least``.
   (Keys that collide only make counts greater.) The survivors mark bits of a bitmap, which is at most `MOST_BITS` bits large
   and goes to all tasks.
2. Grams whose bit is set are counted as text, exactly; only those with ``least`` occurrences stay. A gram that survived in vain, or
   shares its bit, costs a row here and nothing else. Grams of equal hash are compared word by word before they count as equal.

Nothing grows in one place: a task holds `BUFFER` hashes and then sends them, a partition is `PARTITION_BYTES` of text, its summary
a share of that, and frequent grams are a table. A gram that is a third of all is one entry in each task's summary.

A null text is empty; a null language is ``und``. Repeated rows each count. Other columns are not read. An empty table, or one
without frequent phrases, gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gaugeworks.llm.columns import as_values, hashed, mixed, release, slices, staged

LONGEST = 5
LEAST = 100
PER_LANG = 2000
KEY_BITS = 48
#: The capacity of a summary is so many times mass / least; then the error is at most ``least`` / SLACK.
SLACK = 4
#: Hashes that a task gathers before it sends their counts.
BUFFER = 6 << 20
#: Text for each hash partition, and the fewest partitions.
PARTITION_BYTES = 32 << 20
PARTITIONS = 64
#: The bitmap has 16 bits for each survivor, but at most so many (128 MB).
MOST_BITS = 30

_SPACE, _BREAK = 0x20, 0x0A
#: A-Z lower-cased, characters between words as spaces, those between pieces as line feeds.
_TABLE = bytes(
    b + 32 if 0x41 <= b <= 0x5A else _BREAK if b in b".,;:!?" or 0x0A <= b <= 0x0D else _SPACE if b == 0x09 else b for b in range(256)
)


class Grams:
    """The grams of some texts: words as codes, one after the other, and the hashes of the grams that begin at each."""

    def __init__(self, texts: list[bytes | None], langs: list[bytes]):
        sizes = np.array([len(t) if t else 0 for t in texts], np.int64) + 1
        data = np.frombuffer(b"".join([(t or b"") + b"\n" for t in texts]).translate(_TABLE), np.uint8)
        breaks = data == _BREAK
        solid = ~breaks & (data != _SPACE)
        edges = np.flatnonzero(np.diff(solid.view(np.int8), prepend=0, append=0))
        starts, ends = edges[::2], edges[1::2]
        at = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int32)
        words = pa.BinaryArray.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(at), pa.py_buffer(data[solid])])
        coded = words.dictionary_encode()
        self.codes = coded.indices.to_numpy(zero_copy_only=False) if len(starts) else np.zeros(0, np.int32)
        self.words: list[bytes] = coded.dictionary.to_pylist()
        self.piece = np.cumsum(breaks, dtype=np.int32)[starts]
        self.langs = sorted(set(langs))
        known = {lang: k for k, lang in enumerate(self.langs)}
        by_text = np.array([known[lang] for lang in langs], np.int32)
        self.lang = by_text[np.searchsorted(np.cumsum(sizes), starts, side="right")]

    def levels(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(length, places where grams of this length begin, their hashes)."""
        stream = hashed(self.words)[self.codes] if len(self.codes) else np.zeros(0, np.uint64)
        h = mixed(stream + hashed(self.langs)[self.lang]) if len(self.codes) else stream
        places = np.arange(len(h))
        for n in range(1, LONGEST + 1):
            if n > 1:
                left = places + n - 1 < len(self.codes)
                places, h = places[left], h[left]
                left = self.piece[places] == self.piece[places + n - 1]
                places, h = places[left], h[left]
                h = mixed(h * np.uint64(0x9E3779B97F4A7C15) + stream[places + n - 1])
            yield n, places, h

    def text(self, place: int, n: int) -> str:
        return b" ".join([self.words[c] for c in self.codes[place : place + n]]).decode()


# ---- first pass: summaries ------------------------------------------------------------------------------------------


def packed(values: np.ndarray, width: int) -> bytes:
    """The first ``width`` bytes of whole numbers, plane by plane: most are small."""
    planes = np.ascontiguousarray(values.astype("<u8")).view(np.uint8).reshape(len(values), 8)[:, :width].T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def unpacked(data: bytes, width: int) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(width, -1)
    wide = np.zeros((planes.shape[1], 8), np.uint8)
    wide[:, :width] = planes.T
    return wide.view("<u8").reshape(-1)


def summaries(hashes: np.ndarray, partitions: int) -> Iterator[tuple[int, int, bytes, bytes]]:
    """(partition, mass, keys, counts) for each hash partition that has any of ``hashes``. Keys are ordered and sent as differences."""
    keys, counts = np.unique(hashes >> np.uint64(64 - KEY_BITS), return_counts=True)
    of = ((keys >> np.uint64(KEY_BITS - 32)) * np.uint64(partitions)) >> np.uint64(32)
    present, first = np.unique(of, return_index=True)
    for k, a, b in zip(present.tolist(), first.tolist(), [*first[1:].tolist(), len(keys)]):
        yield k, int(counts[a:b].sum()), packed(np.diff(keys[a:b], prepend=np.uint64(0)), KEY_BITS // 8), packed(counts[a:b], 4)


class Summary:
    """A Misra-Gries summary: keys, counts that are too low by ``error`` at most, and the same for keys that are not there."""

    def __init__(self, capacity: int):
        self.capacity, self.error = capacity, 0
        self.keys, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def merge(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.keys, place = np.unique(np.concatenate([self.keys, keys]), return_inverse=True)
        self.counts = np.bincount(place, np.concatenate([self.counts, counts]), len(self.keys)).astype(np.int64)
        if len(self.keys) > self.capacity:
            beyond = len(self.keys) - self.capacity - 1
            cut = int(np.partition(self.counts, beyond)[beyond])
            stay = self.counts > cut
            self.keys, self.counts, self.error = self.keys[stay], self.counts[stay] - cut, self.error + cut


def survivors(parts: list[tuple[int, bytes, bytes]], least: int, batch: int = 1 << 20) -> np.ndarray:
    """Keys that may occur ``least`` times, from (mass, keys, counts) of one hash partition."""
    mass = sum(m for m, _, _ in parts)
    summary = Summary(SLACK * mass // least + 1)
    waiting: list[tuple[np.ndarray, np.ndarray]] = []
    size = 0
    for k, (_, keys, counts) in enumerate(parts):
        waiting.append((np.cumsum(unpacked(keys, KEY_BITS // 8), dtype=np.uint64), unpacked(counts, 4).astype(np.int64)))
        size += len(waiting[-1][0])
        if size >= batch or k == len(parts) - 1:
            summary.merge(*map(np.concatenate, zip(*waiting)))
            waiting, size = [], 0
    assert summary.error < least
    return summary.keys[summary.counts + summary.error >= least]


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[Grams]:
    for whole in batches:
        for batch in slices(whole, [1]):
            yield Grams(as_values(batch.column(1)), as_values(batch.column(0)))


def _candidates(docs: DataFrame, least: int, partitions: int) -> DataFrame:
    """(partition, n, keys): survivors of each hash partition. Staged."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[np.ndarray] = []

        def flush() -> Iterator[pa.RecordBatch]:
            rows = summaries(np.concatenate(waiting), partitions) if waiting else ()
            waiting.clear()
            for k, mass, keys, counts in rows:
                yield pa.RecordBatch.from_pydict({"part": pa.array([k], pa.int32()), "mass": [mass], "keys": [keys], "counts": [counts]})
            release()

        for grams in _slices(batches):
            waiting += [h for _, _, h in grams.levels()]
            if sum(map(len, waiting)) >= BUFFER:
                yield from flush()
        yield from flush()

    def merge(table: pa.Table) -> pa.Table:
        keys = survivors(list(zip(*(table.column(c).to_pylist() for c in ("mass", "keys", "counts")))), least)
        release()
        return pa.table({"n": pa.array([len(keys)], pa.int64()), "keys": [packed(np.diff(keys, prepend=np.uint64(0)), KEY_BITS // 8)]})

    sent = docs.mapInArrow(send, "part int, mass long, keys binary, counts binary")
    return staged(sent.groupBy("part").applyInArrow(merge, "n long, keys binary"))


# ---- second pass: exact counts --------------------------------------------------------------------------------------


def _bitmap(candidates: DataFrame) -> bytes:
    """Bits of the survivors by the first bits of their hashes; its size is bounded by `MOST_BITS` whatever the corpus."""
    n = candidates.agg(F.sum("n")).first()[0] or 0
    bits = min(MOST_BITS, max(16, (16 * n).bit_length()))

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for keys in batch.column(0):
                places = unpacked(keys.as_py(), KEY_BITS // 8)
                places = np.cumsum(places, dtype=np.uint64) >> np.uint64(KEY_BITS - bits)
                if len(places):
                    first = int(places[0]) >> 3
                    own = np.zeros((int(places[-1]) >> 3) - first + 1, np.uint8)
                    np.bitwise_or.at(own, (places >> np.uint64(3)).astype(np.int64) - first, np.uint8(1) << (places & np.uint64(7)).astype(np.uint8))
                    yield pa.RecordBatch.from_pydict({"first": [first], "own": [zstandard.compress(own.tobytes(), 1)]})

    marks = np.zeros(1 << bits - 3, np.uint8)
    for row in candidates.select("keys").mapInArrow(mark, "first long, own binary").collect():  # all in all one bitmap, squeezed
        own = np.frombuffer(zstandard.decompress(row.own), np.uint8)
        marks[row.first : row.first + len(own)] |= own
    return marks.tobytes()


def counted(grams: Grams, bitmap: np.ndarray) -> list[tuple[bytes, int, str | None, int]]:
    """(language, length, gram, occurrences here) of grams whose bit is set; and the number of words of each language, as gram null."""
    shift = np.uint64(64 - len(bitmap).bit_length() - 2)
    words = np.bincount(grams.lang, minlength=len(grams.langs))
    rows = [(lang, 0, None, int(c)) for lang, c in zip(grams.langs, words) if c]
    for n, places, h in grams.levels():
        bit = h >> shift
        there = (bitmap[(bit >> np.uint64(3)).astype(np.int64)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1 == 1
        places, h = places[there], h[there]
        _, first, of, count = np.unique(h, return_index=True, return_inverse=True, return_counts=True)
        like = places[first]
        same = grams.lang[places] == grams.lang[like][of]
        for j in range(n):
            same &= grams.codes[places + j] == grams.codes[like + j][of]
        if not same.all():  # grams of equal hash that differ: each for itself
            count = np.bincount(of, same, len(first)).astype(np.int64)
            like, count = np.concatenate([like, places[~same]]), np.concatenate([count, np.ones((~same).sum(), np.int64)])
        rows += [(grams.langs[grams.lang[p]], n, grams.text(p, n), c) for p, c in zip(like.tolist(), count.tolist())]
    return rows


def frequent_grams(docs: DataFrame, lang: str = "lang", text: str = "text", least: int = LEAST, partition_bytes: int = PARTITION_BYTES) -> DataFrame:
    """(lang, n, gram, f) of all grams of up to `LONGEST` words with ``least`` occurrences, and one row (lang, 0, null, words) for each
    language. Staged."""
    named = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.col(text).alias("body"))
    size = docs.agg(F.sum(F.octet_length(F.col(text)))).first()[0] or 0
    marks = docs.sparkSession.sparkContext.broadcast(_bitmap(_candidates(named, least, max(PARTITIONS, -(-size // partition_bytes)))))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = np.frombuffer(marks.value, np.uint8)
        for grams in _slices(batches):
            langs, n, gram, f = zip(*counted(grams, bitmap)) if len(grams.codes) else ((), (), (), ())
            columns = {"lang": pa.array([x.decode() for x in langs], pa.string()), "n": pa.array(n, pa.int32()), "gram": pa.array(gram, pa.string()), "f": pa.array(f, pa.int64())}
            yield pa.RecordBatch.from_pydict(columns)

    counts = named.mapInArrow(count, "lang string, n int, gram string, f long").groupBy("lang", "n", "gram").agg(F.sum("f").alias("f"))
    return staged(counts.where((F.col("n") == 0) | (F.col("f") >= least)))


# ---- scores ---------------------------------------------------------------------------------------------------------


def collocations(grams: DataFrame) -> DataFrame:
    """lang, phrase, a, l, r, n, score of the phrases among ``grams`` that no longer phrase explains.

    A cut's parts occur at least as often as the phrase, so they are among ``grams``. A phrase inside a longer one with as many
    occurrences is, at every length between, inside one with as many; so the phrases one word longer tell.
    """
    phrases = grams.where("n >= 2").select("lang", "n", F.col("gram").alias("phrase"), F.col("f").alias("a"), F.split("gram", " ").alias("w"))
    inner = F.array(F.expr("slice(w, 1, n - 1)"), F.expr("slice(w, 2, n - 1)"))
    covered = phrases.where("n >= 3").select("lang", F.explode(F.transform(inner, lambda w: F.array_join(w, " "))).alias("phrase"), "a")
    covered = covered.groupBy("lang", "phrase").agg(F.max("a").alias("cover"))
    kept = phrases.join(covered, ["lang", "phrase"], "left").where("coalesce(cover, 0) < a")
    cuts = kept.select("lang", "phrase", "a", "n", "w", F.explode(F.expr("sequence(1, n - 1)")).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", F.expr("array_join(slice(w, 1, k), ' ')").alias("left"), F.expr("array_join(slice(w, k + 1, n - k), ' ')").alias("right"))
    parts = grams.where("n >= 1")
    with_left = cuts.join(parts.select("lang", F.col("gram").alias("left"), F.col("f").alias("l")), ["lang", "left"])
    both = with_left.join(parts.select("lang", F.col("gram").alias("right"), F.col("f").alias("r")), ["lang", "right"])
    words = grams.where("n = 0").select("lang", F.col("f").alias("words"))
    wide = {c: F.col(c).cast("decimal(19,0)") for c in ("a", "l", "r", "words")}
    exact = both.join(words, "lang").withColumns({f"{c}_": x for c, x in wide.items()})
    scored = exact.withColumn("score", F.expr("cast((cast(1000 as decimal(4,0)) * a_ * words_) div (l_ * r_) as long)"))
    lowest = F.min(F.struct("score", "k", "l", "r", F.col("words").alias("n"))).alias("cut")
    return scored.groupBy("lang", "phrase", "a").agg(lowest).select("lang", "phrase", "a", "cut.l", "cut.r", "cut.n", "cut.score")


def ranked(found: DataFrame, per_lang: int = PER_LANG) -> DataFrame:
    """The first ``per_lang`` of each language, by score, occurrences and phrase, with their rank."""
    order = W.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= per_lang)


def op13_collocations(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = ranked(collocations(frequent_grams(docs)))
    return rows.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


OP13_SQL = rf"""
WITH d AS (
  SELECT coalesce(lang, 'und') AS lang,
    unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\n\x0B\f\r]')) AS piece
  FROM documents
),
p AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[ \t]+'), lambda x: x <> '') AS w FROM d),
totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM p GROUP BY lang),
grams AS (
  SELECT lang, m, array_to_string(w[i + 1 : i + m], ' ') AS gram
  FROM (SELECT lang, w, m, unnest(range(0, len(w) - m + 1)) AS i FROM p, range(1, {LONGEST + 1}) AS t(m) WHERE len(w) >= m)
),
f AS (SELECT lang, m, gram, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= {LEAST}),
c AS (SELECT lang, m, gram, f, string_split(gram, ' ') AS w FROM f WHERE m >= 2),
inside AS (
  SELECT lang, array_to_string(w[i + 1 : i + j], ' ') AS gram, max(f) AS cover
  FROM (SELECT lang, w, f, j, unnest(range(0, m - j + 1)) AS i FROM c, range(2, {LONGEST}) AS t(j) WHERE j < m)
  GROUP BY ALL
),
kept AS (SELECT c.* FROM c LEFT JOIN inside USING (lang, gram) WHERE coalesce(100 * cover, 0) < 100 * c.f),
cuts AS (
  SELECT lang, gram, f AS a, k, array_to_string(w[1 : k], ' ') AS x, array_to_string(w[k + 1 : m], ' ') AS y
  FROM (SELECT *, unnest(range(1, m)) AS k FROM kept)
),
scored AS (
  SELECT cuts.lang, cuts.gram AS phrase, a, x.f AS l, y.f AS r, n, k,
    CAST((1000::HUGEINT * a * n) // (x.f::HUGEINT * y.f) AS BIGINT) AS score
  FROM cuts JOIN f AS x ON x.lang = cuts.lang AND x.gram = cuts.x JOIN f AS y ON y.lang = cuts.lang AND y.gram = cuts.y
    JOIN totals ON totals.lang = cuts.lang
),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank, phrase, a, l, r, n, score
FROM lowest QUALIFY rank <= {PER_LANG}
"""
