"""Benchmark decontamination: one Aho-Corasick automaton over the words of test items.

Texts and items are lower-cased (A-Z) and cut into words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``. Every run of ten
words of an item is a pattern; an item of fewer words, but not none, is one pattern. The automaton's alphabet are the
words of the items, numbered; all other words are one number that no pattern has. A text is scanned once, and a match
ends at a word, so that hit words map to offsets in the original text.

The automaton is built in the tasks from the items, which are sent with the plan. Their size is bounded: beyond
`SHARD_BYTES` of item text, items are dealt into shards by a hash, each with an automaton of its own, the documents are
scanned once per shard, and the hits are merged per document. The result doesn't depend on the number of shards.

Null or wordless texts have no hits; null or wordless items match nothing. Items with equal text each count. An item
without an id marks words, but isn't listed.
"""

from __future__ import annotations

from collections.abc import Iterable
from itertools import repeat

import ahocorasick
import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeworks.llm.columns import alnum_words, append_columns, free_name, spaced

WINDOW = 10
#: Item text in one automaton. A word of an item becomes at most WINDOW nodes, so this bounds its memory.
SHARD_BYTES = 2 << 20

FOUND = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("hit_runs", T.ArrayType(T.StructType([T.StructField("first", T.LongType()), T.StructField("last", T.LongType())]))),
        T.StructField("spans", T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))),
        T.StructField("items", T.ArrayType(T.StringType())),
    ]
)


class Scanner:
    """Finds the windows of items in texts. ``items``: (id as text or None, UTF-8 text)."""

    def __init__(self, items: Iterable[tuple[str | None, bytes | None]], window: int = WINDOW):
        self.numbers: dict[bytes, int] = {}
        owners: dict[tuple[int, ...], set[str]] = {}
        for name, text in items:
            ids = tuple(self.numbers.setdefault(w, len(self.numbers) + 1) for w in alnum_words(text or b""))
            for at in range(max(1, len(ids) - window + 1) if ids else 0):
                owners.setdefault(ids[at : at + window], set()).update([name] if name is not None else [])
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        for ids, names in owners.items():
            self.automaton.add_word(ids, (len(ids), frozenset(names)))
        self.shortest = min(map(len, owners), default=0)
        if owners:
            self.automaton.make_automaton()

    def scan(self, text: bytes | None) -> tuple[int, list[tuple[int, int]], set[str]]:
        """Number of words; runs of hit words (first, last); ids of the items found."""
        words = alnum_words(text or b"")
        if not self.shortest or len(words) < self.shortest:
            return len(words), [], set()
        runs: list[tuple[int, int]] = []
        names: set[str] = set()
        for end, (length, owners) in self.automaton.iter(tuple(map(self.numbers.get, words, repeat(0)))):
            runs.append((end - length + 1, end))
            names |= owners
        return len(words), merged(runs), names


def merged(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping or adjoining runs joined, in order."""
    out: list[tuple[int, int]] = []
    for first, last in sorted(runs):
        if out and first <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(last, out[-1][1]))
        else:
            out.append((first, last))
    return out


def char_spans(text: bytes, runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Runs of words as offsets of the original text, in code points, end exclusive."""
    if not runs:
        return []
    solid = np.frombuffer(spaced(text), np.uint8) != 0x20
    edges = np.flatnonzero(np.diff(np.concatenate(([False], solid, [False])).astype(np.int8)))
    starts, ends = edges[::2], edges[1::2]
    before = np.concatenate(([0], np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)))
    return [(int(before[starts[a]]), int(before[ends[b]])) for a, b in runs]


_scanners: dict[int, Scanner] = {}


def find_items(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text", window: int = WINDOW, shard_bytes: int = SHARD_BYTES, out: str = "found") -> DataFrame:
    """``docs`` with a struct ``out``: number of words, runs of hit words, their spans, ids of items (sorted as text).

    One narrow pass over the documents while the items fit one automaton.
    """
    items = benchmark.select(F.col(item).cast("string").alias("name"), F.col(item_text).alias("body"))
    size = items.agg(F.sum(F.octet_length("body"))).first()[0] or 0
    shards = max(1, -(-size // shard_bytes))
    if shards == 1:
        return _scan(docs, text, items, window, out)
    key = free_name(docs, "row_key")
    docs = docs.withColumn(key, F.xxhash64(F.col(text)))  # equal texts have equal hits, so repeated rows may meet
    one = docs.groupBy(key).agg(F.max(text).alias(text))
    parts = None
    for shard in range(shards):
        found = _scan(one, text, items.where(F.pmod(F.xxhash64("body"), F.lit(shards)) == shard), window, out).select(key, out)
        parts = found if parts is None else parts.unionByName(found)
    joined = parts.groupBy(key).agg(
        F.max(f"{out}.n_words").alias("n"),
        F.flatten(F.collect_list(f"{out}.hit_runs")).alias("runs"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list(f"{out}.items")))).alias("items"),
    )
    whole = docs.join(joined.select(key, F.struct("n", "runs", "items").alias(out)), key)
    name = free_name(whole, "merged_found")
    again = append_columns(
        whole.withColumn(name, F.col(f"{out}.runs")),
        [text, name],
        T.StructType([T.StructField(f"{name}_2", T.StructType(FOUND.fields[1:3]))]),
        lambda bodies, runs: [[_merge_again(t or b"", r) for t, r in zip(bodies, runs)]],
    )
    cols = [c for c in docs.columns if c != key]
    return again.select(
        *cols, F.struct(F.col(f"{out}.n").alias("n_words"), F.col(f"{name}_2.hit_runs"), F.col(f"{name}_2.spans"), F.col(f"{out}.items")).alias(out)
    )


def _merge_again(text: bytes, runs: list[dict]) -> dict:
    joined = merged([(r["first"], r["last"]) for r in runs])
    return {"hit_runs": _pairs(joined, "first", "last"), "spans": _pairs(char_spans(text, joined), "start", "end")}


def _pairs(pairs: list[tuple[int, int]], a: str, b: str) -> list[dict]:
    return [{a: x, b: y} for x, y in pairs]


def _scan(docs: DataFrame, text: str, items: DataFrame, window: int, out: str) -> DataFrame:
    rows = [(r.name, (r.body or "").encode()) for r in items.collect()]  # bounded by shard_bytes
    key = hash((tuple(rows), window))

    def work(texts: list) -> list:
        if key not in _scanners:
            _scanners.clear()
            _scanners[key] = Scanner(rows, window)
        found = []
        for t in texts:
            n, runs, names = _scanners[key].scan(t)
            found.append({"n_words": n, "hit_runs": _pairs(runs, "first", "last"), "spans": _pairs(char_spans(t or b"", runs), "start", "end"), "items": sorted(names)})
        return [found]

    return append_columns(docs, [text], T.StructType([T.StructField(out, FOUND)]), work)


def without_leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """Documents none of whose words lies in a window of an item."""
    name = free_name(docs, "found")
    return find_items(docs, benchmark, text, out=name).where(F.size(f"{name}.hit_runs") == 0).select(*docs.columns)


def op8_decontaminate(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = find_items(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    n_hit = F.aggregate("found.hit_runs", F.lit(0).cast("long"), lambda n, r: n + r["last"] - r["first"] + 1)
    return found.select(
        "doc_id",
        F.col("found.n_words").alias("n_words"),
        n_hit.alias("n_hit"),
        F.size("found.items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "found.items"), 256).alias("items_sha256"),
        (F.size("found.hit_runs") > 0).alias("contaminated"),
    )


_WORDS_SQL = r"regexp_extract_all(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP8_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS_SQL.format("coalesce(text, '')")} AS w FROM documents),
i AS (SELECT row_number() OVER () AS k, item_id, {_WORDS_SQL.format("coalesce(text, '')")} AS w FROM benchmark),
iw AS (
  SELECT DISTINCT item_id, k, array_to_string(w[p + 1 : p + {WINDOW}], ' ') AS pattern, least(len(w), {WINDOW}) AS n
  FROM i, unnest(range(0, greatest(1, len(w) - {WINDOW - 1}))) AS t(p) WHERE len(w) > 0
),
lengths AS (SELECT DISTINCT n FROM iw),
dw AS (
  SELECT r, p, n, array_to_string(w[p + 1 : p + n], ' ') AS pattern
  FROM (SELECT r, w, n, unnest(range(0, greatest(0, len(w) - n + 1))) AS p FROM d, lengths WHERE len(w) >= n)
),
hits AS (SELECT dw.r, dw.p, dw.n, iw.item_id FROM dw JOIN iw ON dw.pattern = iw.pattern AND dw.n = iw.n),
words AS (SELECT r, count(DISTINCT q) AS n_hit FROM (SELECT r, unnest(range(p, p + n)) AS q FROM hits) GROUP BY r),
items AS (
  SELECT r, count(*) AS n_items, sha256(string_agg(x, ',' ORDER BY x)) AS h
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS x FROM hits WHERE item_id IS NOT NULL) GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, coalesce(h, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (r) LEFT JOIN items USING (r)
"""
