"""Shards: every row once, gapless slots, near equal bytes, groups together."""

import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from gaugeworks.llm import sharding
from gaugeworks.llm.columns import share_code
from gaugeworks.llm.queries import llm_queries

SCHEMA = "doc_id long, text string, size string, shard string, slot string, shard_key string"


def rows_of(text):
    return len((text or "").encode()) + 1


def check(rows, texts, shards=16, tolerance=sharding.TOLERANCE):
    """Rows (doc_id, text, size, shard, slot) of documents ``texts`` (doc_id, text)."""
    assert Counter((d, t) for d, t, *_ in rows) == Counter(texts)
    slots, sizes, most = defaultdict(list), Counter(), Counter()
    for _, text, size, shard, slot in rows:
        assert size == rows_of(text) and 0 <= shard < shards
        slots[shard].append(slot)
        sizes[shard] += size
    for s in slots.values():
        assert sorted(s) == list(range(len(s)))
    total = sum(sizes.values())
    largest = max((rows_of(t) for _, t in texts), default=0)
    for shard in range(shards):  # each of its two boundaries is off by half a row, or within the tolerance
        assert abs(sizes[shard] - total / shards) <= 2 * tolerance * total / shards + largest + 1
    return most


def result(spark, texts, **more):
    share_code(spark)
    df = spark.createDataFrame([(d, t, "own", "own", "own", "own") for d, t in texts], SCHEMA).repartition(4)
    out = sharding.sharded(df, **more)
    assert out.columns == [*df.columns, "size_", "shard_", "slot_"]
    rows = out.collect()
    assert all(r.size == r.shard == r.slot == r.shard_key == "own" for r in rows)
    return [(r.doc_id, r.text, r.size_, r.shard_, r.slot_) for r in rows]


def test_awkward_rows(spark):
    texts = [(k % 90, "é" * (k % 70)) for k in range(300)] + [(None, None)] * 20 + [(1, "")] * 20 + [(5, "x" * 30_000), (6, "y" * 30_000)]
    check(result(spark, texts), texts)


@pytest.mark.parametrize("texts", [[], [(1, "one")], [(None, None)], [(1, "same")] * 3])
def test_few_rows(spark, texts):
    check(result(spark, texts), texts)


def test_a_group_of_a_third_is_cut_and_others_stay_whole(spark):
    hot = [(k, "hot " * 25) for k in range(2000)]
    small = [(10_000 + k, f"group {k // 4} " * 20) for k in range(1600)]
    rows = result(spark, hot + small, tolerance=0.02)
    check(rows, hot + small, tolerance=0.02)
    of = defaultdict(set)
    for _, text, _, shard, _ in rows:
        of[text].add(shard)
    assert len(of["hot " * 25]) >= 5
    assert sum(len(s) > 1 for t, s in of.items() if t != "hot " * 25) == 0


def test_equal_rows_can_be_cut_too(spark):
    texts = [(1, "all the same")] * 1600
    rows = result(spark, texts)
    check(rows, texts)
    assert set(Counter(r[3] for r in rows).values()) == {100}


def test_many_ranges(spark):
    texts = [(k, f"{k} " * 30) for k in range(2000)]
    rows = result(spark, texts, range_bytes=1000, shards=3)
    check(rows, texts, shards=3)


def test_cells_count_exactly(spark):
    share_code(spark)
    df = spark.range(5000).select((F.xxhash64("id")).alias("k"), (F.col("id") % 7 + 1).alias("s"))
    cells = sharding.counted(df.repartition(6), "k", "s", sharding.probes(0, sharding.SPACE))
    keys = [(r.k % sharding.SPACE, r.s) for r in df.collect()]
    for start, end, size, n in zip(cells.starts, cells.ends(), cells.size, cells.rows):
        inside = [s for k, s in keys if start <= k < end]
        assert (size, n) == (sum(inside), len(inside))


def test_probes_cut_cells_evenly_down_to_single_keys():
    assert sharding.probes(10, 13) == [10, 11, 12]
    ends = [*sharding.probes(0, sharding.SPACE), sharding.SPACE]
    assert {b - a for a, b in zip(ends, ends[1:])} == {sharding.SPACE // sharding.PROBES}


def test_query(spark):
    sf_dir = "/root/testdata/sf0.01"
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    out = llm_queries()["op12_sharding"](spark, sf_dir)
    rows = out.collect()
    crc = Counter((d, rows_of(t), zlib.crc32((t or "").encode())) for d, t in texts)
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in rows) == crc
    assert {(r.law, r.grown_shard) for r in rows} == {("bytes", None)}
    text = dict(texts)
    check([(r.doc_id, text[r.doc_id], r["size"], r.shard, r.slot) for r in rows], texts)
