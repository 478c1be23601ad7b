"""Phrase collocations against a plain version, and the guarantee of their summaries."""

import re
from collections import Counter

import numpy as np
import pytest
from compare import connect, duck_result, spark_result

from gaugeworks.llm import collocations
from gaugeworks.llm.columns import share_code
from gaugeworks.llm.queries import llm_queries

SCHEMA = "doc_id long, text string, lang string, gram string, n long, f long"


def plain_collocations(docs, least, longest=5):
    """{(lang, phrase): (a, l, r, n, score)} of (text, lang)."""
    f, n = Counter(), Counter()
    for text, lang in docs:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            words = [w for w in re.split("[\x20\x09]+", piece) if w]
            n[lang] += len(words)
            f.update((lang, *words[i : i + m]) for m in range(1, longest + 1) for i in range(len(words) - m + 1))
    frequent = {g: c for g, c in f.items() if c >= least and len(g) > 2}
    out = {}
    for (lang, *w), a in frequent.items():
        inside = (
            c
            for (other, *x), c in frequent.items()
            if other == lang and len(x) > len(w) and any(x[i : i + len(w)] == w for i in range(len(x) - len(w) + 1))
        )
        if all(100 * c < 100 * a for c in inside):
            cuts = ((f[lang, *w[:k]], f[lang, *w[k:]], k) for k in range(1, len(w)))
            score, _, left, right = min((1000 * a * n[lang] // (x * y), k, x, y) for x, y, k in cuts)
            out[lang, " ".join(w)] = (a, left, right, n[lang], score)
    return out


def found(spark, docs, least):
    share_code(spark)
    df = spark.createDataFrame([(k, t, g, "own", None, -1) for k, (t, g) in enumerate(docs)], SCHEMA).repartition(5)
    rows = collocations.collocations(collocations.frequent_grams(df, least=least)).collect()
    got = {(r.lang, r.phrase): (r.a, r.l, r.r, r.n, r.score) for r in rows}
    assert len(got) == len(rows)
    return got


CASES = [
    ("a b c d e f g", "en"),
    ("A B\tc  d. a b; a b\x0bb a a a a", "en"),
    ("a b c d e f g", "en"),
    ("a b c d e f g", None),
    ("a b c d e f g", "und"),
    (None, "en"),
    (None, None),
    ("", "fr"),
    (" \t .,;:!?\n", "fr"),
    ("É é \x00 \x1c 日本語 É é \x00 \x1c 日本語\xa0É é", "日"),
    ("x y " * 3000, "en"),
    ("w" * 50_000 + " z", "en"),
]


def test_like_a_plain_version(spark):
    for least in (2, 3, 6):
        assert found(spark, CASES, least) == plain_collocations(CASES, least)


def test_random_texts(spark):
    rng = np.random.default_rng(5)
    words = np.array(["la", "de", "river", "stone,", "green", "Lamp.", "q"])
    docs = [(" ".join(words[rng.integers(0, len(words), rng.integers(1, 60))]), ["en", "fr", None][k % 3]) for k in range(200)]
    docs += docs[:40]
    assert found(spark, docs, 9) == plain_collocations(docs, 9)


def test_no_rows_and_nothing_frequent(spark):
    assert found(spark, [], 2) == {}
    assert found(spark, [("a b", "en"), (None, None)], 100) == {}


def test_partitions_and_many_sends(spark, monkeypatch):
    monkeypatch.setattr(collocations, "BUFFER", 500)
    share_code(spark)
    docs = [("one two three " * 40, "en")] * 30 + [(f"one two t{k}", "en") for k in range(60)]
    df = spark.createDataFrame([(k, t, g, "own", None, -1) for k, (t, g) in enumerate(docs)], SCHEMA).repartition(7)
    rows = collocations.collocations(collocations.frequent_grams(df, least=20, partition_bytes=64)).collect()
    assert {(r.lang, r.phrase): (r.a, r.l, r.r, r.n, r.score) for r in rows} == plain_collocations(docs, 20)


def test_query_like_sql(spark):
    sf_dir = "/root/testdata/sf0.01"
    result = spark_result(llm_queries()["op13_collocations"](spark, sf_dir))
    assert result == duck_result(connect(sf_dir), collocations.OP13_SQL) and result[1]


@pytest.mark.parametrize("seed", range(5))
def test_summaries_keep_every_frequent_key(seed):
    rng = np.random.default_rng(seed)
    keys = np.concatenate([rng.zipf(1.3, 40_000) % 5000, rng.integers(5000, 60_000, 40_000)]).astype(np.uint64)
    rng.shuffle(keys)
    least = 60
    summary = collocations.Summary(len(keys) // least + 1)  # the smallest capacity that the guarantee allows
    for part in np.array_split(keys, 37):
        summary.merge(*np.unique(part, return_counts=True))
        assert len(summary.keys) <= summary.capacity
    true = dict(zip(*map(np.ndarray.tolist, np.unique(keys, return_counts=True))))
    held = dict(zip(summary.keys.tolist(), summary.counts.tolist()))
    assert 0 < summary.error < least
    for key, count in true.items():
        assert held.get(key, 0) <= count <= held.get(key, 0) + summary.error
    assert {k for k, c in true.items() if c >= least} <= set(held)


def test_sent_numbers_come_back():
    rng = np.random.default_rng(1)
    hashes = rng.integers(0, 1 << 63, 5000).astype(np.uint64) * np.uint64(2)
    parts = list(collocations.summaries(np.concatenate([hashes, hashes[:100]]), 16))
    assert sum(mass for _, mass, _, _ in parts) == 5100 and len(parts) == 16
    keys = np.concatenate([np.cumsum(collocations.unpacked(k, 6), dtype=np.uint64) for _, _, k, _ in parts])
    assert keys.tolist() == np.unique(hashes >> np.uint64(16)).tolist()


def test_grams_of_equal_hash_count_apart(monkeypatch):
    monkeypatch.setattr(collocations, "hashed", lambda words: np.zeros(len(words), np.uint64))
    monkeypatch.setattr(collocations, "mixed", lambda x: x)
    grams = collocations.Grams([b"a b a b a c"], [b"en"])
    rows = collocations.counted(grams, np.full(1 << 13, 255, np.uint8))
    total = Counter()
    for lang, n, gram, count in rows:
        total[lang, n, gram] += count
    assert total[b"en", 0, None] == 6 and total[b"en", 1, "a"] == 3 and total[b"en", 1, "c"] == 1
    assert total[b"en", 2, "a b"] == 2 and total[b"en", 2, "b a"] == 2 and total[b"en", 3, "a b a"] == 2
