"""Hard negatives against SQL and brute force, and the tree's search."""

import math

import numpy as np
import pytest
from compare import connect, duck_result, spark_result
from pyspark.sql import functions as F

from gaugeworks.llm import hard_negatives as hard
from gaugeworks.llm.columns import share_code
from gaugeworks.llm.queries import llm_queries

SCHEMA = "vec_id long, embedding array<double>, label int, region string, id string, rank string"


def brute(rows, scale=256, k=5):
    usable = [
        (i, of, [math.floor(scale * x) for x in v])
        for i, v, of in rows
        if None not in (i, v, of) and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for i, of, v in usable:
        if i % 100 == 0:
            scored = [(-sum(a * b for a, b in zip(v, w)), j, x) for j, x, w in usable if j != i]
            for s, p, _ in sorted(r for r in scored if r[2] == of)[:k]:
                fit = sorted((t, j) for t, j, x in scored if x != of and 80 * -s <= 100 * -t <= 100 * -s)[:k]
                out += [(i, p, rank, j, -s, -t) for rank, (t, j) in enumerate(fit, 1)]
    return sorted(out)


def found(spark, rows, **more):
    share_code(spark)
    df = spark.createDataFrame([(*r, "own", "own", "own") for r in rows], SCHEMA).repartition(4)
    result = hard.hard_negatives(df, F.col("vec_id") % 100 == 0, **more)
    assert result.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r) for r in result.collect())


def vectors(n, width, labels, seed=0, spread=1.0):
    rng = np.random.default_rng(seed)
    return [(k * 10, (rng.normal(size=width) * spread + 0.7).tolist(), int(rng.integers(labels))) for k in range(n)]


def test_random_vectors(spark):
    rows = vectors(700, 6, 4)
    assert found(spark, rows) == brute(rows) != []


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = vectors(150, 4, 2, seed=1)
    rows += [(None, [1.0] * 4, 1), (100, None, 1), (200, [1.0] * 4, None), (300, [nan, 1.0, 1.0, 1.0], 0), (400, [inf] * 4, 0), (500, [1.0, None, 1.0, 1.0], 1)]
    rows += [(700, [0.0] * 4, 1), (800, [], 0), (900, [1.0], 1), (1000, [1.0] * 6, 0)]  # zero, empty, short and long ones
    rows += [(2000 + k, [1.5] * 4, k % 2) for k in range(40)]  # ties
    rows += [rows[0], rows[0], (2000, [1.5] * 4, 0)]  # repeated
    assert found(spark, rows) == brute(rows) != []


def test_negative_scores_have_no_window(spark):
    rows = [(0, [1.0, 0.0], 1), (1, [-1.0, 0.0], 1), (2, [-0.9, 0.0], 2), (3, [0.0, 1.0], 1), (4, [0.0, 1.0], 2)]
    assert found(spark, rows) == brute(rows) == [(0, 3, 1, 4, 0, 0)]


def test_great_numbers_stay_exact(spark):
    rows = [(100 * k, [2.0**18 + k, 2.0**18 - 3 * k, 1.0], k % 2) for k in range(12)]
    assert found(spark, rows, scale=1 << 8) == brute(rows) != []


@pytest.mark.parametrize("rows", [[], [(0, [1.0], 1)], [(0, [1.0], 1), (5, [1.0], 2)], [(0, None, None)]])
def test_few_rows(spark, rows):
    assert found(spark, rows) == []


def test_one_vector_for_a_third_of_all(spark, monkeypatch):
    monkeypatch.setattr(hard, "SMALL_REGION", 64)
    rows = vectors(400, 5, 3, seed=3) + [(10_000 + k, [0.5] * 5, k % 3) for k in range(200)]
    assert found(spark, rows) == brute(rows) != []


def test_several_groups_of_blocks(spark, monkeypatch):
    monkeypatch.setattr(hard, "SMALL_REGION", 50)
    monkeypatch.setattr(hard, "BLOCKS", 2)
    rows = vectors(600, 5, 3, seed=4)
    assert found(spark, rows) == brute(rows)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01", "sf0.1"])
def test_query_like_sql(spark, sf):
    sf_dir = f"/root/testdata/{sf}"
    result = spark_result(llm_queries()["op11_hard_negatives"](spark, sf_dir))
    assert result == duck_result(connect(sf_dir), hard.OP11_SQL) and result[1]


class TestTree:
    def tree(self, n=3000, width=3, seed=0):
        rng = np.random.default_rng(seed)
        v = np.floor(rng.normal(size=(n, width)) * 50)
        labels, ids = rng.integers(0, 3, n), rng.permutation(n)
        order, leaves = hard.packing_order(v, labels)
        assert sorted(order.tolist()) == list(range(n))
        return hard.RTree(ids[order], labels[order], v[order], leaves)

    def test_boxes_hold_their_rows(self):
        tree = self.tree()
        for level in tree.levels:
            assert len(level.first) - 1 == len(level.low)
        leaf = tree.levels[0]
        for k, (a, b) in enumerate(zip(leaf.first, leaf.first[1:])):
            assert (tree.vectors[a:b] >= leaf.low[k]).all() and (tree.vectors[a:b] <= leaf.high[k]).all()
            assert len(set(tree.labels[a:b].tolist())) == 1 and b - a <= hard.LEAF
        assert len(tree.levels[-1].low) == 1 and (tree.levels[-1].low[0] == tree.vectors.min(axis=0)).all()

    def test_search_finds_the_best_of_each_window_and_leaves_boxes_out(self):
        tree = self.tree()
        looked = []
        for anchor in tree.vectors[:40]:
            scores = tree.vectors @ anchor
            windows = [(-(10**9), 10**9), (2000, 4000), (100, 100), (10**8, 10**9)]
            got = tree.search(anchor, lambda a, b: (a <= 1) & (b >= 1), windows, 5, lambda x, i: looked.append(len(x)) or (x == 1))
            for (low, high), best in zip(windows, got):
                fit = [(s, i) for s, i, x in zip(scores, tree.ids, tree.labels) if x == 1 and low <= s <= high]
                assert best == sorted(fit, key=lambda r: (-r[0], r[1]))[:5]
        assert sum(looked) < 40 * len(tree.ids) / 3
