"""Contexts of words that are rare in the corpus count, and scores are as by brute force."""

import math
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from gaugeworks.llm import columns, suffix_tree

RNG = random.Random(8)
WORDS = [f"w{k}q{RNG.randrange(10**6)}" for k in range(400)]


def scored(spark, rows, **sizes):
    docs = spark.createDataFrame(rows, "doc_id long, text string, held boolean").repartition(3)
    return {r.doc_id: r for r in suffix_tree.scores(docs, F.col("held"), **sizes).collect()}


@pytest.mark.parametrize("sizes", [{}, {"block_bytes": 300, "bucket": 50}])
def test_by_brute_force(spark, sizes):
    passage = " ".join(WORDS[:12])
    rows = [(k, " ".join(RNG.choices(WORDS[:30], k=RNG.randint(0, 25))) + (f" {passage}" if k % 4 == 0 else ""), k % 5 == 4) for k in range(60)]
    # Shares above 1 leave no symbols' contexts: what the words' contexts begin with is then known from the counts.
    found = scored(spark, rows, symbol_share=2.0, context_share=2.0, **sizes)
    texts = {k: [*t.split(), None] for k, t, _ in rows}
    train = [texts[k] for k, _, held in rows if not held]
    count = Counter(w for t in train for w in t)
    ends, n = len(train), sum(count.values())
    rest, kinds = n - ends, len(count) - 1
    mass = rest + kinds + 1

    def start(w):
        total = mass + ends + 1
        return (ends + 1) / total if w is None else mass / total * (count[w] + 1) / mass

    after = defaultdict(Counter)
    for t in train:
        for i, w in enumerate(t):
            s = [None, *t[:i]]
            for d in range(1, min(3, len(s)) + 1):
                after[tuple(s[-d:])][w] += 1

    def given(context, w):
        if not context or sum(after[context].values()) < 2:
            return given(context[1:], w) if context else start(w)
        seen = after[context]
        return (seen[w] + len(seen) * given(context[1:], w)) / (sum(seen.values()) + len(seen))

    def passes(context):
        seen = after[context]
        total = sum(seen.values())
        return total >= 2 and sum(c * math.log(c / total / given(context[1:], w)) for w, c in seen.items()) > len(seen)

    for k, t in texts.items():
        expected = 0.0
        for i, w in enumerate(t):
            s = [None, *t[:i]]
            fit = [tuple(s[-d:]) for d in range(1, min(3, len(s)) + 1) if passes(tuple(s[-d:]))]
            expected += math.log10(given(max(fit, key=len, default=()), w))
        assert found[k].score == pytest.approx(expected, rel=1e-4)


def test_a_repeated_passage_is_known(spark):
    """The passage's words are everywhere alike, so only their order says something, and it occurs three times in 60,000 tokens."""
    passage = " ".join(RNG.sample(WORDS, 60))
    rows = [(k, " ".join(RNG.choices(WORDS, k=600)) + (f" {passage}" if k < 3 else ""), False) for k in range(100)]
    found = scored(spark, [*rows, (1000, passage, True), (1001, " ".join(RNG.sample(WORDS, 60)), True)])
    assert found[1000].score / 61 > -1.2 > -2.2 > found[1001].score / 61
    assert found[1000].score > 0.6 * found[1000].base_score


def test_blocks_stay_where_they_are(spark):
    """Exchanges between blocks and buckets move keys and answers alone: neither the blocks' tokens, nor one row for each word."""
    docs = spark.createDataFrame([(k, " ".join(RNG.choices(WORDS, k=50)), False) for k in range(40)], "doc_id long, text string, held boolean")
    blocks = suffix_tree._blocks(docs.select(F.col("doc_id").alias("id"), "held", F.col("text").alias("body")), 500)
    other = blocks.select("block").distinct()
    plan = blocks.groupBy("block").cogroup(other.groupBy("block")).applyInArrow(lambda left, right: left, blocks.schema)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in text
    assert {r.block for r in plan.collect()} == {r.block for r in other.collect()}
    totals = suffix_tree._word_totals(blocks, 3, 1.0)
    assert totals.where("of is not null").groupBy("of", "bucket").count().where("count > 1").count() == 0
    assert totals.selectExpr("inline(frequent)").count() == len({w for r in docs.collect() for w in r.text.split()})
    for table in (blocks, totals):
        columns.discard(table)


def test_staged_buckets_go_with_their_table(spark):
    """The session's setting is as before, all rows are there, and the catalog's entry goes with the files."""
    before = spark.conf.get(columns.FREED, None)
    table = columns.staged(spark.range(1000).withColumn("of", F.col("id") % 7), by="of")
    assert spark.conf.get(columns.FREED, None) == before
    assert sorted(r.id for r in table.collect()) == list(range(1000))
    names = [t.name for t in spark.catalog.listTables() if t.name.startswith("staged_")]
    columns.discard(table)
    assert len([t.name for t in spark.catalog.listTables() if t.name.startswith("staged_")]) == len(names) - 1
