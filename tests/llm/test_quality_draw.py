"""Rare kinds of text are learned in a corpus of any size."""

import random

import numpy as np
import pytest

from gaugeworks.llm import quality_model

RNG = random.Random(6)
WORDS = ["".join(RNG.choices("etaoinshrdlu", k=RNG.randint(2, 9))) for _ in range(3000)]
TOXIC = ["you are a stupid worthless idiot", "these filthy vermin are disgusting", "you pathetic moron, nobody likes your garbage"]


def prose(words):
    text = RNG.choices(WORDS, k=words)
    return " ".join(w + ("." if k % 12 == 11 else "") for k, w in enumerate(text)) + "."


@pytest.mark.parametrize("toxic", [3, 6])
def test_a_handful_of_toxic_texts_is_found(spark, toxic):
    rows = [(k, prose(60)) for k in range(20_000)]
    rows += [(100_000 + k, f"{prose(30)} {TOXIC[k % 3]}! {prose(25)}") for k in range(toxic)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    scored = quality_model.score(docs, quality_model.learn(docs, sample=1000))
    found = {r.doc_id: r.score for r in scored.select("doc_id", "score").collect()}
    assert [k for k, s in found.items() if s.clean_posterior < 0.5] and all(found[100_000 + k].clean_score < 0.5 for k in range(toxic))
    assert sum(s.clean_score < 0.5 for s in found.values()) == toxic


def test_the_draw_is_of_different_texts(spark):
    rows = [(k, "the same old text of a few plain words") for k in range(5000)] + [(k, prose(20)) for k in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    votes = quality_model.voted(docs)
    found = quality_model.vote_patterns(votes)
    assert sum(n for _, n, _ in found) == 5300 and sum(k for _, _, k in found) == 301
    patterns, texts = np.array([p for p, _, _ in found]), np.array([float(k) for _, _, k in found])
    share = quality_model.shares(patterns, texts, 1000)
    assert len(quality_model._sampled(docs, "text", votes, [p for p, _, _ in found], share)) == 301


def test_shares():
    patterns = np.ones((4, len(quality_model.ALL)), int)
    patterns[1, 0], patterns[2, -1], patterns[3, -2] = 0, 0, 0
    texts = np.array([1e6, 3e3, 50, 2])
    drawn = texts * quality_model.shares(patterns, texts, 6000)
    assert drawn.sum() == pytest.approx(6000, rel=1e-6) and drawn[2:].tolist() == [50, 2] and drawn[1] > 1000 and drawn[0] > 1000
    assert quality_model.shares(patterns, texts, 10**7).tolist() == [1, 1, 1, 1]
