"""Quality classifier from weak labels.

Overlapping heuristic labellers vote on each text, good (1), bad (0) or nothing (-1); none of them sees a true label.
Expectation-maximisation estimates how often each labeller is right on good and on bad texts, from how they agree and
disagree. It needs only how many documents have each pattern of votes, which is counted over all documents; the number of
patterns is bounded by the labellers (3 to their power). The posterior of a document's pattern is its label.

A linear scorer is then trained on posterior labels: features are words, hashed into `FEATURES` places, and the votes. Its
training sample is bounded by about `SAMPLE` different texts; scoring covers all of them. The draw is stratified by the patterns of
either task, so that each has its part of the sample or all of its texts: a rare kind of text is learned in a corpus of any size. The
chance of a text depends on its votes alone, which are among the features and decide the target, so the scorer needs no weights to
make up for it. In training a pattern's texts are repeated until there are `LEAST` of them.

The same model runs twice, with labellers of quality and of toxicity (a vote of 1 is clean there). A text is kept if both scores
reach one half.

A null or wordless text has no votes and no words: its scores come from the prior alone. Empty tables give empty results, copies
get equal scores.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable

import numpy as np
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeworks.llm.columns import alnum_words, append_columns, staged, word_hashes
from gaugeworks.llm.quality_rules import SYMBOLS, duplicate_lines, repeated_words

SAMPLE = 6000
LEAST = 32
FEATURES = 1 << 16
ITERATIONS = 60
EPOCHS = 5

GOOD, BAD, NONE = 1, 0, -1
_NOT_LETTERS = bytes(b for b in range(0x80) if not chr(b).isalpha())
_ODD_ENDS = {bytes([b]) for b in b"#*$%&|<>=~^_@{}[]\\/+"}

INSULTS = frozenset(
    b"idiot idiots moron morons imbecile imbeciles cretin cretins loser losers clown clowns scum scumbag scumbags vermin parasite parasites "
    b"bastard bastards jerk jerks dumbass jackass asshole assholes retard retards freak freaks pig pigs rat swine coward cowards liar liars "
    b"bitch bitches trash garbage filth dirtbag lowlife creep creeps".split()
)
CONTEMPT = frozenset(
    b"stupid worthless pathetic disgusting dumb useless ugly filthy repulsive despicable nasty idiotic moronic braindead brainless clueless "
    b"inferior subhuman degenerate degenerates hate hateful loathe loathsome sickening shameful fuck fucking fucked shit shitty crap crappy damn".split()
)


class Facts:
    """What the labellers look at, computed once for a text."""

    squeeze = None

    def __init__(self, text: bytes):
        self.text = text
        self.words = text.split()
        self.n = len(self.words)
        self.lower = alnum_words(text)
        self.counts = Counter(self.words)


def _vote(enough: bool, bad: bool) -> int:
    """Nothing on too little text; else bad or, for lack of a sign of it, good."""
    return NONE if not enough else BAD if bad else GOOD


def _symbols(f: Facts) -> int:
    return _vote(f.n >= 5, len(f.text) - len(f.text.translate(None, SYMBOLS)) > 0.02 * len(f.text))


def _capitals(f: Facts) -> int:
    upper = len(f.text) - len(f.text.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
    lower = len(f.text) - len(f.text.translate(None, b"abcdefghijklmnopqrstuvwxyz"))
    return _vote(upper + lower >= 40, upper > 0.4 * (upper + lower))


def _shouting(f: Facts) -> int:
    return _vote(f.n >= 20, f.text.count(b"!") + f.text.count(b"?") > 0.2 * f.n)


def _cells(f: Facts) -> int:
    return _vote(f.n >= 10, f.text.count(b" | ") + f.text.count(b"\t") > 0.1 * f.n)


def _plain_words(f: Facts) -> int:
    """Words of letters only, but for one mark at the end."""
    plain = sum(n for w, n in f.counts.items() if w[:-1].translate(None, _NOT_LETTERS) == w[:-1] and w[-1:] not in _ODD_ENDS)
    return NONE if f.n < 10 else BAD if plain < 0.75 * f.n else GOOD if plain > 0.9 * f.n else NONE


def _letters(f: Facts) -> int:
    solid = b"".join(f.words)
    letters = len(solid.translate(None, _NOT_LETTERS))
    return NONE if f.n < 10 else BAD if letters < 0.85 * len(solid) else GOOD if letters > 0.93 * len(solid) else NONE


def _repeats(f: Facts) -> int:
    return _vote(f.n >= 24, repeated_words(f.words) > 0.25 * f.n)


def _vocabulary(f: Facts) -> int:
    return NONE if f.n < 50 else BAD if len(f.counts) < 0.25 * min(f.n, 2000) else GOOD if len(f.counts) > 0.4 * min(f.n, 2000) else NONE


def _most_common(f: Facts) -> int:
    return _vote(f.n >= 50, max(f.counts.values(), default=0) > 0.2 * f.n)


def _compression(f: Facts) -> int:
    if len(f.text) < 512:
        return NONE
    if Facts.squeeze is None:
        Facts.squeeze = zstandard.ZstdCompressor(level=1).compress
    ratio = len(f.text) / len(Facts.squeeze(f.text))
    return _vote(True, ratio > 4.5 or ratio < 1.1)


def _sentences(f: Facts) -> int:
    ends = sum(f.text.count(x) for x in (b". ", b".\n", b"! ", b"? ", b"!\n", b"?\n")) + f.text.endswith((b".", b"!", b"?"))
    return NONE if f.n < 50 else BAD if not ends or ends > 0.5 * f.n else GOOD if f.n / 80 < ends < f.n / 4 else NONE


def _lines(f: Facts) -> int:
    lines = f.text.count(b"\n") + 1
    return _vote(lines >= 4, duplicate_lines(f.text) > 0.3 * lines)


def _word_length(f: Facts) -> int:
    mean = len(f.text) / max(1, f.n)
    return _vote(f.n >= 10, mean < 3 or mean > 18)


def _insults(f: Facts) -> int:
    return _vote(f.n > 0, not INSULTS.isdisjoint(f.lower))


def _contempt(f: Facts) -> int:
    return _vote(f.n > 0, not CONTEMPT.isdisjoint(f.lower))


def _hostile(f: Facts) -> int:
    return _vote(f.n > 0, not (INSULTS.isdisjoint(f.lower) and CONTEMPT.isdisjoint(f.lower)))


def _hostile_often(f: Facts) -> int:
    return _vote(f.n > 0, sum(w in INSULTS or w in CONTEMPT for w in f.lower) >= 2)


def _addressed(f: Facts) -> int:
    """An insult near a word that points at somebody."""
    for k, w in enumerate(f.lower):
        if w in INSULTS or w in CONTEMPT:
            near = f.lower[max(0, k - 3) : k + 4]
            if not {b"you", b"your", b"he", b"she", b"they", b"these", b"a", b"the"}.isdisjoint(near):
                return BAD
    return _vote(f.n > 0, False)


Labeller = Callable[[Facts], int]
QUALITY: tuple[Labeller, ...] = (
    _symbols, _capitals, _shouting, _cells, _plain_words, _letters,
    _repeats, _vocabulary, _most_common, _compression, _sentences, _lines, _word_length,
)
TOXICITY: tuple[Labeller, ...] = (_insults, _contempt, _hostile, _hostile_often, _addressed)
TASKS = {"quality": QUALITY, "clean": TOXICITY}
ALL = QUALITY + TOXICITY


def votes_of(text: bytes | None) -> list[int]:
    facts = Facts(text or b"")
    return [f(facts) for f in ALL]


def estimate(patterns: np.ndarray, counts: np.ndarray, iterations: int = ITERATIONS) -> tuple[float, np.ndarray]:
    """Share of good texts, and how often each labeller is right on (bad, good) texts, from patterns and their counts.

    The start says that signs of badness are seldom wrong, and that each sees only some kinds of it. It also tells which of
    the two classes is the good one, and weighs as much as ten texts.
    """
    start = np.array([0.3, 0.98])
    prior, right = 0.85, np.repeat(start[:, None], patterns.shape[1], axis=1)
    for _ in range(iterations):
        good = posterior(patterns, prior, right)
        weight = np.stack([1 - good, good]) * counts
        prior = float(np.clip(weight[1].sum() / max(counts.sum(), 1e-9), 0.02, 0.98))
        for y in (0, 1):
            said = weight[y][:, None] * (patterns != NONE)
            agreed = weight[y][:, None] * (patterns == y)
            right[y] = (agreed.sum(axis=0) + 10 * start[y]) / (said.sum(axis=0) + 10)
        right = np.clip(right, 0.01, 0.999)
    return prior, right


def posterior(patterns: np.ndarray, prior: float, right: np.ndarray) -> np.ndarray:
    """Probability that a text with these votes is good."""
    odds = np.full(len(patterns), np.log(prior / (1 - prior)))
    said_good, said_bad = patterns == GOOD, patterns == BAD
    odds += said_good @ np.log(right[1] / (1 - right[0])) + said_bad @ np.log((1 - right[1]) / right[0])
    return 1 / (1 + np.exp(-np.clip(odds, -60, 60)))


def vote_features(votes: np.ndarray, names: str) -> np.ndarray:
    """Places of the votes, one column per labeller, after the words' places."""
    base = FEATURES + 3 * sum(len(v) for k, v in TASKS.items() if k < names)
    return base + 3 * np.arange(votes.shape[1]) + votes + 1


PLACES = FEATURES + 3 * len(ALL)


class Scorer:
    """Logistic regression over hashed words (their sum over the root of their number) and votes."""

    def __init__(self):
        self.weights = np.zeros(PLACES)
        self.bias = 0.0

    def train(self, places: list[np.ndarray], values: list[np.ndarray], target: np.ndarray, epochs: int = EPOCHS, seed: int = 6) -> Scorer:
        rng = np.random.default_rng(seed)
        square, total = np.full(PLACES, 1e-6), 1e-6
        self.bias = float(np.log(target.mean() / (1 - target.mean()))) if 0 < target.mean() < 1 else 0.0
        for _ in range(epochs):
            for batch in np.array_split(rng.permutation(len(target)), max(1, len(target) // 32)):
                at = np.concatenate([places[k] for k in batch])
                x = np.concatenate([values[k] for k in batch])
                row = np.repeat(np.arange(len(batch)), [len(places[k]) for k in batch])
                error = self._sigmoid(np.bincount(row, self.weights[at] * x, len(batch)) + self.bias) - target[batch]
                some, back = np.unique(at, return_inverse=True)
                grad = np.bincount(back, error[row] * x, len(some)) / len(batch) + 1e-5 * self.weights[some]
                square[some] += grad * grad
                self.weights[some] -= 0.2 * grad / np.sqrt(square[some])
                total += error.mean() ** 2
                self.bias -= 0.1 * error.mean() / np.sqrt(total)
        return self

    @staticmethod
    def _sigmoid(x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


def _word_places(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - 16)).astype(np.int64)


def voted(docs: DataFrame, text: str = "text") -> DataFrame:
    """(key, votes) of all rows; the key is a hash of the text. Staged: a few bytes a row."""
    kind = T.StructType([T.StructField("votes", T.ArrayType(T.ByteType()))])
    bodies = docs.select(F.coalesce(F.col(text), F.lit("")).alias("body")).withColumn("key", F.xxhash64("body"))
    return staged(append_columns(bodies, ["body"], kind, lambda texts: [[votes_of(t) for t in texts]]).select("key", "votes"))


def vote_patterns(votes: DataFrame) -> list[tuple[list[int], int, int]]:
    """All patterns of votes with their counts of rows, and of different texts, over all documents."""
    different = votes.groupBy("key", "votes").count()
    found = different.groupBy("votes").agg(F.sum("count").alias("n"), F.count("*").alias("texts")).collect()
    return [(list(r.votes), r.n, r.texts) for r in found]


def shares(patterns: np.ndarray, texts: np.ndarray, sample: int) -> np.ndarray:
    """The share of each pattern's texts to draw, about ``sample`` in all: the largest of what is alike for all texts, and what gives
    each pattern of a task as many texts."""
    each = [np.full(len(texts), 1 / max(texts.sum(), 1))]
    at = 0
    for labellers in TASKS.values():
        kinds, own = np.unique(patterns[:, at : at + len(labellers)], axis=0, return_inverse=True)
        at += len(labellers)
        each.append(1 / (len(kinds) * np.bincount(own.ravel(), texts)[own.ravel()]))
    rate = np.max(each, axis=0)
    low, high = 0.0, 1 / rate.min(initial=1)
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if (texts * np.minimum(1, middle * rate)).sum() <= sample else (low, middle)
    return np.minimum(1, high * rate)


def _sampled(docs: DataFrame, text: str, votes: DataFrame, patterns: list[list[int]], share: np.ndarray) -> list:
    """(votes, word places, their counts) of different texts, of each pattern about its share, in a fixed order."""
    space, spark = 1 << 30, docs.sparkSession
    least = spark.createDataFrame([(p, int(x)) for p, x in zip(patterns, np.ceil(share * space))], "votes array<tinyint>, least long")
    keys = votes.join(F.broadcast(least), "votes").where(F.pmod("key", F.lit(space)) < F.col("least")).select("key").distinct()
    known = spark.createDataFrame(keys.collect(), "key long")  # about as many as the sample
    bodies = docs.select(F.coalesce(F.col(text), F.lit("")).alias("body")).withColumn("key", F.xxhash64("body"))
    drawn = bodies.join(F.broadcast(known), "key", "left_semi").select("body")
    kind = T.StructType([T.StructField("votes", T.ArrayType(T.ByteType())), T.StructField("places", T.ArrayType(T.IntegerType())), T.StructField("counts", T.ArrayType(T.IntegerType()))])

    def work(texts: list) -> list:
        hashes, at = word_hashes(texts)
        found = [np.unique(_word_places(hashes[a:b]), return_counts=True) for a, b in zip(at, at[1:])]
        return [[votes_of(t) for t in texts], [p.tolist() for p, _ in found], [c.tolist() for _, c in found]]

    rows_ = append_columns(drawn.distinct(), ["body"], kind, work).select(F.xxhash64("body").alias("k"), "votes", "places", "counts").collect()
    return [(list(r.votes), np.array(r.places, np.int64), np.array(r.counts, float)) for r in sorted(rows_, key=lambda r: r.k)]


def repeated(patterns: np.ndarray, least: int = LEAST) -> np.ndarray:
    """Places of all rows, those of a rare pattern again until there are ``least``."""
    _, own, counts = np.unique(patterns, axis=0, return_inverse=True, return_counts=True)
    return np.repeat(np.arange(len(patterns)), np.maximum(1, -(-least // counts))[own.ravel()])


def learn(docs: DataFrame, text: str = "text", sample: int = SAMPLE) -> dict[str, tuple]:
    """For each task: prior, accuracies and the trained scorer."""
    votes = voted(docs, text)
    found = vote_patterns(votes)
    patterns = np.array([p for p, _, _ in found], np.int64).reshape(len(found), len(ALL))
    counts, texts = (np.array([f[k] for f in found], float) for k in (1, 2))
    rows = _sampled(docs, text, votes, [p for p, _, _ in found], shares(patterns, texts, sample)) if len(found) else []
    sampled = np.array([v for v, _, _ in rows], np.int64).reshape(len(rows), len(ALL))
    out, at = {}, 0
    for name, labellers in TASKS.items():
        mine = slice(at, at + len(labellers))
        at += len(labellers)
        prior, right = estimate(patterns[:, mine], counts)
        target = posterior(sampled[:, mine], prior, right)
        scorer = Scorer()
        if len(rows):
            votes_at = vote_features(sampled[:, mine], name)
            places = [np.concatenate([p, v]) for (_, p, _), v in zip(rows, votes_at)]
            values = [np.concatenate([c / np.sqrt(max(c.sum(), 1)), np.ones(len(labellers))]) for _, _, c in rows]
            again = repeated(sampled[:, mine])
            scorer.train([places[k] for k in again], [values[k] for k in again], target[again])
        out[name] = (prior, right, scorer)
    return out


def score(docs: DataFrame, model: dict[str, tuple], text: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with a struct ``out``: for each task the score and the posterior of the votes. One narrow pass."""
    kind = T.StructType([T.StructField(f"{name}_{x}", T.DoubleType()) for name in TASKS for x in ("score", "posterior")])

    def work(texts: list) -> list:
        hashes, at = word_hashes(texts)
        places, lengths = _word_places(hashes), np.diff(at)
        votes = np.array([votes_of(t) for t in texts], np.int64).reshape(len(texts), len(ALL))
        owner = np.repeat(np.arange(len(texts)), lengths)
        columns, start = {}, 0
        for name, labellers in TASKS.items():
            prior, right, scorer = model[name]
            mine = votes[:, start : start + len(labellers)]
            start += len(labellers)
            words = np.bincount(owner, scorer.weights[places], len(texts)) / np.sqrt(np.maximum(lengths, 1))
            linear = words + scorer.weights[vote_features(mine, name)].sum(axis=1) + scorer.bias
            columns[f"{name}_score"] = scorer._sigmoid(linear).tolist()
            columns[f"{name}_posterior"] = posterior(mine, prior, right).tolist()
        return [[dict(zip(columns, row)) for row in zip(*columns.values())]]

    return append_columns(docs, [text], T.StructType([T.StructField(out, kind)]), work)


def op6_quality_model(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    scored = score(docs, learn(docs))
    quality, clean = F.col("score.quality_score"), F.col("score.clean_score")
    return scored.select(
        "doc_id",
        quality.alias("score"),
        (quality >= 0.5).cast("int").alias("quality"),
        (1 - clean).alias("toxic_score"),
        (clean < 0.5).cast("int").alias("toxic"),
        ((quality >= 0.5) & (clean >= 0.5)).alias("kept"),
        F.col("score.quality_posterior").alias("posterior"),
    )
