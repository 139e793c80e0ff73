"""Quality classifier from weak labels: overlapping heuristics vote, expectation-maximisation weighs them, a scorer learns.

Votes are counted over all documents by their pattern, and a pattern is one of 2 ** 9, so the estimate uses every document
while the driver sees at most that many counts. The posterior of a pattern labels a bounded sample of different texts, on
which a linear scorer over hashed features is trained; the scorer then judges every document, whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridmart.llm.common import arrow_batch, carried, per_batch, staged, texts

#: From where on, upwards or downwards, each heuristic finds its fault in a text; the second value is that of an ordinary text.
LABELLERS = {
    "symbol_share": (0.05, 0.01),
    "separator_share": (0.15, 0.02),
    "upper_share": (0.5, 0.15),
    "stutter_share": (0.2, 0.05),
    "word_count": (1, 40),
    "ended_lines": (0.1, 0.6),
    "mean_word": (2.2, 3.5),
    "distinct_share": (0.1, 0.3),
    "longest_word": (60, 30),
}
_SYMBOLS = b"#*$%&|<>{}[]\\^~=+_"
_UPPER = bytes(range(65, 91))
_END = re.compile(rb"[.!?]\W*$", re.MULTILINE)
_LINE = re.compile(rb"[^\s][^\n]*")
#: How often a heuristic is taken to find its fault in bad and in good documents, before any are counted, and how many times
#: the documents that counts for: what bad documents show is learned, that good ones hardly ever show it is given.
PRIOR, STRENGTH = (0.2, 0.002), (0.01, 20)
#: Probability that a document without a fault is good.
SEED = 0.99
#: Slots of the hashed features, and those kept for the heuristics' own values, in steps.
SLOTS, STEPS = 1 << 16, 8


def statistics(text: bytes) -> list[float]:
    """The heuristics' values, in the order of ``LABELLERS``; a text without words gives the middle of each but the count."""
    words = text.split()
    n = len(words)
    if not n:
        return [0.03, 0.05, 0.3, 0.1, 0, 0.5, 3, 0.2, 40]
    size = sum(map(len, words))
    letters = max(1, len(text.translate(None, bytes(range(65)) + bytes(range(91, 97)) + bytes(range(123, 128)))))
    lines = len(_LINE.findall(text))
    return [
        (len(text) - len(text.translate(None, _SYMBOLS))) / size,
        sum(map(text.count, (b" | ", b" |\n", b" > "))) / n,
        (len(text) - len(text.translate(None, _UPPER))) / letters,
        sum(a == b for a, b in zip(words, words[1:])) / n,
        n,
        min(1.0, len(_END.findall(text)) / max(1, lines)),
        size / n,
        len(set(words)) / n ** 0.75,
        max(map(len, words)),
    ]


def votes(values: np.ndarray) -> np.ndarray:
    """Whether each heuristic finds its fault, for each row of values; if not, it says nothing."""
    bad, ordinary = np.array(list(LABELLERS.values())).T
    sign = np.where(bad > ordinary, 1, -1)
    return sign * values >= sign * bad


def pattern(votes: np.ndarray) -> np.ndarray:
    return votes @ 2 ** np.arange(votes.shape[1])


def estimate(counts: dict[int, int], rounds: int = 200) -> tuple[dict[int, float], np.ndarray]:
    """Probability that a pattern's documents are good, and how often each heuristic fires on bad and on good documents.

    Votes are taken as independent within a class. Documents on which none fires are the seed of the good class and stay in
    it; the others start as bad. Without seed and prior, faults that never meet in one document would be shared out
    between the classes.
    """
    codes, n = np.array(list(counts), np.int64), np.array(list(counts.values()), float)
    cast = (codes[:, None] >> np.arange(len(LABELLERS))) & 1
    good = np.where(cast.any(axis=1), 0.1, SEED)
    fires = np.zeros((2, len(LABELLERS)))
    for _ in range(rounds):
        weights = np.stack([(1 - good) * n, good * n])
        prior = np.array(STRENGTH)[:, None] * max(1.0, n.sum())
        fires = (weights @ cast + prior * np.array(PRIOR)[:, None]) / (weights.sum(axis=1, keepdims=True) + prior)
        share = np.clip(weights.sum(axis=1) / max(1.0, n.sum()), 1e-6, 1)
        logs = np.log(share)[:, None] + np.log(fires) @ cast.T + np.log(1 - fires) @ (1 - cast).T
        after = np.where(cast.any(axis=1), 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -500, 500))), SEED)
        done = np.abs(after - good).max(initial=0) < 1e-9
        good = after
        if done:
            break
    return dict(zip(codes.tolist(), good.tolist())), fires


def hashed(text: bytes, values: list[float]) -> tuple[np.ndarray, np.ndarray]:
    """Slots and weights of a text: its byte trigrams by frequency, and the heuristics' values by step."""
    data = np.frombuffer(text, np.uint8).astype(np.uint32)
    parts = np.zeros(SLOTS, np.float32) if len(data) > 4 * SLOTS else None
    grams = (data[:-2] * np.uint32(0x9E3779B1) ^ data[1:-1] * np.uint32(0x85EBCA6B) ^ data[2:] * np.uint32(0xC2B2AE35)) if len(data) > 2 else data[:0]
    grams = (grams ^ grams >> np.uint32(15)) * np.uint32(0x27D4EB2F) >> np.uint32(17)
    counts = np.bincount(grams, minlength=1) if parts is None else np.bincount(grams, minlength=SLOTS)
    at = np.flatnonzero(counts)
    weight = np.sqrt(counts[at] / max(1, len(grams)))
    steps = []
    for j, (value, (bad, ordinary)) in enumerate(zip(values, LABELLERS.values())):
        step = int(np.clip((value - ordinary) / (bad - ordinary) * STEPS / 2, 0, STEPS - 1))
        steps.append(SLOTS // 2 + j * STEPS + step)
    return np.concatenate([at, steps]), np.concatenate([weight, np.full(len(steps), 0.5)])


@dataclass
class Scorer:
    """A linear scorer over the hashed slots."""

    weights: np.ndarray
    bias: float

    def score(self, slots: np.ndarray, values: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.weights[slots] @ values + self.bias, -50, 50))))


def train(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, steps: int = 150, ridge: float = 1e-4) -> Scorer:
    """Logistic regression on soft labels, both classes with equal weight, by Adam on the whole sample."""
    weights, bias = np.zeros(SLOTS), 0.0
    if not rows or not 0 < labels.sum() < len(labels):
        return Scorer(weights, 10.0 if not rows or labels.mean() > 0.5 else -10.0)
    sizes = np.array([len(s) for s, _ in rows])
    slots, values = (np.concatenate(x) for x in zip(*rows))
    owner, begins = np.repeat(np.arange(len(rows)), sizes), np.concatenate([[0], np.cumsum(sizes)[:-1]])
    weight = labels / labels.sum() + (1 - labels) / (1 - labels).sum()
    first, second = np.zeros(SLOTS + 1), np.zeros(SLOTS + 1)
    for step in range(1, steps + 1):
        margin = np.add.reduceat(weights[slots] * values, begins) + bias
        error = (1 / (1 + np.exp(-np.clip(margin, -50, 50))) - labels) * weight / 2
        grad = np.append(np.bincount(slots, values * error[owner], SLOTS) + ridge * weights, error.sum())
        first, second = 0.9 * first + 0.1 * grad, 0.99 * second + 0.01 * grad**2
        move = 0.2 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
        weights, bias = weights - move[:-1], bias - move[-1]
    return Scorer(weights.astype(np.float32), float(bias))


RESULTS = ("n_words", "weak_label", "score", "kept")


def _chosen(features: DataFrame, sample: int, slots: int) -> DataFrame:
    """Of the distinct texts' features, those of the smallest hashes, up to both bounds."""
    sizes = features.select("h", (F.length("slots") / 4).cast("long").alias("n")).orderBy("h").limit(sample).collect()
    taken = np.cumsum([r.n for r in sizes]) <= slots
    return features.where(F.col("h") <= F.lit(sizes[int(taken.sum()) - 1].h)) if taken.any() else features.limit(0)


def weak_quality(docs: DataFrame, sample: int = 4000, threshold: float = 0.5, slots: int = 4_000_000) -> DataFrame:
    """``docs`` with n_words, weak_label (the posterior of its votes), score (the linear scorer's) and kept (score from ``threshold``).

    ``sample`` and ``slots`` bound the texts the scorer is trained on, and their features: different texts in the order of
    their hashes, each once however often it is repeated. So a text that fills the table is one of them, and the same table
    gives the same scorer in whatever order it is read. Vote counts cover all documents.

    A null text is empty: only the word count finds a fault. Equal texts get equal scores; repeated rows, null and
    shared ids are judged row by row. A text of any length is read whole; its features are 65,536 slots at most. Without a
    document of either class in the sample, everything is of the other. Input columns named like a result are replaced. An
    empty table gives an empty one.
    """
    passed = carried(docs, *RESULTS)

    def vote(batch: pa.RecordBatch) -> pa.RecordBatch:
        read = texts(batch)
        hashes = np.array([xxhash.xxh3_64_intdigest(t) for t in read], np.uint64).view(np.int64)
        return arrow_batch(pattern=pattern(votes(np.array([statistics(t) for t in read]))), h=hashes)

    cast = docs.select("text").mapInArrow(per_batch(vote), "pattern long, h long")
    # A text has one pattern, so different texts can be counted by pattern.
    counted = cast.groupBy("pattern").agg(F.count("*").alias("n"), F.approx_count_distinct("h").alias("texts")).orderBy("pattern").collect()
    posterior, _ = estimate({r.pattern: r.n for r in counted})

    # Half as many again, so that the count being an estimate does not leave the sample short.
    share = min(1.0, 1.5 * (sample + 10) / max(1, sum(r.texts for r in counted)))
    h = F.xxhash64(F.coalesce("text", F.lit("")), F.lit(6))
    hashed_texts = docs.select(F.coalesce("text", F.lit("")).alias("text"), h.alias("h")).where(F.pmod("h", F.lit(1 << 30)) < F.lit(int(share * (1 << 30))))
    # Map tasks send each text once.
    different = hashed_texts.groupBy("h").agg(F.min("text").alias("text"))

    def features(batch: pa.RecordBatch) -> pa.RecordBatch:
        at_all, weights, label = [], [], []
        for text in texts(batch):
            values = statistics(text)
            at, w = hashed(text, values)
            at_all.append(at.astype(np.int32).tobytes())
            weights.append(w.astype(np.float32).tobytes())
            label.append(posterior[int(pattern(votes(np.array([values])))[0])])
        return arrow_batch(h=batch.column("h"), slots=pa.array(at_all, pa.binary()), weights=pa.array(weights, pa.binary()), label=pa.array(label, pa.float64()))

    made = staged(different.mapInArrow(per_batch(features), "h long, slots binary, weights binary, label double"), "features")
    rows = sorted(_chosen(made, sample, slots).collect(), key=lambda r: r.h)
    scorer = train([(np.frombuffer(r.slots, np.int32), np.frombuffer(r.weights, np.float32)) for r in rows], np.array([r.label for r in rows]))

    read = docs.select(*passed)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def one(batch: pa.RecordBatch) -> pa.RecordBatch:
            values = [statistics(t) for t in texts(batch)]
            label = [posterior.get(p, 0.5) for p in pattern(votes(np.array(values))).tolist()]
            score = [scorer.score(*hashed(t, v)) for t, v in zip(texts(batch), values)]
            return arrow_batch(
                **{c: batch.column(c) for c in passed}, n_words=pa.array([int(v[4]) for v in values], pa.int64()),
                weak_label=pa.array(label, pa.float64()), score=pa.array(score, pa.float64()), kept=pa.array([s >= threshold for s in score], pa.bool_()),
            )

        yield from per_batch(one)(batches)

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in read.schema)
    return read.mapInArrow(judge, f"{fields}, n_words long, weak_label double, score double, kept boolean")
