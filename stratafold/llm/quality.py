"""A quality score learned from preferences between documents (Bradley-Terry).

A document's strength is a weighted sum of features of its whole text.  A labelled good
document is preferred to a labelled bad one, and the weights minimise the logistic loss on
the feature differences of such pairs.  Strengths are compared with one quantile of theirs:
the score is the chance of being preferred to a document there, moved so that this quantile
has the score ``CUT``.  The weights are learned from a bounded sample, the quantile is that of all rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratafold.llm.rows import slices

# Different labels to learn from, at most; those with the smallest hash of their doc_id.
MAX_LABELLED = 20_000
# Pairs of a good and a bad document, at most.
MAX_PAIRS = 100_000
# Weight of the penalty on squared weights, per pair.
PENALTY = 1e-3
CUT = 0.3
# The cut's rank among all strengths is right to one in so many rows.
RANKS = 10_000

_NEWTON_STEPS = 30
_GROUPS = [b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b"!?", b"|", b"#$%&*@^~", b".", b",;:", b" \t", b"\n\r", b"<>{}[]()=_/\\+\"'`-"]
_GROUP_OF = np.zeros(256, np.int64)
for _number, _bytes in enumerate(_GROUPS, 1):
    _GROUP_OF[list(_bytes)] = _number
_GROUP_OF[128:] = len(_GROUPS) + 1


def features(text: str | None) -> np.ndarray:
    """Features of a whole text; NULL is empty.  They know neither its source nor its language tag."""
    raw = (text or "").encode("utf-8", "replace")
    size = max(1, len(raw))
    shares = np.bincount(_GROUP_OF[np.frombuffer(raw, np.uint8)], minlength=len(_GROUPS) + 2)[1:] / size
    words = raw.split()
    count = max(1, len(words))
    different = len(set(words))
    repeats = sum(map(bytes.__eq__, words, words[1:])) / count
    lines = [line for line in raw.split(b"\n") if line.strip()]
    again = 1 - len(set(lines)) / max(1, len(lines))
    length = (size - shares[7] * size) / count
    # The rate of new words falls with length by itself; against the square root it does so little.
    rest = [repeats, again, different / count, min(different / np.sqrt(count), 30) / 30, min(length, 40) / 10, np.log1p(len(raw)) / 10, float(not words)]
    return np.concatenate([shares, np.sqrt(shares), rest, np.sqrt(rest[:2])])


def learn(data: np.ndarray, good: np.ndarray, max_pairs: int = MAX_PAIRS, seed: int = 7) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(mean, spread, weights) of the features; without both labels the weights are zero."""
    mean = data.mean(0) if len(data) else np.zeros(len(features("")))
    spread = np.maximum(data.std(0), 1e-6) if len(data) else np.ones(len(mean))
    weights = np.zeros(len(mean))
    better, worse = np.flatnonzero(good == 1), np.flatnonzero(good == 0)
    if not len(better) or not len(worse):
        return mean, spread, weights
    scaled = (data - mean) / spread
    random = np.random.default_rng(seed)
    total = min(max_pairs, len(better) * len(worse))
    ahead = better[random.permutation(total) % len(better)]
    behind = worse[random.permutation(total) % len(worse)]
    apart = scaled[ahead] - scaled[behind]
    for _ in range(_NEWTON_STEPS):
        chance = 1 / (1 + np.exp(-np.clip(apart @ weights, -30, 30)))
        slope = apart.T @ (chance - 1) / total + PENALTY * weights
        bend = (apart * (chance * (1 - chance))[:, None]).T @ apart / total + PENALTY * np.eye(len(weights))
        step = np.linalg.solve(bend, slope)
        weights -= step * min(1.0, 5 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-6:
            break
    return mean, spread, weights


class Model:
    """Learned weights and the quantile of strength that scores ``CUT``."""

    def __init__(self, mean: np.ndarray, spread: np.ndarray, weights: np.ndarray, quantile_at: float):
        self.mean, self.spread, self.weights, self.quantile_at = mean, spread, weights, quantile_at

    def strength(self, data: np.ndarray) -> np.ndarray:
        return (data - self.mean) / self.spread @ self.weights

    def score(self, data: np.ndarray) -> np.ndarray:
        above = self.strength(data) - self.quantile_at + np.log(CUT / (1 - CUT))
        return 1 / (1 + np.exp(-np.clip(above, -500, 500)))


def held_out(doc_id: str = "doc_id"):
    """Rows that nothing is learned from: a fifth by a checksum of the id; a NULL id is not one of them."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _cut(docs: DataFrame, model: Model, share: float) -> float:
    """The strength below which ``share`` of the rows of ``docs`` lie that are not held out; every row has a part in it."""

    def strengths(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = model.strength(np.array([features(t) for t in batch.column(0).to_pylist()]))
            yield pa.record_batch([pa.array(found, pa.float64())], ["strength"])

    free = docs.filter(~held_out())
    rows = free.count()
    place = (rows - 1) * share
    # Halfway between the strengths around the place, each given by a rank that rounding cannot move.
    ranks = [(k + 0.5) / rows for k in (math.floor(place), math.ceil(place))]
    strength = free.select("text").mapInArrow(strengths, "strength double")
    around = strength.agg(F.percentile_approx("strength", ranks, RANKS).alias("at")).first()["at"]
    return float(np.mean(around))


def fit(docs: DataFrame, labels: DataFrame, quantile: float | None = None, max_labelled: int = MAX_LABELLED) -> Model:
    """Learn from labelled rows that are not held out.

    At most ``max_labelled`` labels, with two texts each, come to the driver, as features.  ``quantile`` of the
    strengths of all rows of ``docs`` that are not held out, labelled or not, scores ``CUT``;
    by default it is the share of bad ones among all labels that are not held out.
    A NULL label is none; of a doc_id labelled both ways both count.  A doc_id and label count
    once, with the two texts whose features are first and last in order if its rows hold several.
    Without good or without bad labels every document has the same strength and scores ``CUT``.
    """
    usable = labels.filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out())
    sample = usable.select("doc_id", "quality").distinct().orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(max_labelled)
    chosen = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")

    def describe(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [features(t).tolist() for t in batch.column(1).to_pylist()]
            yield pa.record_batch([batch.column(0), batch.column(2), pa.array(found, pa.list_(pa.float64()))], ["doc_id", "quality", "features"])

    # Of a doc_id that many rows repeat two texts at most come here, so the sample of labels bounds all rows.
    described = chosen.mapInArrow(describe, f"doc_id {dict(chosen.dtypes)['doc_id']}, quality {dict(chosen.dtypes)['quality']}, features array<double>")
    texts = F.array_distinct(F.array(F.min("features"), F.max("features")))
    kept = described.groupBy("doc_id", "quality").agg(texts.alias("texts")).select("doc_id", "quality", F.explode("texts").alias("features"))
    rows = kept.orderBy("doc_id", "quality", "features").collect()
    data = np.array([r["features"] for r in rows]) if rows else np.empty((0, len(features(""))))
    good = np.array([r["quality"] for r in rows], dtype=np.int64)
    mean, spread, weights = learn(data, good)
    model = Model(mean, spread, weights, 0.0)
    if weights.any():
        share = usable.agg(F.avg((F.col("quality") == 0).cast("double"))).first()[0] if quantile is None else quantile
        model.quantile_at = _cut(docs, model, share)
    return model


def score_quality(docs: DataFrame, model: Model) -> DataFrame:
    """``docs``' rows as doc_id, held_out, score, predicted; other columns are not read.

    NULL and empty texts are scored by their (empty) features; repeated rows alike.
    """

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            scores = model.score(np.array([features(t) for t in batch.column(1).to_pylist()]))
            yield pa.record_batch([batch.column(0).cast(pa.int64()), pa.array(scores, pa.float64())], ["doc_id", "score"])

    scored = docs.select("doc_id", "text").mapInArrow(score, "doc_id long, score double")
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs``, all columns, whose score reaches ``CUT``."""
    position, text = docs.columns, docs.columns.index("text")

    def keep(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            scores = model.score(np.array([features(t) for t in batch.column(text).to_pylist()]))
            yield batch.filter(pa.array(scores >= CUT))

    return docs.select(*position).mapInArrow(keep, docs.schema)
