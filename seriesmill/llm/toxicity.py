"""Severity of toxic language by cumulative-link ordinal regression over sparse text features."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesmill.llm.common import pick, stored, texts

#: The bound on labelled documents that are learned from.
SAMPLE = 16_384
#: A feature is kept if so many toxic documents of the sample have it, and so many times more often than others.
LEAST, ODDS = 4, 8.0
#: Grades: none, then toxic with few, some or many marked words.
GRADES, GRADE_BOUNDS = 4, (2, 4)
REMEMBERED = 500_000

WORD = re.compile(r"[^\W\d_]+")


def word_features(word: str) -> list[str]:
    """A word, and its first four and five letters if it has more: stems of inflected and compound words."""
    return [word, *(f"{word[:n]}-" for n in (4, 5) if len(word) > n)]


def is_held_out() -> F.Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))


@dataclass
class Ordinal:
    """P(grade > k) = sigmoid(weights . x - bounds[k]): one set of weights for all ordered thresholds."""

    index: dict[str, int]
    weights: np.ndarray
    bounds: np.ndarray

    @classmethod
    def fit(cls, index: dict[str, int], rows: list[dict[int, float]], grades: np.ndarray, rounds: int = 300,
            rate: float = 0.1, ridge: float = 0.01) -> Ordinal:
        """Maximum likelihood with a ridge by full-batch Adam. Bounds rise by positive steps; weights are not negative,
        since a feature is kept only as a sign of toxicity."""
        if not index or not (grades > 0).any():
            return cls({}, np.zeros(0), np.arange(3.0, 3.0 + GRADES - 1))
        place = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
        which = np.array([f for r in rows for f in r], np.int64)
        value = np.array([v for r in rows for v in r.values()])
        shares = np.clip([(grades > k).mean() for k in range(GRADES - 1)], 1e-3, 1 - 1e-3)
        raw = np.concatenate([[-np.log(shares[0] / (1 - shares[0]))], np.full(GRADES - 2, -0.5)])
        weights = np.full(len(index), 0.5)
        m = [np.zeros_like(weights), np.zeros_like(raw)]
        v = [np.zeros_like(weights), np.zeros_like(raw)]
        sigmoid = lambda x: 1 / (1 + np.exp(-np.clip(x, -40, 40)))
        for step in range(1, rounds + 1):
            bounds = raw[0] + np.concatenate([[0], np.cumsum(np.exp(raw[1:]))])
            z = np.bincount(place, value * weights[which], minlength=len(rows))
            # Over P(grade > k) from k = -1 to the last: 1, the sigmoids, 0.
            above = np.concatenate([np.ones((len(rows), 1)), sigmoid(z[:, None] - bounds), np.zeros((len(rows), 1))], 1)
            slope = above * (1 - above)
            at = np.arange(len(rows))
            p = np.maximum(above[at, grades] - above[at, grades + 1], 1e-12)
            dz = (slope[at, grades] - slope[at, grades + 1]) / p / len(rows)
            db = np.zeros((len(rows), GRADES + 1))
            db[at, grades] -= slope[at, grades] / p
            db[at, grades + 1] += slope[at, grades + 1] / p
            db = db[:, 1:-1].mean(0)
            tail = np.cumsum(db[::-1])[::-1]
            grads = [np.bincount(which, value * dz[place], minlength=len(index)) - ridge * weights / len(rows),
                     np.concatenate([[tail[0]], tail[1:] * np.exp(raw[1:])])]
            for k, (x, g) in enumerate(zip((weights, raw), grads)):
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.999 * v[k] + 0.001 * g * g
                x += rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-10)
            np.maximum(weights, 0, out=weights)
        return cls(index, weights, raw[0] + np.concatenate([[0], np.cumsum(np.exp(raw[1:]))]))

    def above(self, rows: list[dict[int, float]]) -> np.ndarray:
        """P(grade > k) of each row for each k."""
        z = np.array([sum(self.weights[f] * v for f, v in r.items()) for r in rows])
        return 1 / (1 + np.exp(-np.clip(z[:, None] - self.bounds, -40, 40)))


class Marked:
    """Feature counts of texts; remembers a bounded number of words."""

    def __init__(self, index: dict[str, int]) -> None:
        self.index, self.known = index, {}

    def counts(self, text: str) -> tuple[dict[int, float], int]:
        """log2(1 + count) of each feature in the text, and how many words have one."""
        if len(self.known) > REMEMBERED:
            self.known.clear()
        known, found, hits = self.known, Counter(), 0
        for word in WORD.findall(text.lower()):
            mine = known.get(word)
            if mine is None:
                mine = known[word] = tuple(self.index[f] for f in word_features(word) if f in self.index)
            if mine:
                hits += 1
                found.update(mine)
        return {f: float(np.log2(1 + n)) for f, n in found.items()}, hits


def fitted(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Ordinal:
    """Learn from at most ``sample`` labelled documents outside the held-out fold. A toxic document's grade is the number
    of its marked words, cut at GRADE_BOUNDS: labels only tell toxic from not."""
    known = pick(labels, "doc_id", "toxic").dropna().where(~is_held_out()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    ids = pick(documents, "doc_id").dropna().distinct()
    chosen = known.join(ids, "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    learned = stored(pick(documents, "doc_id", "text").join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(
        F.max("toxic").alias("toxic"), F.max("text").alias("text")))

    def present(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            toxic, rest = Counter(), Counter()
            for mark, text in zip(batch.column("toxic").to_pylist(), batch.column("text").to_pylist()):
                (toxic if mark else rest).update({f for w in set(WORD.findall((text or "").lower())) for f in word_features(w)})
            names = list(toxic | rest)
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array([toxic[f] for f in names], pa.int64()),
                                              pa.array([rest[f] for f in names], pa.int64())], ["feature", "toxic", "rest"])

    n_toxic, n = learned.agg(F.coalesce(F.sum("toxic"), F.lit(0)), F.count("*")).first()
    counted = learned.mapInArrow(present, "feature string, toxic long, rest long").groupBy("feature").agg(
        F.sum("toxic").alias("toxic"), F.sum("rest").alias("rest"))
    odds = (F.col("toxic") + 0.5) / (n_toxic + 1) / ((F.col("rest") + 0.5) / (n - n_toxic + 1))
    kept = [r[0] for r in counted.where((F.col("toxic") >= LEAST) & (odds >= ODDS)).select("feature").orderBy("feature").collect()]
    index = {f: k for k, f in enumerate(kept)}

    def sparse(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marked = Marked(index)
        for batch in batches:
            rows = [marked.counts(t or "") for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array([int(bool(x)) for x in batch.column("toxic").to_pylist()], pa.int64()),
                pa.array([h for _, h in rows], pa.int64()), pa.array([list(r) for r, _ in rows], pa.list_(pa.int64())),
                pa.array([list(r.values()) for r, _ in rows], pa.list_(pa.float64()))], ["doc_id", "toxic", "hits", "features", "amounts"])

    rows = sorted(learned.mapInArrow(sparse, "doc_id long, toxic long, hits long, features array<long>, amounts array<double>").collect())
    grades = np.array([r["toxic"] * (1 + sum(r["hits"] >= b for b in GRADE_BOUNDS)) for r in rows], np.int64)
    return Ordinal.fit(index, [dict(zip(r["features"], r["amounts"])) for r in rows], grades)


def scored(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, severity (expected grade, 0 to 3), grade (the median one), score (probability of any toxicity)
    and predicted (1 if that is at least 0.5) of every row of (doc_id, text).

    Null and empty texts have no features and get the least severity. Labels that are null are ignored, the highest of
    several counts; without toxic labels nothing is toxic. Rows with null doc_id are scored and never learned from.
    Other columns are ignored.
    """
    model = documents.sparkSession.sparkContext.broadcast(fitted(documents, labels, sample))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = model.value
        marked = Marked(own.index)
        for ids, batch in texts(batches):
            above = own.above([marked.counts(t)[0] for t in batch]) if batch else np.zeros((0, GRADES - 1))
            yield pa.RecordBatch.from_arrays([
                pa.array(ids, pa.int64()), pa.array(above.sum(1), pa.float64()), pa.array((above >= 0.5).sum(1), pa.int32()),
                pa.array(above[:, 0], pa.float64()), pa.array((above[:, 0] >= 0.5).astype(np.int32), pa.int32())],
                ["doc_id", "severity", "grade", "score", "predicted"])

    found = pick(documents, "doc_id", "text").mapInArrow(run, "doc_id long, severity double, grade int, score double, predicted int")
    return found.withColumn("held_out", is_held_out())
