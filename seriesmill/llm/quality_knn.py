"""Quality of documents by a vote of the nearest labelled documents in a latent-semantic space."""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from operator import eq
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from seriesmill.llm.common import in_parts, pick
from seriesmill.llm.near_dedup import word_hashes

#: The bound on labelled documents that are learned from, latent dimensions, neighbours.
SAMPLE, DIMENSIONS, NEIGHBOURS = 4096, 48, 15
#: A neighbour's weight is its cosine to this power.
SHARPNESS = 8
THRESHOLD = 0.3
#: Bytes of text and documents in a block of cosine products.
PART_BYTES, BLOCK = 500_000, 512

#: Terms of the first kind are runs of three character classes. Bytes beyond ASCII count as small letters.
CLASSES = ["abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " \t\x0b\x0c\r", "\n", ".", ",", "!?",
           "#*$%&", "|<>", "'\"-:;()[]{}/", None]
REPEATS = 4
PATTERNS = len(CLASSES) ** 3 + REPEATS
#: Terms of the second kind are words, by a hash of this width.
WORDS = 1 << 14
#: Length of the words' part of a document beside that of its patterns.
WORD_SHARE = 1.0
#: Columns of the random matrix beyond the dimensions, and products with the matrix and its transpose in range finding.
SPARE, ROUNDS = 16, 3
#: Entries of the words' matrix that are multiplied at a time.
ENTRIES = 200_000


class Counts(NamedTuple):
    """Terms of some texts: a row of patterns for each text, and text, word and number of each distinct word, text by text."""

    patterns: np.ndarray
    text: np.ndarray
    word: np.ndarray
    n: np.ndarray


def byte_classes() -> np.ndarray:
    table = np.full(256, len(CLASSES) - 1, np.uint8)
    table[128:] = 0
    for k, characters in enumerate(CLASSES[:-1]):
        table[np.frombuffer(characters.encode(), np.uint8)] = k
    return table


def pattern_counts(raw: bytes) -> np.ndarray:
    """Counts of runs of three character classes, and whether a word equals the word before it, by whether that one did."""
    n = len(CLASSES)
    out = np.zeros(PATTERNS, np.float32)
    # Long texts piece by piece; a piece begins with the last two characters of the one before.
    for lo in range(0, len(raw) - 2, PART_BYTES):
        codes = byte_classes()[np.frombuffer(raw[lo:lo + PART_BYTES + 2], np.uint8)].astype(np.int32)
        out += np.bincount(codes[:-2] * (n * n) + codes[1:-1] * n + codes[2:], minlength=PATTERNS)
    found = raw.split()
    same = list(map(eq, found, found[1:]))
    both = sum(a and b for a, b in zip(same, same[1:]))
    hits = sum(same)
    out[-4:] = both, hits, len(same) - hits, 1 if found else 0
    return out


def term_counts(batch: list[str]) -> Counts:
    """All terms of whole texts."""
    words, cuts = word_hashes(batch)
    width = np.int64(WORDS)
    text = np.repeat(np.arange(len(batch)), np.diff(cuts))
    entry, n = np.unique(text * width + (words % np.uint64(WORDS)).astype(np.int64), return_counts=True)
    patterns = np.array([pattern_counts(t.encode()) for t in batch], np.float32).reshape(len(batch), PATTERNS)
    return Counts(patterns, entry // width, entry % width, n.astype(np.float32))


def joined(parts: list[Counts]) -> Counts:
    """Terms of texts one part after the other."""
    starts = np.cumsum([0, *(len(p.patterns) for p in parts)])
    return Counts(np.concatenate([p.patterns for p in parts]), np.concatenate([p.text + at for p, at in zip(parts, starts.tolist())]),
                  np.concatenate([p.word for p in parts]), np.concatenate([p.n for p in parts]))


def product(entries: tuple[np.ndarray, np.ndarray, np.ndarray], size: int, x: np.ndarray) -> np.ndarray:
    """A sparse matrix of ``size`` rows, given as (row, column, value) in order of rows, times ``x``."""
    row, column, value = entries
    out = np.zeros((size, x.shape[1]), np.float32)
    for lo in range(0, len(row), ENTRIES):
        r = row[lo:lo + ENTRIES]
        first = np.flatnonzero(np.diff(r, prepend=-1))
        out[r[first]] += np.add.reduceat(x[column[lo:lo + ENTRIES]] * value[lo:lo + ENTRIES, None], first)
    return out


@dataclass
class Space:
    """What is broadcast: weights of the terms, the projection, the labelled vectors and their labels: (PATTERNS + WORDS) x
    (DIMENSIONS + 1) + SAMPLE x (DIMENSIONS + 1) numbers of four bytes, 4.4 MB, whatever the tables hold."""

    weights: np.ndarray
    axes: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray

    @classmethod
    def empty(cls, labels: np.ndarray) -> Space:
        terms = PATTERNS + WORDS
        return cls(np.ones(terms, np.float32), np.eye(terms, DIMENSIONS, dtype=np.float32), np.zeros((0, DIMENSIONS), np.float32), labels)

    @classmethod
    def fit(cls, counts: Counts, labels: np.ndarray) -> Space:
        """Latent axes are the leading right singular vectors of the documents' weighted frequencies, from a random range
        that a few products with the matrix turn towards them."""
        space = cls.empty(labels)
        held = np.concatenate([(counts.patterns > 0).sum(0), np.bincount(counts.word, minlength=WORDS)])
        space.weights = (np.log((1 + len(labels)) / (1 + held)) + 1).astype(np.float32)
        patterns, value = space.frequencies(counts)
        rows = counts.text, counts.word, value
        order = np.lexsort((counts.text, counts.word))
        columns = counts.word[order], counts.text[order], value[order]
        times = lambda x: patterns @ x[:PATTERNS] + product(rows, len(labels), x[PATTERNS:])
        back = lambda y: np.concatenate([patterns.T @ y, product(columns, WORDS, y)])
        basis = np.random.default_rng(7).standard_normal((PATTERNS + WORDS, DIMENSIONS + SPARE)).astype(np.float32)
        for _ in range(ROUNDS):
            basis = back(np.linalg.qr(times(np.linalg.qr(basis)[0]))[0])
        axes = np.linalg.svd(basis, full_matrices=False)[0][:, :DIMENSIONS]
        space.axes = np.zeros((PATTERNS + WORDS, DIMENSIONS), np.float32)
        space.axes[:, :axes.shape[1]] = axes
        space.vectors = space.project(counts)
        return space

    def frequencies(self, counts: Counts) -> tuple[np.ndarray, np.ndarray]:
        """Weighted frequencies: of patterns by their square root, of words by their logarithm; either kind of unit length."""
        total = np.maximum(counts.patterns.sum(1, keepdims=True), 1)
        patterns = np.sqrt(counts.patterns / total) * self.weights[:PATTERNS]
        patterns /= np.maximum(np.linalg.norm(patterns, axis=1, keepdims=True), 1e-12)
        words = (1 + np.log(counts.n)) * self.weights[PATTERNS:][counts.word]
        size = np.sqrt(np.bincount(counts.text, words * words, minlength=len(patterns)))
        return patterns, (words * WORD_SHARE / size[counts.text]).astype(np.float32)

    def project(self, counts: Counts) -> np.ndarray:
        patterns, words = self.frequencies(counts)
        vectors = patterns @ self.axes[:PATTERNS] + product((counts.text, counts.word, words), len(patterns), self.axes[PATTERNS:])
        return vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-12)

    def scores(self, batch: list[str]) -> np.ndarray:
        """The weighted share of label 1 among the nearest labelled documents."""
        prior = float(self.labels.mean()) if len(self.labels) else 0.5
        if not len(self.labels):
            return np.full(len(batch), prior)
        products = self.project(term_counts(batch)) @ self.vectors.T
        k = min(NEIGHBOURS, len(self.labels))
        near = np.argpartition(-products, k - 1, axis=1)[:, :k]
        weight = np.maximum(np.take_along_axis(products, near, 1), 0).astype(np.float64) ** SHARPNESS
        total = weight.sum(1)
        vote = (weight * self.labels[near]).sum(1) / np.where(total > 0, total, 1)
        return np.clip(np.where(total > 1e-9, vote, prior), 0, 1)


def is_held_out(folds: int = 5) -> F.Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % folds == 0, F.lit(False))


def fitted(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Space:
    """Learn from at most ``sample`` labelled documents outside the held-out fold, chosen by a hash of doc_id. Only
    their ids are shuffled; their term counts, of bounded size, come to the driver."""
    known = pick(labels, "doc_id", "quality").dropna().where(~is_held_out()).groupBy("doc_id").agg(F.avg("quality").alias("label"))
    ids = pick(documents, "doc_id").dropna().distinct()
    chosen = known.join(ids, "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_parts(batches, most=PART_BYTES):
            found = term_counts([t or "" for t in batch.column("text").to_pylist()])
            cuts = np.searchsorted(found.text, np.arange(batch.num_rows + 1)).tolist()
            packed = [zlib.compress(b"".join([patterns.tobytes(), found.word[a:b].astype("<u2").tobytes(), found.n[a:b].tobytes()]), 1)
                      for patterns, a, b in zip(found.patterns, cuts[:-1], cuts[1:])]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("label"), pa.array(packed, pa.binary())],
                                             ["doc_id", "label", "counts"])

    def unpacked(raw: bytes) -> Counts:
        raw = zlib.decompress(raw)
        n = (len(raw) - 4 * PATTERNS) // 6
        word = np.frombuffer(raw, "<u2", n, 4 * PATTERNS).astype(np.int64)
        return Counts(np.frombuffer(raw, np.float32, PATTERNS)[None], np.zeros(n, np.int64), word, np.frombuffer(raw[len(raw) - 4 * n:], np.float32))

    # A doc_id that occurs many times is learned once, with one of its texts.
    found = pick(documents, "doc_id", "text").join(F.broadcast(chosen), "doc_id").mapInArrow(count, "doc_id long, label double, counts binary")
    rows = found.groupBy("doc_id").agg(F.max("label").alias("label"), F.max("counts").alias("counts")).toPandas().sort_values("doc_id")
    labels_ = rows["label"].to_numpy(np.float64)
    return Space.fit(joined([unpacked(x) for x in rows["counts"]]), labels_) if len(rows) else Space.empty(labels_)


def scored(documents: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, sample: int = SAMPLE,
           keep: list[str] | None = None) -> DataFrame:
    """doc_id, held_out, score (0 to 1) and predicted (1 if score >= threshold) for every row, plus columns in ``keep``.

    Only the text makes the score. Nulls count as empty; a text without any term gets the share of label 1 among the
    learned documents (0.5 if there are none). Rows whose doc_id is null are scored and never learned from; labels
    that are null are ignored, several labels of a doc_id are averaged. Repeated rows score alike.
    """
    spark = documents.sparkSession
    space = spark.sparkContext.broadcast(fitted(documents, labels, sample))
    keep = [c for c in keep or [] if c not in ("doc_id", "text")]
    rows = pick(documents, "doc_id", "text", *keep)
    schema = StructType([*rows.schema.fields, StructField("score", DoubleType())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_parts(batches, most=PART_BYTES, rows=BLOCK):
            score = space.value.scores([t or "" for t in batch.column("text").to_pylist()])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score, pa.float64())], [*batch.schema.names, "score"])

    found = rows.mapInArrow(run, schema)
    return found.withColumn("held_out", is_held_out()).withColumn("predicted", (F.col("score") >= threshold).cast("int"))
