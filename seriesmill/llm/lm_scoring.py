"""Scoring texts by a smoothed n-gram model kept as a weighted automaton with failure arcs."""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesmill.llm.common import in_parts, pick, stored, texts
from seriesmill.llm.near_dedup import MIX, mixed

#: Text that one bucket holds, unless a single text is longer.
BUCKET_BYTES = 5 << 20
#: Text whose pairs of words meet in one part of the pairs' table; the number of parts grows with the corpus.
PART_BYTES = 12 << 20
#: Pairs seen at least so often in training have an arc, at any size of the corpus.
LEAST = 2
DISCOUNT = 0.75
FOLDS, HELD_OUT = 7, 2
#: The token that ends a text; no word holds white space.
END = b"\n"

RESULT = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
                    ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])


def is_held_out(doc_id: int | None) -> bool:
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % FOLDS == HELD_OUT


def split(text: bytes) -> list[bytes]:
    """Words in lower case for A-Z: bytes are lowered and split as ASCII."""
    return text.lower().split()


def pressed(x: np.ndarray | bytes) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(x if isinstance(x, bytes) else x.tobytes())


def opened(x: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(x)


def bucketed(documents: DataFrame) -> DataFrame:
    """Rows of (bucket, doc_ids, sizes, words, row, bytes): runs of a task's documents with their number of tokens, the distinct
    words by first occurrence, and all tokens as numbers of words, of which 0 is the end. They are written once, so
    every later step sees the same buckets, and texts are taken apart once."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, made = TaskContext.get().partitionId() << 32, 0
        ids: list = []
        rows: list[np.ndarray] = []
        size = 0
        code = fresh()

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([
                pa.array([base + made], pa.int64()), pa.array([ids], pa.list_(pa.int64())),
                pa.array([[len(r) for r in rows]], pa.list_(pa.int64())), pa.array([pressed(END.join(islice(code, 1, None)))], pa.binary()),
                pa.array([pressed(np.concatenate(rows))], pa.binary()), pa.array([size], pa.int64())],
                ["bucket", "doc_ids", "sizes", "words", "row", "bytes"])

        for doc_ids, batch in texts(in_parts(batches)):
            for doc_id, text in zip(doc_ids, batch):
                raw = text.encode()
                if rows and size + len(raw) > BUCKET_BYTES:
                    yield out()
                    made, ids, rows, size, code = made + 1, [], [], 0, fresh()
                found = split(raw)
                ids.append(doc_id)
                rows.append(np.fromiter(chain(map(code.__getitem__, found), (0,)), np.uint32, len(found) + 1))
                size += len(raw) + 64
        if rows:
            yield out()

    return documents.mapInArrow(run, "bucket long, doc_ids array<long>, sizes array<long>, words binary, row binary, bytes long")


def fresh() -> defaultdict[bytes, int]:
    """Numbers of words: a new word gets the next one."""
    code: defaultdict[bytes, int] = defaultdict(None, {END: 0})
    code.default_factory = code.__len__
    return code


def walked(sizes: list[int], words: bytes, row: bytes) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray]:
    """A bucket's words, its tokens as numbers, the first token of each text, and the state before each token: a word's
    number, or that after the last for the start of a text."""
    known = [END, *opened(words).split()]  # no word holds white space
    tokens = np.frombuffer(opened(row), np.uint32).astype(np.int64)
    first = np.cumsum(sizes) - sizes
    states = np.concatenate([[0], tokens[:-1]])
    states[first] = len(known)
    return known, tokens, first, states


def trains(ids: list, sizes: list[int]) -> np.ndarray:
    """Of each token of a bucket, whether the model learns from it."""
    return np.repeat([not is_held_out(d) for d in ids], sizes)


BUCKET = ("bucket", "doc_ids", "sizes", "words", "row")


def each(batch: pa.RecordBatch | pa.Table) -> Iterator[tuple]:
    """The buckets of a batch, one taken out at a time."""
    for k in range(batch.num_rows):
        yield tuple(batch.column(c)[k].as_py() for c in BUCKET)


def word_counts(buckets: DataFrame) -> DataFrame:
    """(word, bucket, n): the distinct words of each bucket with their number in its training documents."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for bucket, ids, sizes, words, row in each(batch):
                known, tokens, *_ = walked(sizes, words, row)
                n = np.bincount(tokens[trains(ids, sizes)], minlength=len(known))
                yield pa.RecordBatch.from_arrays([pa.array(known, pa.binary()), pa.array(np.full(len(known), bucket)), pa.array(n)],
                                                 ["word", "bucket", "n"])

    return buckets.mapInArrow(run, "word binary, bucket long, n long")


@dataclass
class Automaton:
    """States: the root (-1), one for each word, and the start of a text (the last). ``arcs`` are sorted keys
    state << 32 | word of the explicit arcs with their log10 weights; without one, the failure arc leads to the root
    at the state's weight, and the root has an arc for every word."""

    words: list[bytes]
    arcs: np.ndarray
    weights: np.ndarray
    failure: np.ndarray
    tokens: int
    distinct: int

    def unigram(self, counts: np.ndarray) -> np.ndarray:
        return np.log10((counts + 1) / (self.tokens + self.distinct + 1))

    @classmethod
    def build(cls, words: list[tuple[bytes, int]], pairs: list[tuple[int, int]], starts: int, tokens: int, distinct: int) -> Automaton:
        """Absolute discounting: an arc's probability is its discounted share plus the state's rest times the unigram's;
        the rest is what the arcs leave."""
        counts = np.array([*(c for _, c in words), starts], np.float64)
        keys = np.array([k for k, _ in pairs], np.int64)
        order = np.argsort(keys)
        keys, n = keys[order], np.array([c for _, c in pairs], np.float64)[order]
        return cls.of([word for word, _ in words], keys, n, counts, np.bincount(keys >> 32, n - DISCOUNT, minlength=len(counts)), tokens, distinct)

    @classmethod
    def of(cls, words: list[bytes], keys: np.ndarray, n: np.ndarray, counts: np.ndarray, mass: np.ndarray, tokens: int,
           distinct: int) -> Automaton:
        """Some states of a larger automaton with some of their arcs: ``counts`` of the states in the corpus, and ``mass``,
        the discounted counts of all arcs that they have there."""
        rest = np.maximum(1 - mass / np.maximum(counts, 1), 1e-12)
        made = cls(words, keys, np.zeros(0), np.append(np.log10(rest), 0.0), tokens, distinct)
        state, word = keys >> 32, keys & 0xFFFFFFFF
        made.weights = np.log10((n - DISCOUNT) / counts[state] + rest[state] * 10 ** made.unigram(counts[word]))
        return made

    def traverse(self, states: np.ndarray, words: np.ndarray, unigram: np.ndarray) -> np.ndarray:
        """The weight of each step of left-to-right walks: ``states`` before each token, the token's number among the
        words with states (-1 for others) and its weight at the root."""
        if not len(self.arcs):
            return unigram + self.failure[states]
        key = states << 32 | words
        at = np.minimum(np.searchsorted(self.arcs, key), len(self.arcs) - 1)
        found = (self.arcs[at] == key) & (states >= 0) & (words >= 0)
        return np.where(found, self.weights[at], self.failure[states] + unigram)


def word_key(word: bytes) -> int:
    """60 bits of the word's xxHash with Spark's seed, as ``key_column`` has them."""
    return xxhash.xxh64_intdigest(word, 42) >> 4


def key_column(word: str) -> F.Column:
    return F.shiftrightunsigned(F.xxhash64(word), 4)


#: The key of the start of a text.
START = -1


def opens(found: np.ndarray) -> np.ndarray:
    """Where the runs of equal values of a sorted array begin."""
    return np.flatnonzero(np.concatenate([[True], found[1:] != found[:-1]])[:len(found)])


def dealt(words: list[bytes], pair: np.ndarray, parts: int) -> tuple[np.ndarray, ...]:
    """The order in which the distinct pairs of a bucket, sorted keys state << 32 | word, are dealt into parts (as they come
    within one), and in that order their parts and the keys of both words. The same bucket always gives the same
    order."""
    keys = np.array([*map(word_key, words), START], np.int64)
    left, right = keys[pair >> 32], keys[pair & 0xFFFFFFFF]
    part = (mixed(left.view(np.uint64) * MIX + right.view(np.uint64)) % np.uint64(parts)).astype(np.int64)
    # Small numbers sort by their digits.
    order = np.argsort(part.astype(np.uint16) if parts <= 1 << 16 else part, kind="stable")
    return order, part[order], left[order], right[order]


def asked_pairs(buckets: DataFrame, parts: int) -> DataFrame:
    """(part, bucket, lefts, rights, counts): the distinct pairs of each bucket, one row for each part, with their number
    in its training documents, which is 0 for those that only its other documents have."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for bucket, ids, sizes, words, row in each(batch):
                known, tokens, _, states = walked(sizes, words, row)
                # With a last bit that tells tokens of training, one sort finds the pairs and counts them.
                marked = np.sort((states << 32 | tokens) << 1 | trains(ids, sizes))
                first = opens(marked >> 1)
                pair = marked[first] >> 1
                order, part, left, right = dealt(known, pair, parts)
                n = np.add.reduceat(marked & 1, first)[order]
                cuts = np.flatnonzero(np.diff(part, prepend=-1, append=-1)).tolist()
                spans = list(zip(cuts[:-1], cuts[1:]))
                yield pa.RecordBatch.from_arrays([
                    pa.array([int(part[a]) for a, _ in spans], pa.int64()), pa.array([bucket] * len(spans), pa.int64()),
                    pa.array([pressed(left[a:b]) for a, b in spans], pa.binary()),
                    pa.array([right[a:b].tobytes() for a, b in spans], pa.binary()),
                    pa.array([pressed(n[a:b]) for a, b in spans], pa.binary())],
                    ["part", "bucket", "lefts", "rights", "counts"])

    return buckets.mapInArrow(run, "part long, bucket long, lefts binary, rights binary, counts binary")


COUNTED = pa.schema([("bucket", pa.int64()), ("part", pa.int64()), ("counts", pa.binary()), ("key", pa.int64()), ("mass", pa.float64())])


def counted_pairs(asked: DataFrame) -> DataFrame:
    """For each row of asked pairs, (bucket, part, counts): their number in the whole corpus. In rows without bucket,
    (key, mass): the discounted counts of a word's arcs in a part."""
    def run(table: pa.Table) -> pa.Table:
        part = table.column("part")[0].as_py()
        cuts = np.cumsum([0, *(len(x.as_py()) // 8 for x in table.column("rights"))])

        def column(name: str) -> np.ndarray:
            """All numbers of a column, one row opened at a time."""
            out = np.empty(cuts[-1], np.int64)
            for a, b, x in zip(cuts[:-1], cuts[1:], table.column(name)):
                out[a:b] = np.frombuffer(x.as_py() if name == "rights" else opened(x.as_py()), np.int64)
            return out

        x, y = column("lefts"), column("rights")
        order = np.lexsort((y, x))
        x, y = x[order], y[order]
        new = np.concatenate([[True], (x[1:] != x[:-1]) | (y[1:] != y[:-1])])
        x, y = x[new], None
        n = column("counts")
        total = np.add.reduceat(n[order], np.flatnonzero(new))
        n[order] = total[np.cumsum(new) - 1]  # now the number of each pair in the whole corpus
        arcs = total >= LEAST
        having = x[arcs]
        first = opens(having)
        key, mass = having[first], np.add.reduceat(total[arcs] - DISCOUNT, first) if len(first) else np.zeros(0)
        back = [pressed(n[a:b]) for a, b in zip(cuts[:-1], cuts[1:])]
        none, more = [None] * len(key), [None] * len(back)
        return pa.Table.from_arrays([
            pa.array(table.column("bucket").to_pylist() + none, pa.int64()), pa.array([part] * (len(back) + len(key)), pa.int64()),
            pa.array(back + none, pa.binary()), pa.array(more + key.tolist(), pa.int64()), pa.array(more + mass.tolist(), pa.float64())],
            schema=COUNTED)

    return asked.groupBy("part").applyInArrow(run, "bucket long, part long, counts binary, key long, mass double")


def scored(documents: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row of (doc_id, text).

    Learns from documents whose crc32(doc_id as text) mod 7 is not 2, and from those without doc_id. Counts of all words
    and of all pairs of words stay distributed: each bucket of documents sends its distinct words and pairs, and gets
    their counts back. score is the log10 probability of the text by all pairs seen at least LEAST times, backing off to
    the counts of single words with one added for each and for all unknown words together, which is base_score. Words
    are told apart by 60 bits of a hash where pairs are counted.

    Null and empty texts are one end token. Repeated rows count, and are scored, as often as they occur. An empty table
    gives an empty result. Other columns are ignored.
    """
    buckets = stored(bucketed(pick(documents, "doc_id", "text")))
    held = buckets.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
    parts = 1 + held // PART_BYTES
    pairs = stored(counted_pairs(asked_pairs(buckets, parts)))
    mass = pairs.where("bucket IS NULL").groupBy("key").agg(F.sum("mass").alias("mass"))
    start_mass = mass.where(F.col("key") == START).agg(F.coalesce(F.max("mass"), F.lit(0.0))).first()[0]
    asked = word_counts(buckets).repartition("word")
    # A word occurs at most once in each bucket; counted and joined where it lies.
    known = asked.groupBy("word").agg(F.sum("n").alias("c"), F.min("bucket").alias("first"))
    known = known.withColumn("key", key_column("word")).join(mass, "key", "left").select("word", "c", "first", "mass")
    # With n among the answers both uses take the same columns, so that one exchange serves them.
    answers = stored(asked.join(known, "word").select("bucket", "word", "n", "c", "mass", (F.col("bucket") == F.col("first")).alias("once")))
    once = answers.where("once")
    tokens, distinct, starts = once.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.when(F.col("c") > 0, 1)),
                                        F.coalesce(F.max(F.when(F.col("word") == F.lit(bytearray(END)), F.col("c"))), F.lit(0))).first()

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        given = right.filter(right.column("word").is_valid())
        counted = right.filter(right.column("counts").is_valid()).sort_by("part").column("counts").to_pylist()
        place = {word: k for k, word in enumerate(given.column("word").to_pylist())}
        c, m = given.column("c").to_numpy(), given.column("mass").fill_null(0.0).to_numpy()
        out: list[tuple] = []
        for _, ids, sizes, words, row in each(left):
            known, row, first, states = walked(sizes, words, row)
            at = np.fromiter(map(place.__getitem__, known), np.int64, len(known))
            counts, mass = np.append(c[at], starts), np.append(m[at], start_mass)
            walks = np.sort(states << 32 | row)
            pair = walks[opens(walks)]
            order = dealt(known, pair, parts)[0]
            n = np.empty(len(pair), np.int64)
            n[order] = np.concatenate([np.frombuffer(opened(x), np.int64) for x in counted])
            arcs = n >= LEAST
            model = Automaton.of(known, pair[arcs], n[arcs], counts, mass, tokens, distinct)
            unigram = model.unigram(counts)
            weights = model.traverse(states, row, unigram[row])
            n_known = np.add.reduceat((counts[row] > 0).astype(np.int64), first)
            out += zip(ids, map(is_held_out, ids), sizes, n_known.tolist(), [tokens] * len(ids),
                       np.add.reduceat(unigram[row], first).tolist(), np.add.reduceat(weights, first).tolist())
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(list(zip(*out)) or [[]] * len(RESULT), RESULT)], schema=RESULT)

    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    told = answers.select("bucket", "word", "c", "mass").unionByName(
        pairs.where("bucket IS NOT NULL").select("bucket", "part", "counts"), allowMissingColumns=True)
    return buckets.groupBy("bucket").cogroup(told.groupBy("bucket")).applyInArrow(score, schema)
