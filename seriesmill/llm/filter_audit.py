"""How filters interact: sorted posting lists of failing documents, and what each order of the filters removes."""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterable, Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesmill.llm.common import FEW, looked_up, pick, stored

FILTERS = "ABCDE"
EXACT_COPY = FILTERS.index("E")
#: Documents in one range of ids.
RANGE = 1 << 16
#: Bytes of a text that are split into words at a time.
PIECE = 1 << 20

SPACE = re.compile(rb"[ \t-\r]")
MARKS = re.compile(rb"[#$%&*|]")


def word_numbers(raw: bytes) -> tuple[int, int]:
    """How many words a text has, and how many different ones; long texts are split piece by piece."""
    if len(raw) <= PIECE:
        found = raw.split()
        return len(found), len(set(found))
    n, distinct, at = 0, set(), 0
    while at < len(raw):
        cut = SPACE.search(raw, at + PIECE)
        end = cut.start() if cut else len(raw)
        found = raw[at:end].split()
        n += len(found)
        distinct.update(found)
        at = end
    return n, len(distinct)


def verdicts(documents: DataFrame) -> DataFrame:
    """(doc_id, part, fails, digest) of every row: bits of the filters that a text fails by itself, 128 bits of the text."""
    def judge(text: str) -> tuple[int, bytes]:
        raw = text.encode()
        n, distinct = word_numbers(raw)
        codes = np.frombuffer(raw, np.uint8)
        capitals = int(((codes >= 65) & (codes <= 90)).sum())
        failed = n < 50, 100 * distinct < 65 * n, 100 * capitals > 5 * len(text), MARKS.search(raw) is not None
        return sum(bool(f) << k for k, f in enumerate(failed)), hashlib.blake2b(raw, digest_size=16).digest()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [judge(t or "") for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("part"), pa.array([f for f, _ in found], pa.int32()),
                                              pa.array([d for _, d in found], pa.binary())], ["doc_id", "part", "fails", "digest"])

    rows = pick(documents, "doc_id", "text", "source").select("doc_id", "text", F.coalesce("source", F.lit("")).alias("part"))
    return rows.mapInArrow(run, "doc_id long, part string, fails int, digest binary")


def judged(documents: DataFrame, labels: DataFrame, few: int = FEW) -> DataFrame:
    """(part, doc_id, fails, good, toxic, n): rows that agree in all of these are one, ``n`` says how many they are."""
    found = stored(verdicts(documents))
    copies = stored(found.groupBy("digest").agg(F.min("doc_id").alias("least"), F.count("*").alias("weight")).where("weight > 1"))
    found = looked_up(found, copies, ["digest"], "weight", ["doc_id"], few)
    again = F.when(F.col("doc_id") > F.col("least"), F.lit(1 << EXACT_COPY)).otherwise(F.lit(0))
    counted = found.select("part", "doc_id", F.col("fails").bitwiseOR(again).alias("fails")).groupBy("part", "doc_id", "fails").agg(F.count("*").alias("n"))
    is_one = lambda name: F.coalesce(F.max(F.col(name) == 1), F.lit(False)).alias(name)
    known = pick(labels, "doc_id", "quality", "toxic").where("doc_id IS NOT NULL").groupBy("doc_id").agg(is_one("quality"), is_one("toxic"))
    said = lambda name: F.coalesce(name, F.lit(False))
    return counted.join(known, "doc_id", "left").select("part", "doc_id", "fails", said("quality").alias("good"), said("toxic").alias("toxic"), "n")


#: A range of ids of a part, in order, with the number of rows that each stands for, and lists of places in ``ids``.
LISTS = [*FILTERS, "good", "toxic"]
POSTINGS = pa.schema([("part", pa.string()), ("ids", pa.list_(pa.int64())), ("weights", pa.list_(pa.int64())),
                      *((name, pa.list_(pa.int32())) for name in LISTS)])
POSTINGS_SCHEMA = "part string, ids array<long>, weights array<long>, " + ", ".join(f"`{name}` array<int>" for name in LISTS)


def postings(rows: DataFrame, size: int = RANGE) -> DataFrame:
    """Posting lists of judged rows: for each part and each range of at most ``size`` ids, the ids in order (nulls first),
    and for each filter the sorted list of the places of those that fail it, likewise of good and of toxic ones."""
    def lists(part: str, held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held)
        fails = table.column("fails").to_numpy()
        members = [fails >> k & 1 for k in range(len(FILTERS))] + [table.column(c).to_numpy() for c in ("good", "toxic")]
        columns = [[part], [table.column("doc_id").to_pylist()], [table.column("n").to_pylist()],
                   *([np.flatnonzero(m).astype(np.int32)] for m in members)]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, POSTINGS)], schema=POSTINGS)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        part, n = None, 0
        for batch in batches:
            names = batch.column("part").to_pylist()
            lo = 0
            while lo < len(names):
                if n and (names[lo] != part or n == size):
                    yield lists(part, held)
                    held, n = [], 0
                part, hi = names[lo], lo + 1
                while hi < len(names) and names[hi] == part and n + hi - lo < size:
                    hi += 1
                held.append(batch.slice(lo, hi - lo))
                n, lo = n + hi - lo, hi
        if n:
            yield lists(part, held)

    return rows.repartitionByRange("part", "doc_id").sortWithinPartitions("part", "doc_id", "fails").mapInArrow(run, POSTINGS_SCHEMA)


def member(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which of the sorted list ``a`` are in the sorted list ``b``. Keys come in order, so each is searched for from the
    place of the one before."""
    if not len(a) or not len(b):
        return np.zeros(len(a), bool)
    at = np.searchsorted(b, a)
    return b[np.minimum(at, len(b) - 1)] == a


def union(lists: list[np.ndarray]) -> np.ndarray:
    """The sorted union of sorted lists: into the longest, the others' new elements are put where galloping ends."""
    lists = sorted(lists, key=len, reverse=True)
    out = lists[0] if lists else np.zeros(0, np.int32)
    for other in lists[1:]:
        new = other[~member(other, out)]
        out = np.insert(out, np.searchsorted(out, new), new)
    return out


STEPS = "part string, before int, filter int, n long, kept long, removed long, fails long, good_lost long, toxic_lost long"


def steps(posted: DataFrame) -> DataFrame:
    """For each part, each set of filters applied before (as bits) and each filter after them: its documents, those that
    then stay, those it removes, fails, and removes of the good and toxic ones. Sizes are summed over ranges."""
    width = len(FILTERS)

    def sizes(row: dict) -> list[tuple]:
        weights = np.array(row["weights"], np.int64)
        weigh = lambda places: int(weights[places].sum())
        fails = [np.array(row[f], np.int32) for f in FILTERS]
        good, toxic = (np.array(row[c], np.int32) for c in ("good", "toxic"))
        out, n = [], int(weights.sum())
        for before in range(1 << width):
            gone = union([fails[k] for k in range(width) if before >> k & 1])
            left = n - weigh(gone)
            for k in range(width):
                if not before >> k & 1:
                    new = fails[k][~member(fails[k], gone)]
                    removed = weigh(new)
                    out.append((row["part"], before, k, n, left - removed, removed, weigh(fails[k]),
                                weigh(new[member(new, good)]), weigh(new[member(new, toxic)])))
        return out

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.string(), pa.int32(), pa.int32(), *[pa.int64()] * 6]
        names = [x.split(" ")[0] for x in STEPS.split(", ")]
        for batch in batches:
            for k in range(batch.num_rows):
                found = zip(*sizes(batch.slice(k, 1).to_pylist()[0]))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(found, kinds)], names)

    sums = ["n", "kept", "removed", "fails", "good_lost", "toxic_lost"]
    return posted.mapInArrow(run, STEPS).groupBy("part", "before", "filter").agg(*(F.sum(c).alias(c) for c in sums))


def audited(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley) for every part, order
    of the filters and step.

    Parts are the values of ``source``, null as the empty string. A document is a row; it is an exact copy if its text
    occurs with a smaller doc_id anywhere in the table, so rows without doc_id and repeated rows of one id are none.
    Null texts are empty. A document is good or toxic if any of its labels says 1; labels without doc_id are ignored.
    An empty table gives an empty result. Other columns are ignored.
    """
    found = steps(postings(stored(judged(documents, labels))))
    # Sums over all orders: a set of s filters comes before a given one in s! (4 - s)! of them.
    last = len(FILTERS) - 1
    ways = F.element_at(F.array(*(F.lit(math.factorial(s) * math.factorial(last - s)) for s in range(last + 1))), F.bit_count("before") + 1)
    alone = F.expr(f"before + shiftleft(1, filter) = {(1 << len(FILTERS)) - 1}")
    per_filter = found.groupBy("part", "filter").agg(F.sum(F.col("removed") * ways).cast("long").alias("shapley"),
                                                     F.max(F.when(alone, F.col("removed"))).alias("unique_fails"))
    orders = [("".join(FILTERS[k] for k in order), step + 1, sum(1 << k for k in order[:step]), order[step])
              for order in permutations(range(len(FILTERS))) for step in range(len(FILTERS))]
    table = documents.sparkSession.createDataFrame(orders, "filter_order string, step int, before int, filter int")
    return found.join(per_filter, ["part", "filter"]).join(F.broadcast(table), ["before", "filter"]).select(
        "part", "filter_order", "step", "kept", "removed", (F.col("fails") - F.col("removed")).alias("redundant"), "unique_fails",
        "good_lost", "toxic_lost", "shapley")
