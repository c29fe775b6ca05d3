"""Near-duplicate documents by bottom-k sketches, verified on whole shingle sets."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from seriesmill.llm.bpe import some
from seriesmill.llm.common import in_parts, looked_up, pick, stored, texts

#: Values that a sketch keeps, and how many two sketches share at least. Of the K smallest values of the union of two
#: sets with similarity s, each is in both with probability s, without replacement; for s >= 0.8 fewer than SHARED of
#: 64 are with probability below 1e-8, for s >= 0.85 below 1e-10.
K, SHARED = 64, 30
#: Members of a list that are compared in one block of a task.
BLOCK = 512
#: Pairs that a task holds before it hands them on.
PAIRS = 20_000
#: Parts of the hash space whose counts of values two sets are first compared by.
PARTS = 256
#: Bits of the map of keys that drops rows before an exchange: 4 MB to broadcast at any size of the input.
BITS = 1 << 25

MIX, TOP, ROW_LIMIT = np.uint64(0x9E3779B97F4A7C15), np.uint64(1 << 63), 400_000
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base modulo 2^64 and of its inverse."""
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, 1 << 19)
        base = 0x5851F42D4C957F2D
        _POWERS[:] = []
        for b in (base, pow(base, -1, 1 << 64)):
            out = np.full(size, b, np.uint64)
            out[0] = 1
            _POWERS.append(np.multiply.accumulate(out))
    return _POWERS[0][:n], _POWERS[1][:n]


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64 bits over each other."""
    x = x + MIX
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTES = mixed(np.arange(1, 257, dtype=np.uint64))
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def word_hashes(batch: list[str]) -> tuple[np.ndarray, list[int]]:
    """The hashes of all words, lower case for A-Z, and where each text's begin; the last number is that of all words."""
    joined = b"\n".join([*(t.encode().lower() for t in batch), b""])
    data = np.frombuffer(joined, np.uint8)
    ends = np.cumsum([len(t.encode()) + 1 for t in batch])
    inside = ~_SPACE[data]
    edge = np.diff(inside.astype(np.int8), prepend=0, append=0)
    lo, hi = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    power, inverse = _powers(len(data) + 1)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTES[data] * power[:len(data)], dtype=np.uint64)])
    return mixed((total[hi] - total[lo]) * inverse[lo]), [0, *np.searchsorted(lo, ends).tolist()]


def shingle_sets(batch: list[str], width: int) -> list[np.ndarray]:
    """The sorted distinct hashes of each text's shingles of ``width`` words, lower case for A-Z; a shorter text is one
    shingle, a text without words has none."""
    word, cuts = word_hashes(batch)
    rolled = mixed(word)
    shingle = rolled[:max(0, len(word) - width + 1)]
    for j in range(1, width):
        shingle = mixed(shingle * MIX + word[j:len(shingle) + j])
    out = []
    for a, b in zip(cuts[:-1], cuts[1:]):
        if b - a >= width:
            out.append(np.unique(shingle[a:b - width + 1]))
        elif b > a:
            value = mixed(np.array([b - a], np.uint64))
            for x in word[a:b]:
                value = mixed(value * MIX + x)
            out.append(value)
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def md5(text: str) -> str:
    return hashlib.md5(text.encode(), usedforsecurity=False).hexdigest()


def set_name(values: np.ndarray) -> bytes:
    return hashlib.blake2b(values.tobytes(), digest_size=16).digest()


def sketched(documents: DataFrame, width: int) -> DataFrame:
    """(doc_id, t, n, fp, sketch) of every row: the md5 of its text, the size of its set, a 128-bit name of the set, its K
    smallest hashes, with the top bit flipped, so that Spark's signed order is that of the hashes."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for all_ids, all_texts in texts(batches):
            for ids, batch in some(all_ids, all_texts, ROW_LIMIT):
                sets = shingle_sets(batch, width)
                yield pa.RecordBatch.from_arrays([
                    pa.array(ids, pa.int64()), pa.array([md5(x) for x in batch], pa.string()), pa.array([len(s) for s in sets], pa.int64()), pa.array(map(set_name, sets), pa.binary()),
                    pa.array([(s[:K] ^ TOP).view(np.int64) for s in sets], pa.list_(pa.int64()))], ["doc_id", "t", "n", "fp", "sketch"])

    return documents.mapInArrow(run, "doc_id long, t string, n long, fp binary, sketch array<long>")


def row_key(doc_id: F.Column, t: F.Column) -> F.Column:
    """A row by doc_id and the md5 of its text, never null, so that both sides of a join are dealt alike."""
    return F.concat_ws(":", F.coalesce(doc_id.cast("string"), F.lit("-")), t)


def marked(rows: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    """The rows whose key is in ``wanted``, and a few others whose key's bit is set by one that is: what a join by the key
    need not move. The map of bits is of one size; the more keys it holds, the fewer rows it drops."""
    spot = F.pmod(F.xxhash64(key), F.lit(BITS))
    bits = wanted.select(spot.alias("spot")).groupBy(F.bitmap_bucket_number("spot").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("spot")).alias("bits"))
    place = F.bitmap_bit_position(spot)
    byte = F.conv(F.hex(F.substr("bits", (F.floor(place / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    found = rows.withColumn("bucket", F.bitmap_bucket_number(spot)).join(F.broadcast(bits), "bucket")
    return found.where(F.getbit(byte, (place % 8).cast("int")) == 1).select(*rows.columns)


def texts_of(documents: DataFrame, wanted: DataFrame) -> DataFrame:
    """(fp, text) for each wanted (fp, row): the text of the class's least row. Texts of other rows are dropped before
    the exchange, and repeated rows become one after it."""
    keyed = documents.select(row_key(F.col("doc_id"), F.md5(F.coalesce("text", F.lit("")).cast("binary"))).alias("key"), "text")
    wanted = wanted.select("fp", row_key(F.col("row.doc_id"), F.col("row.t")).alias("key"))
    return marked(keyed, wanted, "key").join(wanted, "key").groupBy("key", "fp").agg(F.first("text").alias("text")).select("fp", "text")


def each_set(batch: pa.RecordBatch, columns: list[str], width: int) -> Iterator[tuple[pa.RecordBatch, list[list[np.ndarray]]]]:
    """Slices of a batch, with the shingle sets of their texts in each of the columns; a text that occurs again in a slice,
    as that of a family's centre does, is taken apart once."""
    for part in in_parts([batch], columns[0]):
        held = [part.column(c).to_pylist() for c in columns]
        distinct = list(dict.fromkeys(x for column in held for x in column))
        sets: dict[str, np.ndarray] = {}
        for names, few in some(distinct, distinct, ROW_LIMIT):
            sets.update(zip(names, shingle_sets(few, width)))
        yield part, [[sets[x] for x in column] for column in held]


def verified(pairs: DataFrame, held: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole sets satisfy 100 * intersection >= percent * union. What moves is the texts (fp, text),
    which are half as large as their sets."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, (left, right) in each_set(batch, ["left", "right"], width):
                good = []
                for x, y in zip(left, right):
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    good.append(100 * both >= percent * (len(x) + len(y) - both))
                yield part.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    first = held.select(F.col("fp").alias("b"), F.col("text").alias("right"))
    second = held.select(F.col("fp").alias("a"), F.col("text").alias("left"))
    return pairs.join(first, "b").join(second, "a").select("a", "b", "left", "right").mapInArrow(run, pairs.select("a", "b").schema)


def connected(edges: DataFrame) -> DataFrame:
    """(node, label) for the nodes of edges (a, b): label is the least node that can be reached.

    Each round hooks every node to its least neighbour, follows these pointers to their ends and contracts; what is
    left are edges between ends. All of it is joins and minima; nothing is collected but counts.
    """
    edges = stored(edges.select("a", "b").where("a <> b").distinct())
    names: DataFrame | None = None
    while edges.head(1):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        up = stored(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("label")))
        while True:
            over = up.select(F.col("node").alias("label"), F.col("label").alias("far"))
            jumped = stored(up.join(over, "label").select("node", F.col("far").alias("label"), (F.col("far") != F.col("label")).alias("moved")))
            up = jumped.drop("moved")
            if not jumped.where("moved").head(1):
                break
        if names is None:
            names = up
        else:
            over = up.select(F.col("node").alias("label"), F.col("label").alias("far"))
            names = stored(names.join(over, "label", "left").select("node", F.coalesce("far", "label").alias("label")))
        a = up.select(F.col("node").alias("a"), F.col("label").alias("x"))
        b = up.select(F.col("node").alias("b"), F.col("label").alias("y"))
        left = edges.join(a, "a").join(b, "b").where("x <> y")
        edges = stored(left.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct())
    return names if names is not None else edges.select(F.col("a").alias("node"), F.col("b").alias("label"))


def blocks(rows: DataFrame, percent: int) -> DataFrame:
    """Pairs to verify among the members (x, df, fp, n, label, at, counts) of lists x: of different labels, sizes that
    allow the similarity, enough of both sets from their place in the list on, and enough common values as far as the
    counts of values in parts of the hash space tell: similar sets always have enough. A long list is
    cut into blocks, and each pair of blocks is one group."""
    parts = F.ceil(F.col("df") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")
    dealt = rows.withColumn("parts", parts).withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    dealt = dealt.withColumn("i", F.least("own", "other")).withColumn("j", F.greatest("own", "other"))
    keys = ["x", "i", "j"]
    name = pa.binary() if rows.schema["fp"].dataType.typeName() == "binary" else pa.int64()
    dealt = dealt.select(*keys, "own", "fp", "n", "label", "at", "counts").repartition(*keys).sortWithinPartitions(*keys)

    def compare(group: list[tuple]) -> list[tuple]:
        _, i, j = group[0][:3]
        left = [row for row in group if row[3] == i]
        right = [row for row in group if row[3] == j] if i != j else left
        n, m = np.array([r[5] for r in left]), np.array([r[5] for r in right])
        place, other = np.array([r[7] for r in left]), np.array([r[7] for r in right])
        allowed = 100 * np.minimum.outer(n, m) >= percent * np.maximum.outer(n, m)
        allowed &= (100 + percent) * np.minimum.outer(n - place, m - other) >= percent * np.add.outer(n, m)
        names = {label: k for k, label in enumerate({r[6] for r in group})}
        allowed &= np.not_equal.outer([names[r[6]] for r in left], [names[r[6]] for r in right])
        parts, others = ([np.frombuffer(r[8], np.uint16) for r in side] for side in (left, right))
        pairs = []
        for p in np.flatnonzero(allowed.any(1)).tolist():
            near = np.flatnonzero(allowed[p])
            if len(parts[p]):
                both = np.array([np.minimum(parts[p], others[q]).sum(dtype=np.int64) if len(others[q]) else n[p] for q in near.tolist()])
                near = near[(100 + percent) * both >= percent * (n[p] + m[near])]
            pairs += [(min(left[p][4], right[q][4]), max(left[p][4], right[q][4])) for q in near.tolist() if left[p][4] != right[q][4]]
        return pairs

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, group = None, []

        def out(found: set[tuple]) -> pa.RecordBatch:
            listed = sorted(found)
            return pa.RecordBatch.from_arrays([pa.array([a for a, _ in listed], name), pa.array([b for _, b in listed], name)], ["a", "b"])

        for batch in batches:
            found: set[tuple] = set()
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if row[:3] != key:
                    found.update(compare(group) if group else ())
                    key, group = row[:3], []
                    if len(found) >= PAIRS:
                        yield out(found)
                        found = set()
                group.append(row)
            yield out(found)
        if group:
            yield out(set(compare(group)))

    return dealt.mapInArrow(run, dealt.select(F.col("fp").alias("a"), F.col("fp").alias("b")).schema).distinct()


def rarest(values: DataFrame, shared: F.Column) -> DataFrame:
    """Of rows (fp, n, size, x), a prefix in a common order from rare to frequent, as (x, fp, n, df, at): two sets that
    share ``shared`` values or more have one of them in both prefixes. Values of one set only need no list. Values are
    counted within tasks first, and those of the most sets get their counts by broadcast, so no value fills a task."""
    many = stored(values.groupBy("x").agg(F.count("*").alias("df")).where("df > 1").withColumn("weight", F.col("df")))
    found = looked_up(values, many, ["x"], "weight", ["fp"]).where("df IS NOT NULL")
    order = Window.partitionBy("fp")
    placed = found.withColumns({"alone": F.col("size") - F.count("*").over(order), "score": F.sum("df").over(order)}).withColumn(
        "at", F.row_number().over(order.orderBy("df", "x")) + F.col("alone") - 1)
    return placed.where(F.col("at") <= F.col("size") - shared).select("x", "fp", "n", "df", "at", "score")


def enough(percent: int) -> F.Column:
    """The least overlap that a set of n has with any set similar to it."""
    return F.ceil(F.col("n") * percent / F.lit(100)).cast("long")


def links(documents: DataFrame, classes: DataFrame, width: int, percent: int) -> DataFrame:
    """(node, label) of all classes that are linked with another, by their numbers, which take less room in lists than names.

    1. Inverted lists of retained values, from the rarest on, as many as the least overlap asks for.
    2. In each list the member with the most frequent values, the likeliest centre of a family, is compared with all
       others: the estimate over the union's sketch filters, whole sets verify. Components follow.
    3. A list whose other members still belong to several components was not compared in full. Its members make up
       lists anew, over their whole sets with an exact least overlap, and there the pairs of different components are
       compared, in blocks. So no list is compared pair by pair beyond its components, and no link is lost.
    """
    classes = classes.withColumn("fp", F.col("number"))
    exploded = classes.select("fp", "n", F.size("sketch").alias("size"), F.explode("sketch").alias("x"))
    lists = stored(rarest(exploded, F.least(F.lit(SHARED), enough(percent))))
    centre = lists.groupBy("x").agg(F.max(F.struct("score", "fp", "n")).alias("c"))
    starred = lists.join(centre, "x").where("fp <> c.fp")
    sized = 100 * F.least("n", "c.n") >= percent * F.greatest("n", "c.n")
    pairs = starred.where(sized).select(F.col("c.fp").alias("a"), F.col("fp").alias("b")).distinct()
    left = classes.select(F.col("fp").alias("a"), F.col("sketch").alias("left"))
    right = classes.select(F.col("fp").alias("b"), F.col("sketch").alias("right"))
    union = F.slice(F.array_sort(F.array_union("left", "right")), 1, K)
    common = F.size(F.array_intersect(F.array_intersect("left", "right"), union))
    likely = F.when(F.size(union) < K, 100 * common >= percent * F.size(union)).otherwise(common >= SHARED)
    pairs = stored(pairs.join(right, "b").join(left, "a").where(likely).select("a", "b"))

    listed = lists.select("fp").distinct()
    held = stored(texts_of(documents, classes.join(listed, "fp").select("fp", "row")))
    edges = stored(verified(pairs, held, width, percent))
    labels = connected(edges)

    named = lists.join(labels, lists["fp"] == labels["node"], "left").select(lists["*"], F.coalesce("label", "fp").alias("label"))
    others = named.join(centre.select("x", F.col("c.fp").alias("centre")), "x").where("fp <> centre")
    open_ = others.groupBy("x").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi").select("x")
    members = stored(named.join(open_, "x").select("fp", "n", "label").distinct())
    if not members.head(1):
        return labels
    mine = stored(held.join(members, "fp"))
    values = mine.mapInArrow(spread(width), "fp long, n long, label long, x long")
    again = rarest(values.select("fp", "n", F.col("n").alias("size"), "x"), enough(percent))
    again = again.join(mine.mapInArrow(part_counts(width), "fp long, label long, counts binary"), "fp")
    mixed_ = again.groupBy("x").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi").select("x")
    more = stored(blocks(again.join(mixed_, "x"), percent))
    if not more.head(1):
        return labels
    return connected(edges.unionByName(verified(more, held, width, percent)))


def part_counts(width: int) -> Callable:
    """How many values of each set lie in each part of the hash space; nothing for a set that has too many to count."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, (sets,) in each_set(batch, ["text"], width):
                counts = [np.bincount((s % np.uint64(PARTS)).astype(np.int64), minlength=PARTS) for s in sets]
                packed = [c.astype(np.uint16).tobytes() if c.max() < 1 << 16 else b"" for c in counts]
                yield pa.RecordBatch.from_arrays([part.column("fp"), part.column("label"), pa.array(packed, pa.binary())], ["fp", "label", "counts"])

    return run


def spread(width: int) -> Callable:
    """One row for each value of a set, a bounded number at a time."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, (sets,) in each_set(batch, ["text"], width):
                for fp, s, label in zip(part.column("fp").to_pylist(), sets, part.column("label").to_pylist()):
                    values = s.view(np.int64)
                    for lo in range(0, len(values), 100_000):
                        few = values[lo:lo + 100_000]
                        same = [pa.array(np.full(len(few), x, np.int64)) for x in (fp, len(s), label)]
                        yield pa.RecordBatch.from_arrays([*same, pa.array(few)], ["fp", "n", "label", "x"])

    return run


def classes_of(base: DataFrame) -> DataFrame:
    """One row for each set of shingles: its least row by doc_id, null last, then text, and how many rows have it; to be
    stored, so that its number stays."""
    row = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "t")
    return base.where("n > 0").groupBy("fp").agg(F.min("doc_id").alias("rep"), F.max("n").alias("n"), F.first("sketch").alias("sketch"), F.min(row).alias("row"),
                                                 F.count("*").alias("weight")).withColumn("number", F.monotonically_increasing_id())


def deduplicated(documents: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row of (doc_id, text).

    Documents are linked whose shingle sets satisfy 100 * intersection >= percent * union, and component_id is the
    least doc_id that links lead to. Equal sets are one class from the start; only classes are compared. Texts that are
    null or without words have no shingles and no links. Repeated rows are one class; of rows with null doc_id,
    component_id is that of their class (null if it has no other ids), and kept compares nulls as equal. An empty table
    gives an empty result. Other columns are ignored.
    """
    rows = pick(documents, "doc_id", "text")
    base = stored(sketched(rows, width))
    classes = stored(classes_of(base))
    labels = links(rows, classes, width, percent)
    linked = classes.select("fp", "rep", "weight", "number").join(labels, F.col("number") == F.col("node")).select("fp", "rep", "label", "weight")
    least = linked.groupBy("label").agg(F.min("rep").alias("component_id"))
    # A class of one row and without links is its own component; only the others are looked up.
    alone = classes.where("weight > 1").join(labels, F.col("number") == F.col("node"), "left_anti").select("fp", F.col("rep").alias("component_id"), "weight")
    of_class = stored(linked.join(least, "label").select("fp", "component_id", "weight").unionByName(alone).withColumn("found", F.lit(True)))
    found = looked_up(base.drop("sketch", "t"), of_class, ["fp"], "weight", ["doc_id"])
    component = F.when((F.col("n") > 0) & F.col("found").isNotNull(), F.col("component_id")).otherwise(F.col("doc_id"))
    return found.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id")).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def one_of_each(documents: DataFrame, keep: list[str], width: int = 5, percent: int = 80) -> DataFrame:
    """One row, with the columns ``keep``, of each component of (doc_id, text): that of the least doc_id, nulls last, and of
    several texts of this doc_id that of the least md5. Rows equal in both are one, with the least of their other columns.

    Whatever else a doc_id stands for is untouched: rows are told apart by doc_id and text. Texts without words have no
    copies but their repeated rows. An empty table gives an empty result.
    """
    rows = pick(documents, *keep)
    base = stored(sketched(rows.select("doc_id", "text"), width))
    classes = stored(classes_of(base))
    labels = links(rows.select("doc_id", "text"), classes, width, percent)
    group = F.coalesce("label", "number").alias("group")
    least = classes.join(labels, F.col("number") == F.col("node"), "left").groupBy(group).agg(F.min("row").alias("row"))
    bare = base.where("n = 0").select("doc_id", "t").distinct()
    wanted = least.select(row_key(F.col("row.doc_id"), F.col("row.t")).alias("key")).unionByName(
        bare.select(row_key(F.col("doc_id"), F.col("t")).alias("key")))
    keyed = rows.select(row_key(F.col("doc_id"), F.md5(F.coalesce("text", F.lit("")).cast("binary"))).alias("key"), F.struct(*rows.columns).alias("row"))
    # Repeated rows become one before the exchange, which serves the join as well.
    once = keyed.groupBy("key").agg(F.min("row").alias("row"))
    return once.join(wanted, "key", "left_semi").select("row.*")
