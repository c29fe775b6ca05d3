"""Order MinHash fingerprints of texts, and how they react to an edit. Built-in functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seriesmill.llm.common import bind, pick

#: A token is a word, or a piece of one of at most PIECE code points, so that texts without spaces have tokens too.
PIECE, TOKENS_PER_KMER = 8, 2
#: The hash space of one permutation is dealt into bins; each bin keeps the TUPLE smallest k-mers.
BIN_BITS, TUPLE = 5, 2
#: A hash and a place share 64 bits: 34 of the hash above 30 of the place.
PLACE_BITS = 30
#: Range cells found by quantiles; each is split evenly by value if more buckets are asked for.
CELLS = 256

_PLACE = (1 << PLACE_BITS) - 1
_HASH = ~_PLACE


def _long(value: int) -> Column:
    return F.lit(value).cast("long")


def _hash(c: Column) -> Column:
    return c.bitwiseAND(_long(_HASH))


def _place(c: Column) -> Column:
    return c.bitwiseAND(_long(_PLACE)).cast("int")


def _bin(c: Column) -> Column:
    return F.shiftright(c, 64 - BIN_BITS)


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(f"[^ \\x09-\\x0D]{{1,{PIECE}}}"), F.lit(0))


def sketch(text: Column) -> Column:
    """An int for each bin that holds a k-mer: 5 bits of the bin, 27 of the hash of its smallest k-mers in text order.

    k-mers that occur again are told apart by the number of their occurrence: equal ones are neighbours after sorting
    by (hash, place), and each later one gets a hash of its own from its number.
    """
    def kmers(ts: Column) -> Column:
        n = F.greatest(F.size(ts) - (TOKENS_PER_KMER - 1), F.lit(1))
        return F.transform(F.slice(ts, 1, n), lambda t, i: F.xxhash64(t, *(F.get(ts, i + j) for j in range(1, TOKENS_PER_KMER))))

    def numbered(found: Column) -> Column:
        first = F.filter(F.transform(found, lambda x, i: F.when(
            (i > 0) & (_hash(x) == _hash(F.get(found, i - 1))), F.lit(-1)).otherwise(i)), lambda i: i >= 0)
        occurrence = bind(first, lambda at: F.flatten(F.transform(
            at, lambda p, j: F.sequence(F.lit(0), F.coalesce(F.get(at, j + 1), F.size(found)) - p - 1))))
        return F.sort_array(bind(occurrence, lambda times: F.transform(found, lambda x, i: F.when(
            F.get(times, i) == 0, x).otherwise(_hash(F.xxhash64(_hash(x), F.get(times, i))).bitwiseOR(_place(x).cast("long"))))))

    def signature(ks: Column, smallest: Column) -> Column:
        def entry(x: Column, j: Column) -> Column:
            other = F.get(smallest, j + 1)
            a, b = F.get(ks, _place(x)), F.get(ks, _place(other))
            both = F.when(_place(x) < _place(other), F.xxhash64(a, b)).otherwise(F.xxhash64(b, a))
            tuple_ = F.when(_bin(other) == _bin(x), both).otherwise(F.xxhash64(a))
            value = F.shiftleft(_bin(x), 32 - BIN_BITS).bitwiseOR(F.shiftrightunsigned(tuple_, 32 + BIN_BITS))
            opens = (j == 0) | (_bin(F.get(smallest, j - 1)) != _bin(x))
            return F.when(opens, value.bitwiseAND(_long(0xFFFFFFFF)))

        return F.filter(F.transform(smallest, entry), lambda v: v.isNotNull())

    def chosen(ks: Column) -> Column:
        packed = F.sort_array(F.transform(ks, lambda h, i: _hash(h).bitwiseOR(i.cast("long"))))
        distinct = bind(packed, lambda found: F.when(F.size(F.array_distinct(F.transform(found, _hash))) == F.size(found), found)
                        .otherwise(numbered(found)))
        return bind(distinct, lambda found: F.filter(
            found, lambda x, i: F.coalesce(_bin(F.get(found, i - TUPLE)) != _bin(x), F.lit(True))))

    return bind(tokens(text), lambda ts: bind(kmers(ts), lambda ks: bind(chosen(ks), lambda smallest: signature(ks, smallest))))


def written(found: Column) -> Column:
    """A sketch as text: eight hexadecimal digits for each bin in use."""
    return F.array_join(F.transform(found, lambda v: F.lpad(F.hex(v), 8, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """The share of bins in use by either sketch in which both agree; 1 for two empty ones."""
    bins = lambda s: F.transform(s, lambda v: F.shiftright(v, 32 - BIN_BITS))
    used = F.size(F.array_union(bins(a), bins(b)))
    return F.when(used == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)).cast("double") / used)


def fingerprinted(documents: DataFrame) -> DataFrame:
    """(doc_id, fingerprint) of every row; null counts as an empty text, whose fingerprint is empty."""
    return pick(documents, "doc_id", "text").select("doc_id", written(sketch(F.coalesce("text", F.lit("")))).alias("fingerprint"))


def _tree(key: Column, bounds: list[int], leaf, lo: int, hi: int) -> Column:
    """The leaf of the range between bounds that the key lies in, by halving."""
    if hi - lo == 1:
        return leaf(lo)
    mid = (lo + hi) // 2
    return F.when(key < _long(bounds[mid]), _tree(key, bounds, leaf, lo, mid)).otherwise(_tree(key, bounds, leaf, mid, hi))


def bucketed(rows: DataFrame, buckets: int) -> Column | None:
    """A bucket that rises with doc_id, of about equal row counts; null ids are below all."""
    cells = min(CELLS, buckets)
    shares = [k / cells for k in range(1, cells)] or [0.5]
    least, most, between = rows.agg(F.min("doc_id"), F.max("doc_id"), F.percentile_approx("doc_id", shares, 10_000)).first()
    if least is None:
        return F.lit(-1)
    bounds = sorted({least, *(b for b in between if b > least)})
    ends = [*bounds[1:], most + 1]
    split = -(-buckets // len(bounds))

    def leaf(k: int) -> Column:
        part = F.floor((F.col("doc_id") - _long(bounds[k])).cast("double") * split / max(1, ends[k] - bounds[k]))
        return F.lit(k * split) + F.least(part, F.lit(split - 1)).cast("int")

    return F.when(F.col("doc_id").isNull(), F.lit(-1)).otherwise(_tree(F.col("doc_id"), bounds, leaf, 0, len(bounds)))


def with_next(rows: DataFrame, made: dict[str, Column], carried: list[str], buckets: int) -> DataFrame:
    """Each row with the columns ``made`` of it and with ``next_<column>`` of the row after it in descending doc_id;
    after the last comes the first.

    Rows are shuffled once, into buckets of neighbouring ids. Each bucket also gets a copy of the row that opens the
    bucket below it. Columns are made of rows and copies before they travel. Equal ids follow each other in the order
    of their texts, null ids come last.
    """
    bucket = bucketed(rows.select("doc_id"), buckets)
    placed = rows.withColumn("bucket", bucket)
    # One number for each bucket, as many as were asked for.
    tops = sorted(tuple(r) for r in rows.select("doc_id").withColumn("bucket", bucket).groupBy("bucket").agg(F.max("doc_id")).collect())
    if not tops:
        opening = [(-1, None)]
    else:
        opening = [(b, below) for (b, _), (_, below) in zip(tops, [tops[-1], *tops[:-1]])]
    ghosts = rows.sparkSession.range(1).select(F.inline(F.array(*(
        F.struct(F.lit(b).cast("int").alias("bucket"), F.lit(i).cast("long").alias("opens")) for b, i in opening))))
    copies = rows.join(F.broadcast(ghosts), F.col("doc_id").eqNullSafe(F.col("opens"))).drop("opens").withColumn("ghost", F.lit(1))
    order = Window.partitionBy("bucket").orderBy("ghost", F.col("doc_id").desc_nulls_last(), "text")
    both = placed.withColumn("ghost", F.lit(0)).unionByName(copies).withColumns(made)
    return both.select("*", *(F.lead(c).over(order).alias(f"next_{c}") for c in carried)).where("ghost = 0").drop("ghost", "bucket")


def compared(documents: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited form: its last floor(n/2) code points replaced by as many of the
    next document's first (all, if it has fewer), in descending order of doc_id.

    Null texts count as empty; an empty text has an empty fingerprint, and two of those have likeness 1. Null doc_ids
    come last, rows with equal doc_ids in the order of their texts, repeated rows one by one. A single document is its
    own next one. Other columns are ignored.
    """
    spark = documents.sparkSession
    rows = pick(documents, "doc_id", "text").withColumn("text", F.coalesce("text", F.lit("")))
    paired = with_next(rows, {"sketch": sketch(F.col("text"))}, ["text", "sketch"], 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.col("text").substr(F.lit(1), n - half), F.col("next_text").substr(F.lit(1), half))
    result = bind(edited, lambda e: bind(sketch(e), lambda found: F.struct(
        F.sha2(e, 256).alias("edited_sha256"), written(found).alias("edited_fingerprint"),
        likeness(F.col("sketch"), found).alias("near_edited"))))
    return paired.select("doc_id", n.cast("long").alias("n_chars"), written(F.col("sketch")).alias("fingerprint"),
                         likeness(F.col("sketch"), F.col("next_sketch")).alias("near_next"),
                         F.explode(F.array(result)).alias("e")).select(
        "doc_id", "n_chars", "e.edited_sha256", "fingerprint", "e.edited_fingerprint", "e.near_edited", "near_next")
