"""Lines that many documents share, dropped from all of them, in built-in functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesmill.llm.common import FEW, SPACES, pick, stored

#: Documents that must hold a line for it to go.
LEAST = 10

CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def normalised(line: Column) -> Column:
    """A line without white space at its ends, A-Z in lower case and nothing else changed."""
    bare = F.btrim(line, F.lit(SPACES))
    return F.when(F.octet_length(bare) == F.length(bare), F.lower(bare)).otherwise(F.translate(bare, CAPITALS, SMALL))


def exploded(documents: DataFrame) -> DataFrame:
    """(doc_id, a, b, at, line, h, g): each line of each text with its position, 128 bits that name the text (a, b) and
    128 that name the normalised line (h, g; null for a blank line)."""
    rows = pick(documents, "doc_id", "text").withColumn("text", F.coalesce("text", F.lit("")))
    lines = rows.select("doc_id", F.xxhash64("text").alias("a"), F.xxhash64(F.lit(1), "text").alias("b"),
                        F.posexplode(F.split("text", "\n")).alias("at", "line"))
    keyed = lines.withColumn("key", normalised(F.col("line")))
    known = F.col("key") != ""
    return keyed.select("doc_id", "a", "b", "at", "line", F.when(known, F.xxhash64("key")).alias("h"),
                        F.when(known, F.xxhash64(F.lit(1), "key")).alias("g"))


def frequent(lines: DataFrame, least: int = LEAST) -> DataFrame:
    """(h, g, n_documents, n_rows) of the lines found in at least ``least`` documents. Rows of one doc_id are one document;
    without doc_id, equal texts are. A task's lines are counted by document before anything is exchanged."""
    nameless = F.when(F.col("doc_id").isNull(), F.col("a"))
    per_document = lines.where("h IS NOT NULL").withColumn("nameless", nameless).groupBy("h", "g", "doc_id", "nameless").agg(F.count("*").alias("n"))
    return per_document.groupBy("h", "g").agg(F.count("*").alias("n_documents"), F.sum("n").alias("n_rows")).where(F.col("n_documents") >= least)


def deduplicated(documents: DataFrame, least: int = LEAST, few: int = FEW) -> DataFrame:
    """(doc_id, n_lines, n_dropped, text) of every row of (doc_id, text): the text without the lines whose normalised form is
    found in at least ``least`` documents; the other lines stay as they are, in their order, joined by line breaks.

    Lines with the most rows, fewer than ``few`` by count, are broadcast; all others have few rows each and are looked
    up by an exchange of keys and positions. A text crosses the network once. Lines are told apart by 128 bits.

    Null and empty texts are one empty line, which stays; so do all blank lines. A text all of whose lines go is empty.
    Repeated rows are one document and are all returned; rows without doc_id are one document for each distinct
    text. An empty table gives an empty result. Other columns are ignored.
    """
    lines = exploded(documents)
    found = stored(frequent(lines, least))
    total = found.agg(F.coalesce(F.sum("n_rows"), F.lit(0))).first()[0]
    often = F.col("n_rows") > total // few  # so there are fewer than ``few``
    hot = found.where(often).select("h", "g", F.lit(True).alias("hot"))
    seldom = found.where(~often).select("h", "g")
    own = ["doc_id", "a", "b"]
    parts = lines.join(F.broadcast(hot), ["h", "g"], "left").select(
        *own, F.struct("at", F.lit(0).alias("mark"), F.when(F.col("hot").isNull(), F.col("line")).alias("line")).alias("part"))
    if seldom.head(1):
        marks = lines.join(seldom, ["h", "g"]).select(*own, F.struct("at", F.lit(1).alias("mark"), F.lit(None).cast("string").alias("line")).alias("part"))
        parts = parts.unionByName(marks)
    is_line = F.col("part.mark") == 0
    # Repeated rows give the same parts, each once in the set.
    whole = parts.groupBy(*own).agg(F.sort_array(F.collect_set("part")).alias("parts"),
                                    F.count(F.when(is_line & (F.col("part.at") == 0), 1)).cast("int").alias("copies"))

    def stays(part: Column, k: Column) -> Column:
        following = F.get("parts", k + 1)  # a mark comes right after its line
        marked = F.coalesce((following["at"] == part["at"]) & (following["mark"] == 1), F.lit(False))
        return (part["mark"] == 0) & part["line"].isNotNull() & ~marked

    kept = whole.select("doc_id", "copies", F.size(F.filter("parts", lambda p: p["mark"] == 0)).cast("long").alias("n_lines"),
                        F.transform(F.filter("parts", stays), lambda p: p["line"]).alias("kept"))
    return kept.withColumn("copy", F.explode(F.array_repeat(F.lit(0), F.col("copies")))).select(
        "doc_id", "n_lines", (F.col("n_lines") - F.size("kept")).alias("n_dropped"), F.array_join("kept", "\n").alias("text"))
