"""Quality rules as a ledger: each rule is measured once and kept as a bit, policies choose among the bits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesmill.llm.common import SPACES, bind, pick, words

#: Each rule: its condition of failure over the measurements. The order gives the bits and is never changed; new rules
#: are added at the end.
RULES = {
    "few_words": "n_words < 50",
    "repeated_words": "100 * n_repeat_words > 50 * n_words",
    "symbols": "5 * n_symbols > word_chars",
    "symbol_words": "10 * n_symbols > 3 * n_words",
    "duplicate_lines": "n_lines >= 4 AND 10 * n_dup_lines > 6 * n_lines",
    "capitals": "n_words >= 10 AND 2 * n_capitals > word_chars",
    "exclamations": "n_words >= 10 AND 2 * n_exclamations > n_words",
    "short_words": "2 * n_words > word_chars AND n_words >= 50",
    "long_words": "word_chars > 40 * n_words AND n_words >= 50",
    "many_words": "n_words > 1000000",
}

#: Versioned policies: the rules by which a document is rejected. A published version stays as it is.
POLICIES = {
    "base": ("few_words", "repeated_words"),
    "2024-1": ("few_words", "repeated_words", "symbols", "duplicate_lines"),
    "2024-2": ("few_words", "repeated_words", "symbols", "symbol_words", "capitals", "exclamations"),
}
CURRENT = "2024-2"

MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_capitals", "n_exclamations")


def _repeated(ws: Column) -> Column:
    """Words in three-word windows that occur at least twice. Windows are sorted by content and place, so equal ones
    are neighbours; of the places found, each adds the words that the place before it did not cover."""
    windows = F.transform(F.slice(ws, 1, F.greatest(F.size(ws) - 2, F.lit(0))),
                          lambda w, i: F.struct(F.concat_ws(" ", w, F.get(ws, i + 1), F.get(ws, i + 2)).alias("t"), i.alias("i")))

    def places(found: Column) -> Column:
        same = lambda i, j: F.get(found, i)["t"] == F.get(found, j)["t"]
        kept = F.filter(found, lambda w, i: ((i > 0) & same(i, i - 1)) | ((i < F.size(found) - 1) & same(i, i + 1)))
        return F.array_sort(F.transform(kept, lambda w: w["i"]))

    def covered(at: Column) -> Column:
        return F.aggregate(F.transform(at, lambda p, i: F.when(i == 0, 3).otherwise(F.least(p - F.get(at, i - 1), F.lit(3)))),
                           F.lit(0), lambda total, n: total + n)

    some = bind(windows, lambda found: F.when(
        F.size(F.array_distinct(F.transform(found, lambda w: w["t"]))) == F.size(found), F.lit(0)).otherwise(
        bind(F.sort_array(found), lambda ordered: bind(places(ordered), covered))))
    return F.when(F.size(ws) < 4, F.lit(0)).otherwise(some)


def measured(documents: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """(doc_id, ``keep``..., measurements): every measurement of every whole text, 0 throughout for null."""
    keep = [c for c in keep or [] if c != "doc_id"]
    text = F.coalesce(F.col("text"), F.lit(""))
    without = lambda characters: F.length(F.translate(text, characters, ""))
    long = lambda c: c.cast("long")
    lines = F.filter(F.split(text, "\n"), lambda line: F.length(F.translate(line, SPACES, "")) > 0)
    capitals = F.length(text) - F.length(F.translate(text, "".join(chr(c) for c in range(65, 91)), ""))
    counted = F.struct(
        # From the words, computed once.
        bind(words(F.col("text")), lambda ws: F.struct(long(F.size(ws)).alias("n_words"), long(_repeated(ws)).alias("n_repeat_words"))).alias("w"),
        bind(lines, lambda found: F.struct(long(F.size(found)).alias("n_lines"),
                                           long(F.size(found) - F.size(F.array_distinct(found))).alias("n_dup_lines"))).alias("l"),
        long(without(SPACES)).alias("word_chars"),
        long(F.length(text) - without("#*$%&|<>")).alias("n_symbols"),
        long(capitals).alias("n_capitals"),
        long(F.length(text) - without("!")).alias("n_exclamations"),
    )
    rows = pick(documents, "doc_id", "text", *(c for c in keep if c != "text")).withColumn("_m", F.explode(F.array(counted)))
    places = {"n_words": "_m.w.n_words", "n_repeat_words": "_m.w.n_repeat_words", "n_lines": "_m.l.n_lines", "n_dup_lines": "_m.l.n_dup_lines"}
    return rows.select("doc_id", *keep, *(F.col(places.get(m, f"_m.{m}")).alias(m) for m in MEASURES))


def bits(rules: tuple[str, ...]) -> int:
    names = list(RULES)
    return sum(1 << names.index(rule) for rule in rules)


def ledger(documents: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Measurements and ``failed_bits``: one bit for each rule that the text fails, whatever any policy says.

    Null and empty texts have no words and fail ``few_words``. doc_id may be null or repeated; each row is judged by
    itself. Only doc_id, text and ``keep`` are read.
    """
    failed = None
    for k, condition in enumerate(RULES.values()):
        bit = F.when(F.expr(condition), F.lit(1 << k).cast("long")).otherwise(F.lit(0).cast("long"))
        failed = bit if failed is None else failed.bitwiseOR(bit)
    return measured(documents, keep).withColumn("failed_bits", failed)


def apply_policy(found: DataFrame, policy: str = CURRENT) -> DataFrame:
    """Adds base_failed, kept and policy to a ledger, from its bits alone."""
    fails = lambda rules: F.col("failed_bits").bitwiseAND(F.lit(bits(rules)).cast("long")) != 0
    base = fails(POLICIES["base"])
    return found.withColumns({"base_failed": base, "kept": ~(base | fails(POLICIES[policy])), "policy": F.lit(policy)})


def ablations(found: DataFrame, policy: str = CURRENT) -> DataFrame:
    """For each rule of a policy: documents that fail it, that only it rejects, that are rejected with and without it.

    Rows are first counted by their bits, at most 2 ** len(RULES) groups, so the rest costs nothing. An empty ledger
    gives a row of zeros for each rule.
    """
    whole = bits(POLICIES[policy])
    groups = found.groupBy("failed_bits").agg(F.count("*").alias("n"))
    rules = found.sparkSession.createDataFrame([(r, bits((r,))) for r in POLICIES[policy]], "rule string, bit long")
    hit = F.coalesce(F.col("failed_bits").bitwiseAND(F.lit(whole).cast("long")), F.lit(0))
    own = hit.bitwiseAND(F.col("bit"))
    total = lambda condition: F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0))
    return groups.withColumn("rule", F.explode(F.array(*map(F.lit, POLICIES[policy])))).join(F.broadcast(rules), "rule", "right") \
        .groupBy("rule", "bit").agg(
            total(own != 0).alias("n_fail"), total(hit == F.col("bit")).alias("n_only"),
            total(hit != 0).alias("n_rejected"), total(hit.bitwiseAND(F.bitwise_not(F.col("bit"))) != 0).alias("n_rejected_without"))


def judged(documents: DataFrame, policy: str = CURRENT, keep: list[str] | None = None) -> DataFrame:
    return apply_policy(ledger(documents, keep), policy)
