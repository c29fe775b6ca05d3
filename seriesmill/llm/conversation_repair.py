"""Conversations repaired by the cheapest edits, found by iterative-deepening A* over the roles' grammar."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesmill.llm.common import FEW, SPACES, looked_up, pick, stored

DELETE, INSERT, REROLE, TRUNCATED = 2, 5, 1, 5
#: Rows that one search covers; a longer conversation is searched in blocks, from each state to each.
BLOCK = 64
#: Turns that lie together; a conversation that spans several cells is cut between them.
CELL = 4096

# States of the grammar (s?(ua)+)?: nothing yet, after s, after u, after a.
STEP = [{"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2}]
NEW = ["u", "u", "a", "u"]  # the role that an inserted or reroled row gets
NAMES = {"u": "user", "a": "assistant"}
ENDS = (0, 3)
#: What completes a conversation after its last row, by state.
TAILS = [(0, ""), (2 * INSERT, "II"), (INSERT, "I"), (0, "")]
LEGAL = {"su", "ua", "au"}

CLEAN, BLANK, DUPLICATE, CUT = range(4)


#: Searches that a worker remembers: short conversations repeat in roles and faults.
REMEMBERED = 1 << 16


@lru_cache(REMEMBERED)
def search(rows: tuple[tuple[str, int], ...], start: int, goal: int | None) -> tuple[int, str] | None:
    """The least cost of leading rows (initial, fault) from a state to ``goal``, and the edits' initials, least in ASCII order
    among those of that cost. Without goal the rows end the conversation; with it, rows may follow, so nothing is
    inserted after the last. None if the goal cannot be reached.

    Depth first in ASCII order under a bound; the next bound is the least that exceeded it. ``least`` keeps, for each
    state that failed, the cost that it was proved to need.
    """
    n = len(rows)
    ahead = [0] * (n + 1)  # what the rows from here on cost at least
    for k in range(n - 1, -1, -1):
        initial, fault = rows[k]
        ahead[k] = ahead[k + 1] + (DELETE if fault else 0 if initial in "sua" else REROLE)
    least: dict[tuple[int, int], float] = {}
    path: list[str] = []

    def edits(at: int, state: int) -> Iterator[tuple[str, int, int, int]]:
        initial, fault = rows[at] if at < n else ("", BLANK)
        if at < n:
            yield "D", DELETE, at + 1, state
        if at < n or goal is None:
            yield "I", INSERT, at, STEP[state][NEW[state]]
        if fault in (CLEAN, CUT):
            more = TRUNCATED if fault == CUT else 0
            if initial in STEP[state]:
                yield "K", more, at + 1, STEP[state][initial]
            yield "R", REROLE + more, at + 1, STEP[state][NEW[state]]

    def needed(at: int, state: int) -> float:
        return least.get((at, state), ahead[at])

    def visit(at: int, state: int, left: float) -> bool:
        if at == n and (state in ENDS if goal is None else state == goal):
            return True
        lowest = math.inf
        for letter, cost, to, then in edits(at, state):
            need = cost + needed(to, then)
            if need <= left:
                path.append(letter)
                if visit(to, then, left - cost):
                    return True
                path.pop()
                need = cost + needed(to, then)
            lowest = min(lowest, need)
        least[at, state] = lowest
        return False

    bound = needed(0, start)
    while bound <= DELETE * n + 4 * INSERT:  # any goal that can be reached costs less
        if visit(0, start, bound):
            return int(bound), "".join(path)
        bound = needed(0, start)
    return None


def edited(rows: list[tuple[str, str]], start: int, letters: str) -> list[str]:
    """The repaired rows, as role:text, of rows (role, text) under edits."""
    out, at, state = [], 0, start
    for letter in letters:
        if letter == "D":
            at += 1
            continue
        role, text = (NAMES[NEW[state]], "") if letter == "I" else rows[at]
        if letter == "R":
            role = NAMES[NEW[state]]
        out.append(f"{role}:{text}")
        state = STEP[state][role[0]]
        at += letter != "I"
    return out


def faulted(rows: DataFrame, few: int = FEW) -> DataFrame:
    """Rows (conv_id, turn, role, text) with ``fault``, which is the first of blank, seen earlier and cut that holds, with
    ``wide``, whether the conversation spans several cells, and ``cell``. Of equal rows of one turn only the stream tells
    the first from the rest; they all have the fault of the first, and ``a`` and ``b`` name what is equal."""
    nothing = F.col("conv_id").isNull()
    same = [nothing, F.coalesce("conv_id", F.lit(0)), F.col("role"), F.col("text")]
    named = rows.withColumns({"a": F.xxhash64(*same), "b": F.xxhash64(F.lit(1), *same), "c": F.xxhash64(nothing, "conv_id"),
                              "cell": F.floor(F.coalesce(F.col("turn"), F.lit(-1)) / CELL).cast("long")})
    first = F.when(F.count("turn") == F.count("*"), F.min("turn")).alias("first")
    known = stored(named.groupBy("a", "b").agg(first, F.count("*").alias("weight")).where("weight > 1").withColumn("several", F.lit(True)))
    cells = stored(named.groupBy("c").agg((F.min("cell") < F.max("cell")).alias("wide"), F.count("*").alias("weight")).where("wide"))
    found = looked_up(named, known, ["a", "b"], "weight", ["turn", "text"], few)
    found = looked_up(found, cells, ["c"], "weight", ["turn", "text"], few)
    bare = F.btrim("text", F.lit(SPACES))
    later = F.coalesce(F.col("several"), F.lit(False)) & ~F.col("first").eqNullSafe(F.col("turn"))
    fault = F.when(bare == "", BLANK).when(later, DUPLICATE).when(~F.substring(bare, -1, 1).isin(".", "!", "?"), CUT).otherwise(CLEAN)
    return found.select("conv_id", "cell", "turn", "role", "text", fault.cast("int").alias("fault"), "a", "b",
                        F.coalesce("wide", F.lit(False)).alias("wide"))


@dataclass
class Block:
    """Neighbouring rows of a conversation, and what is counted in them."""

    conv_id: int | None = None
    cell: int | None = None
    number: int = 0
    wide: bool = False
    turns: list[int | None] = field(default_factory=list)
    rows: list[tuple[str, str]] = field(default_factory=list)
    faults: list[int] = field(default_factory=list)

    def steps(self) -> tuple[tuple[str, int], ...]:
        return tuple((role[0], fault) for (role, _), fault in zip(self.rows, self.faults))

    def counts(self) -> dict:
        roles = [role[0] for role, _ in self.rows]
        known = [t for t in self.turns if t is not None]
        return {"blank": self.faults.count(BLANK), "duplicate": self.faults.count(DUPLICATE), "truncated": self.faults.count(CUT),
                "illegal": sum(a + b not in LEGAL for a, b in zip(roles, roles[1:])), "lowest": min(known, default=None),
                "highest": max(known, default=None), "distinct": len(set(known))}


NUMBERS = ["blank", "duplicate", "truncated", "illegal"]
FOUND = pa.schema([("conv_id", pa.int64()), ("cell", pa.int64()), ("number", pa.int64()), *((c, pa.int64()) for c in NUMBERS),
                   ("lowest", pa.int64()), ("highest", pa.int64()), ("distinct", pa.int64()), ("cost", pa.int64()), ("audit", pa.string()),
                   ("repaired", pa.string()), ("starts", pa.list_(pa.int64())), ("goals", pa.list_(pa.int64())), ("costs", pa.list_(pa.int64())),
                   ("audits", pa.list_(pa.string())), ("roles", pa.list_(pa.string())), ("texts", pa.list_(pa.string()))])
FOUND_SCHEMA = ", ".join([f"{c} long" for c in ("conv_id", "cell", "number", *NUMBERS, "lowest", "highest", "distinct", "cost")] + [
    "audit string, repaired string", *(f"{c} array<long>" for c in ("starts", "goals", "costs")), *(f"{c} array<string>" for c in ("audits", "roles", "texts"))])
CONVERSATION = ["conv_id", "gaps", *NUMBERS, "cost", "audit", "repaired"]


def written(lines: list[str], with_text: bool) -> str:
    text = "\n".join(lines)
    return text if with_text else hashlib.sha256(text.encode()).hexdigest()


def searched(rows: DataFrame, with_text: bool, block: int) -> DataFrame:
    """One row for each block of ``faulted`` rows: a conversation in one block is finished there; of others each block has
    the cheapest way from each state to each, and its rows."""
    def close(now: Block, goes_on: bool) -> dict:
        out = {name: None for name in FOUND.names} | {"conv_id": now.conv_id, "cell": now.cell, "number": now.number} | now.counts()
        steps = now.steps()
        if not (goes_on or now.number or now.wide):
            out["cost"], out["audit"] = search(steps, 0, None)
            out["repaired"] = written(edited(now.rows, 0, out["audit"]), with_text)
            return out
        ways = [(s, t, *way) for s in range(len(STEP)) for t in range(len(STEP)) if (way := search(steps, s, t)) is not None]
        out |= dict(zip(("starts", "goals", "costs", "audits"), map(list, zip(*ways))))
        return out | {"roles": [r for r, _ in now.rows], "texts": [t for _, t in now.rows]}

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, before = None, None
        for batch in batches:
            out, held = [], 0
            for conv_id, cell, turn, role, text, fault, a, b, wide in zip(*(c.to_pylist() for c in batch.columns)):
                same = now is not None and (now.conv_id, now.cell) == (conv_id, cell)
                if not same or len(now.rows) >= block:
                    if now is not None:
                        out.append(close(now, same))
                    now = Block(conv_id, cell, now.number + 1 if same else 0, wide)
                    held += 1
                if same and before == (turn, a, b) and fault != BLANK:
                    fault = DUPLICATE
                before = turn, a, b
                now.turns.append(turn)
                now.rows.append((role, text))
                now.faults.append(fault)
                if held >= 1000:
                    yield pa.RecordBatch.from_pylist(out, FOUND)
                    out, held = [], 0
            yield pa.RecordBatch.from_pylist(out, FOUND)
        if now is not None:
            yield pa.RecordBatch.from_pylist([close(now, False)], FOUND)

    dealt = rows.repartition("conv_id", "cell").sortWithinPartitions("conv_id", "cell", "turn", "role", "text")
    return dealt.mapInArrow(run, FOUND_SCHEMA)


class Text:
    """A repaired conversation as it grows: as a whole, or as its hash alone."""

    def __init__(self, with_text: bool) -> None:
        self.parts: list[str] = []
        self.hash = None if with_text else hashlib.sha256()
        self.begun = False

    def with_lines(self, lines: list[str]) -> Text:
        out = Text(True)
        out.hash, out.parts, out.begun = self.hash and self.hash.copy(), self.parts + lines if self.hash is None else [], self.begun or bool(lines)
        if lines and out.hash:
            out.hash.update((("\n" if self.begun else "") + "\n".join(lines)).encode())
        return out

    def done(self) -> str:
        return "\n".join(self.parts) if self.hash is None else self.hash.hexdigest()


def chained(blocks: DataFrame, with_text: bool) -> DataFrame:
    """Conversations of several blocks, block after block: for each state the best way so far, its edits and its text."""
    def finish(conv_id: int | None, best: dict, sums: dict) -> dict:
        ends = [(cost + TAILS[s][0], letters + TAILS[s][1], s) for s, (cost, letters, _) in best.items()]
        cost, audit, state = min(ends)
        text = best[state][2].with_lines(edited([], state, TAILS[state][1]))
        gaps = 0 if sums["highest"] is None else sums["highest"] - sums["lowest"] + 1 - sums["distinct"]
        return {"conv_id": conv_id, "gaps": gaps, **{c: sums[c] for c in NUMBERS}, "cost": cost, "audit": audit, "repaired": text.done()}

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([(c, pa.string() if c in ("audit", "repaired") else pa.int64()) for c in CONVERSATION])
        conv_id, best, sums, last = None, {}, {}, ""
        for batch in batches:
            out = []
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                if not best or row["conv_id"] != conv_id:
                    if best:
                        out.append(finish(conv_id, best, sums))
                    conv_id, best, last = row["conv_id"], {0: (0, "", Text(with_text))}, ""
                    sums = {c: 0 for c in (*NUMBERS, "distinct")} | {"lowest": None, "highest": None}
                rows = list(zip(row["roles"], row["texts"]))
                ways: dict[int, tuple] = {}
                for s, t, cost, letters in zip(row["starts"], row["goals"], row["costs"], row["audits"]):
                    if s in best:
                        way = best[s][0] + cost, best[s][1] + letters, s, letters
                        ways[t] = min(ways.get(t, way), way)
                best = {t: (cost, whole, best[s][2].with_lines(edited(rows, s, letters))) for t, (cost, whole, s, letters) in ways.items()}
                for c in NUMBERS:
                    sums[c] += row[c]
                sums["illegal"] += bool(last) and last + rows[0][0][0] not in LEGAL
                last = rows[-1][0][0]
                if row["lowest"] is not None:
                    # Blocks are cut between rows, so a turn may lie on both sides.
                    sums["distinct"] += row["distinct"] - (sums["highest"] == row["lowest"])
                    sums["lowest"] = row["lowest"] if sums["lowest"] is None else sums["lowest"]
                    sums["highest"] = row["highest"]
            yield pa.RecordBatch.from_pylist(out, schema)
        if best:
            yield pa.RecordBatch.from_pylist([finish(conv_id, best, sums)], schema)

    dealt = blocks.repartition("conv_id").sortWithinPartitions("conv_id", "cell", "number")
    kinds = ", ".join(f"{c} {'string' if c in ('audit', 'repaired') else 'long'}" for c in CONVERSATION)
    return dealt.mapInArrow(run, kinds)


def repaired(conversations: DataFrame, every: DataFrame | None = None, with_text: bool = True, block: int = BLOCK, few: int = FEW) -> DataFrame:
    """One row for each conversation of rows (conv_id, turn, role, text): gaps in its turns, blank, duplicate, truncated and
    illegal rows, the least cost of edits that make it legal, the edits' initials (audit) and the repaired conversation,
    role:text by lines; without ``with_text``, the SHA-256 of that instead.

    Rows come by turn, nulls first, then by role and text. Null and empty roles, and null texts, count as one space; rows
    without conv_id are one conversation. A row is a duplicate if its role and text occur earlier, at any distance.
    Conversations in ``every`` without rows have zeros and empty texts. An empty table gives what ``every`` asks for.
    Other columns are ignored. A conversation of any length is searched in blocks, in parallel, and chained block by
    block, with the state between blocks as what they share; edits of one cost that handle the same rows are never each
    other's beginning, so that blocks' best edits make up the whole's.
    """
    blank = lambda name: F.when(F.coalesce(name, F.lit("")) == "", " ").otherwise(F.col(name)).alias(name)
    rows = pick(conversations, "conv_id", "turn", "role", "text").select("conv_id", "turn", blank("role"), F.coalesce("text", F.lit(" ")).alias("text"))
    found = stored(searched(faulted(rows, few), with_text, block))
    gaps = F.when(F.col("lowest").isNull(), 0).otherwise(F.col("highest") - F.col("lowest") + 1 - F.col("distinct")).cast("long")
    whole = found.where("starts IS NULL").withColumn("gaps", gaps).select(CONVERSATION)
    cut = found.where("starts IS NOT NULL")
    if cut.head(1):
        whole = whole.unionByName(chained(cut, with_text))
    if every is None:
        return whole
    ids = pick(every, "conv_id").distinct()
    nothing = "" if with_text else hashlib.sha256(b"").hexdigest()
    none = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", *NUMBERS, "cost")]
    named = whole.withColumnRenamed("conv_id", "_id")
    return ids.join(named, F.col("conv_id").eqNullSafe(F.col("_id")), "left").select(
        "conv_id", *none, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired", F.lit(nothing)).alias("repaired"))


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows with the damage that their hash names: crc32 of conv_id:turn, modulo 20, drops a row (0), empties its text (1),
    takes its marks of sentence ends (2), repeats it (3) or gives it the role user (4). Nulls count as one space."""
    rows = pick(conversations, "conv_id", "turn", "role", "text")
    as_text = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(as_text("conv_id"), F.lit(":"), as_text("turn")).cast("binary")) % 20
    rows = rows.withColumns({"kind": kind, "role": as_text("role"), "text": as_text("text")}).where("kind <> 0")
    rows = rows.withColumn("copy", F.explode(F.array_repeat(F.lit(0), F.when(F.col("kind") == 3, 2).otherwise(1))))
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    return rows.select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"))
