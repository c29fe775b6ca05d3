"""Filter audit, line dedup and conversation repair against brute force on small odd tables."""

import collections
import hashlib
import itertools
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import prose, rows_of
from seriesmill.llm import conversation_repair, filter_audit, line_dedup

SPACES = " \t\n\x0b\x0c\r"


def small(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


# Lines

def lines_by_hand(rows, least):
    held = collections.defaultdict(set)
    for doc_id, text in rows:
        for line in (text or "").split("\n"):
            key = small(line.strip(SPACES))
            if key:
                held[key].add((doc_id, text or "" if doc_id is None else None))
    gone = {key for key, documents in held.items() if len(documents) >= least}
    out = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if small(x.strip(SPACES)) not in gone]
        out.append((doc_id, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


@pytest.fixture
def shared_lines():
    rng = random.Random(4)
    common = ["All rights reserved.", "  ALL rights reserved.\t", "Über uns", "über uns", "\x0bhome | about\r", "--", "", " ", " ", "x" * 5000]
    rows = []
    for k in range(60):
        lines = [rng.choice(common) if rng.random() < 0.6 else prose(k * 50 + j, 4) for j in range(rng.randint(0, 14))]
        rows.append((k, "\n".join(lines)))
    rows += [(7, rows[7][1])] * 40 + [(8, "another text of 8\n--")] * 3 + [(100, None), (101, ""), (102, "\n"), (103, "a\n\na\n"), (104, "--\n--")]
    rows += [(None, "--\nno id")] * 12 + [(None, f"--\nline of {k}") for k in range(3)] + [(105, "no id\n" * 3000 + "end")]
    return rows


@pytest.mark.parametrize("few", [100_000, 40, 1])
def test_lines(spark, shared_lines, few):
    """With all frequent lines broadcast, with some, with none."""
    df = spark.createDataFrame([(*r, 1, "k") for r in shared_lines], "doc_id long, text string, at int, KEPT string").repartition(5)
    found = line_dedup.deduplicated(df, 10, few)
    assert rows_of(found, "doc_id", "n_lines", "n_dropped", "text") == lines_by_hand(shared_lines, 10)


def test_lines_odd(spark, odd, odd_rows, none):
    assert rows_of(line_dedup.deduplicated(odd, 2), "doc_id", "n_lines", "n_dropped", "text") == lines_by_hand(odd_rows, 2)
    assert line_dedup.deduplicated(none).count() == 0


def test_lines_stay_native(odd):
    assert not re.search(r"MapInArrow|PythonUDF|ArrowEval|BatchEval|FlatMapGroups", line_dedup.deduplicated(odd)._jdf.queryExecution().toString())


# Filter audit

def fails_by_hand(rows):
    least = {}
    for doc_id, text, _ in rows:
        if doc_id is not None:
            least[text or ""] = min(least.get(text or "", doc_id), doc_id)
    out = []
    for doc_id, text, part in rows:
        t = text or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        hit = [len(w) < 50, 100 * len(set(w)) < 65 * len(w), 100 * len(re.findall("[A-Z]", t)) > 5 * len(t), bool(re.search(r"[#$%&*|]", t)),
               doc_id is not None and doc_id > least[t]]
        out.append((doc_id, part or "", {f for f, h in zip("ABCDE", hit) if h}))
    return out


def audit_by_hand(rows, labels):
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    judged = fails_by_hand(rows)
    out = []
    for part in {p for _, p, _ in judged}:
        mine = [(d, f) for d, p, f in judged if p == part]
        shapley = collections.Counter()
        for order in itertools.permutations("ABCDE"):
            left = mine
            for f in order:
                shapley[f] += sum(f in x for _, x in left)
                left = [(d, x) for d, x in left if f not in x]
        for order in itertools.permutations("ABCDE"):
            left = mine
            for step, f in enumerate(order, 1):
                lost = [(d, x) for d, x in left if f in x]
                left = [(d, x) for d, x in left if f not in x]
                fails = sum(f in x for _, x in mine)
                out.append((part, "".join(order), step, len(left), len(lost), fails - len(lost), sum(x == {f} for _, x in mine),
                            sum(d in good for d, _ in lost), sum(d in toxic for d, _ in lost), shapley[f]))
    return sorted(out, key=repr)


AUDIT = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


@pytest.fixture
def audited_rows(odd_rows):
    rng = random.Random(9)
    rows = [(d, t, rng.choice(["s", None, "", "t"])) for d, t in odd_rows]
    for k in range(300):
        text = prose(k % 150, rng.choice([10, 60, 120]))
        text += rng.choice(["", " #", " " + text, " ABCDEFGH" * 12])
        rows.append((1000 + k, text, rng.choice(["s", "t", "u"])))
    return rows + [(1000, rows[40][1], "s")] * 30 + [(None, rows[41][1], "u")] * 4


@pytest.mark.parametrize(("size", "few"), [(1 << 16, 100_000), (7, 3)])
def test_audit(spark, audited_rows, size, few):
    """With one range and all copies broadcast, with many short ranges and copies looked up by an exchange."""
    labels = [(r[0], k % 2, k % 5 == 0) for k, r in enumerate(audited_rows)] + [(None, 1, 1), (1001, 1, 1), (1001, 0, 0), (999_999, 1, 1)]
    labels = [(d, q, int(t)) for d, q, t in labels] + [(1003, None, None)]
    df = spark.createDataFrame([(*r, 1, "n") for r in audited_rows], "doc_id long, text string, source string, part int, FAILS string").repartition(6)
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    judged = filter_audit.judged(df, known, few)
    posted = filter_audit.postings(judged, size)
    assert max(len(r["ids"]) for r in posted.collect()) <= size
    want = audit_by_hand(audited_rows, labels)
    sums = {(r["part"], r["before"], r["filter"]): (r["kept"], r["removed"]) for r in filter_audit.steps(posted).collect()}
    for part, order, step, kept, removed, *_ in want:
        places = ["ABCDE".index(f) for f in order]
        assert sums[part, sum(1 << p for p in places[:step - 1]), places[step - 1]] == (kept, removed)
    if size > 7:
        assert rows_of(filter_audit.audited(df, known), *AUDIT) == want


def test_audit_of_nothing(spark, none):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audited(none.withColumn("source", F.lit("s")), labels).count() == 0


def test_lists():
    rng = np.random.default_rng(1)
    for _ in range(200):
        lists = [np.unique(rng.integers(0, 60, rng.integers(0, 40))) for _ in range(rng.integers(0, 6))]
        assert filter_audit.union(lists).tolist() == sorted(set().union(*map(set, lists)))
        if len(lists) > 1:
            assert lists[0][~filter_audit.member(lists[0], lists[1])].tolist() == sorted(set(lists[0]) - set(lists[1]))


def test_words_of_long_texts():
    text = ("ab cd\tef " * 400_000 + "x" * 3_000_000 + " end").encode()
    assert filter_audit.word_numbers(text) == (len(text.split()), len(set(text.split())))


# Conversations

def cheapest(rows):
    """(cost, audit) over all rows (role, fault) by forward sets of the cheapest and least strings per state."""
    grammar = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}

    def inserted(states):
        states = dict(states)
        for _ in range(3):
            for state, (cost, letters) in list(states.items()):
                for initial, to in grammar[state].items():
                    if initial != "s":
                        states[to] = min(states.get(to, (math.inf, "")), (cost + 5, letters + "I"))
        return states

    states = {0: (0, "")}
    for role, fault in rows:
        after = {}
        for state, (cost, letters) in inserted(states).items():
            ways = [(2, "D", state)]
            if fault not in ("blank", "duplicate"):
                more = 5 * (fault == "truncated")
                ways += [(more, "K", to) for initial, to in grammar[state].items() if initial == role]
                ways += [(1 + more, "R", to) for initial, to in grammar[state].items() if initial != "s"]
            for price, letter, to in ways:
                after[to] = min(after.get(to, (math.inf, "")), (cost + price, letters + letter))
        states = after
    ends = inserted(states)
    return min(ends[s] for s in (0, 3) if s in ends)


def repaired_by_hand(rows):
    """One conversation's sorted rows (turn, role, text) after damage."""
    seen, faults = set(), []
    for _, role, text in rows:
        bare = text.strip(SPACES)
        faults.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    initials = [role[0] for _, role, _ in rows]
    cost, audit = cheapest(list(zip(initials, faults)))
    out, at, last = [], 0, ""
    for letter in audit:
        if letter == "D":
            at += 1
            continue
        wanted = "assistant" if last == "u" else "user"
        role, text = (wanted, "") if letter == "I" else (wanted if letter == "R" else rows[at][1], rows[at][2])
        at += letter != "I"
        out.append(f"{role}:{text}")
        last = role[0]
    assert re.fullmatch("(s?(ua)+)?", "".join(x[0] for x in out))
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    return gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, "\n".join(out)


def damaged_by_hand(rows):
    out = []
    for conv_id, turn, role, text in rows:
        name = lambda v: " " if v is None else str(v)
        kind = zlib.crc32(f"{name(conv_id)}:{name(turn)}".encode()) % 20
        role, text = name(role) or " ", name(text)
        if kind:
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            out += [(conv_id, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def conversations_by_hand(rows, ids):
    held = collections.defaultdict(list)
    for conv_id, *rest in rows:
        held[conv_id].append(tuple(rest))
    order = lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode())
    return sorted(((c, *repaired_by_hand(sorted(held[c], key=order))) for c in ids), key=repr)


COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired"]


@pytest.fixture
def talks():
    rng = random.Random(3)
    rows = []
    for conv_id in [*range(150), None]:
        for turn in range(rng.choice([1, 2, 5, 9, 20])):
            role = rng.choice(["system", "user", "assistant", "user", "assistant", "tool", "", None])
            text = rng.choice(["Yes.", "no", "What? ", "Sure!\n", "", None, " \t", f"Turn {turn}.", "é…"])
            rows.append((conv_id, rng.choice([turn, turn, turn, 2 * turn, None, turn - 3, turn * 5000]), role, text))
    return rows + [(7, 1, "user", "same.")] * 30


@pytest.mark.parametrize(("block", "few"), [(64, 100_000), (3, 100_000), (5, 2)])
def test_repair(spark, talks, block, few):
    """In one block, in short blocks chained, and with repeated rows looked up by an exchange."""
    df = spark.createDataFrame([(*r, 1, "c") for r in talks], "conv_id long, turn long, role string, text string, cell int, COST string").repartition(6)
    want = conversations_by_hand(damaged_by_hand(talks), {r[0] for r in talks})
    found = conversation_repair.repaired(conversation_repair.damaged(df), df, True, block, few)
    assert rows_of(found, *COLUMNS) == want
    hashed = conversation_repair.repaired(conversation_repair.damaged(df), df, False, block, few)
    assert rows_of(hashed, "conv_id", "repaired") == sorted(((w[0], hashlib.sha256(w[-1].encode()).hexdigest()) for w in want), key=repr)


def test_repair_of_a_long_conversation(spark):
    rng = random.Random(6)
    rows = [(1, t, "user" if t % 2 == 0 else "assistant", f"Turn {t}." if rng.random() < 0.9 else "cut") for t in range(9000)]
    found = conversation_repair.repaired(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    assert rows_of(found, *COLUMNS) == conversations_by_hand(rows, {1})


def test_repair_of_nothing(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert conversation_repair.repaired(df, df).count() == 0
    dropped = next(t for t in range(10_000) if zlib.crc32(f"1:{t}".encode()) % 20 == 0)
    one = spark.createDataFrame([(1, dropped, "user", "Hi.")], "conv_id long, turn long, role string, text string")
    found = conversation_repair.repaired(conversation_repair.damaged(one), one, with_text=False).collect()
    assert [tuple(r) for r in found] == [(1, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


def test_search_finds_the_least_of_all_edits():
    """Against all strings of edits up to a length, for short conversations."""
    rng = random.Random(1)
    for _ in range(120):
        rows = [(rng.choice("suat"), rng.choice([0, 0, 0, 1, 3])) for _ in range(rng.randint(0, 3))]
        best = None
        for n in range(len(rows) + 5):
            for letters in itertools.product("DIKR", repeat=n):
                state, at, cost = 0, 0, 0
                for letter in letters:
                    new = conversation_repair.STEP[state]
                    if letter == "I":
                        state, cost = new["a" if state == 2 else "u"], cost + 5
                        continue
                    if at == len(rows):
                        break
                    initial, fault = rows[at]
                    at += 1
                    if letter == "D":
                        cost += 2
                        continue
                    if fault == 1 or letter == "K" and initial not in new:
                        break
                    cost += 5 * (fault == 3) + (letter == "R")
                    state = new[initial if letter == "K" else "a" if state == 2 else "u"]
                else:
                    if at == len(rows) and state in (0, 3):
                        best = min(best or (math.inf, ""), (cost, "".join(letters)))
        assert conversation_repair.search(tuple(rows), 0, None) == best
