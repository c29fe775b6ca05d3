"""Each operator against brute force on small odd tables: nulls, empty and long texts, ties, repeated rows, clashing names."""

import collections
import hashlib
import itertools
import math
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from conftest import prose, rows_of
from seriesmill.llm import bpe, fingerprints, lm_scoring, near_dedup, packing, pii, quality_knn, quality_rules, toxicity, warc
from seriesmill.llm.common import looked_up, pick, shared_folder

BYTE_BPE, WORD_BPE = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


# Quality rules

def measures(text):
    text = text or ""
    w = words(text)
    seen = collections.Counter(zip(w, w[1:], w[2:]))
    covered = {j for i in range(len(w) - 2) if seen[tuple(w[i:i + 3])] > 1 for j in (i, i + 1, i + 2)}
    lines, dup = set(), 0
    for line in text.split("\n"):
        if words(line):
            dup += line in lines
            lines.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered), len(w) < 50 or 100 * len(covered) > 50 * len(w)


def test_rules(odd, odd_rows):
    found = rows_of(quality_rules.judged(odd), "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert found == sorted(((d, *measures(t)) for d, t in odd_rows), key=repr)


def test_repeated_windows(spark):
    rng = random.Random(5)
    made = [(k, " ".join(rng.choices("abc", k=rng.randint(0, 12)))) for k in range(200)]
    found = quality_rules.measured(spark.createDataFrame(made, "doc_id long, text string"))
    assert rows_of(found, "doc_id", "n_repeat_words") == sorted(((d, measures(t)[4]) for d, t in made), key=repr)


def test_policies_and_ablations(odd, none):
    ledger = quality_rules.ledger(odd)
    whole = quality_rules.bits(quality_rules.POLICIES["2024-2"])
    judged = quality_rules.apply_policy(ledger, "2024-2").collect()
    assert all(r["kept"] == (r["failed_bits"] & whole == 0) for r in judged)
    for r in quality_rules.ablations(ledger, "2024-2").collect():
        bit = quality_rules.bits((r["rule"],))
        hits = [x["failed_bits"] & whole for x in judged]
        assert (r["n_fail"], r["n_only"], r["n_rejected"], r["n_rejected_without"]) == (
            sum(h & bit != 0 for h in hits), sum(h == bit for h in hits), sum(h != 0 for h in hits), sum(h & ~bit != 0 for h in hits))
    assert quality_rules.judged(none).count() == 0
    assert {r["n_fail"] for r in quality_rules.ablations(quality_rules.ledger(none)).collect()} == {0}


def test_rules_stay_native(odd):
    plan = quality_rules.judged(odd)._jdf.queryExecution().toString() + fingerprints.compared(odd)._jdf.queryExecution().toString()
    assert not re.search(r"MapInArrow|PythonUDF|ArrowEval|BatchEval|FlatMapGroups", plan)


# Near duplicates

def shingles(text, width):
    w = tuple("".join(c.lower() if "A" <= c <= "Z" else c for c in x) for x in words(text))
    return frozenset(w[i:i + width] for i in range(len(w) - width + 1)) if len(w) >= width else frozenset([w] if w else [])


def components(rows, width, percent):
    """Row by row: size, least id reachable, kept."""
    sets = [shingles(t, width) for _, t in rows]
    group = list(range(len(rows)))

    def find(x):
        while group[x] != x:
            x = group[x]
        return x

    for a, b in itertools.combinations(range(len(rows)), 2):
        x, y = sets[a], sets[b]
        if x and y and 100 * len(x & y) >= percent * len(x | y):
            group[find(a)] = find(b)
    least = {}
    for k, (d, _) in enumerate(rows):
        if d is not None:
            least[find(k)] = min(least.get(find(k), d), d)
    out = []
    for k, (d, _) in enumerate(rows):
        c = least.get(find(k)) if sets[k] else d
        out.append((d, len(sets[k]), c, d == c))
    return sorted(out, key=repr)


def test_near_dedup(odd, odd_rows, none):
    found = near_dedup.deduplicated(odd, 3, 85)
    assert rows_of(found, "doc_id", "n_shingles", "component_id", "kept") == components(odd_rows, 3, 85)
    assert near_dedup.deduplicated(none).count() == 0


@pytest.mark.parametrize(("width", "percent"), [(3, 85), (5, 80)])
def test_near_dedup_families(spark, width, percent):
    """Families around a base that is absent or present, chains, and a passage that many texts share."""
    rng = random.Random(width)
    made = []
    shared = prose(99, 60)
    for family in range(4):
        base = prose(100 + family, 150).split(" ")
        for _ in range(40):
            copy = list(base)
            for _ in range(rng.randint(0, 8)):
                copy[rng.randrange(len(copy))] = f"w{rng.randrange(10**6)}"
            made.append(" ".join(copy))
        chain = list(base)
        for _ in range(15):
            chain[rng.randrange(len(chain))] = f"c{rng.randrange(10**6)}"
            made.append(" ".join(chain))
    made += [f"{shared} {prose(1000 + k, rng.randint(3, 60))}" for k in range(60)]
    made += [f"{shared} {prose(2000 + k % 5, 6)} t{k}" for k in range(30)]
    rng.shuffle(made)
    rows = [(d * 3 + 1, t) for d, t in enumerate(made)]
    found = near_dedup.deduplicated(spark.createDataFrame(rows, "doc_id long, text string"), width, percent)
    assert rows_of(found, "doc_id", "n_shingles", "component_id", "kept") == components(rows, width, percent)


def test_texts_of_classes_leave_the_others_where_they_are(spark):
    """Only the texts of the wanted rows are moved: null and repeated doc_ids are told apart by their texts, repeated rows
    are one, and nearly all other rows are dropped before the exchange."""
    rows = [(k, f"text {k}") for k in range(3000)] + [(7, "another text"), (7, "text 7"), (None, "text 8"), (None, "no id"), (3001, None)]
    wanted = [(100 + k, d, t) for k, (d, t) in enumerate([(7, "text 7"), (None, "text 8"), (2999, "text 2999")])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    of = spark.createDataFrame([(fp, (d is None, d, near_dedup.md5(t))) for fp, d, t in wanted], "fp long, row struct<nameless: boolean, doc_id: long, t: string>")
    assert rows_of(near_dedup.texts_of(docs, of), "fp", "text") == sorted(((fp, t) for fp, _, t in wanted), key=repr)
    keyed = docs.select(F.coalesce(F.col("text"), F.lit("")).alias("key"), "doc_id")
    left = near_dedup.marked(keyed, spark.createDataFrame([(t,) for _, _, t in wanted], "key string"), "key")
    found = rows_of(left, "key", "doc_id")
    assert left.columns == ["key", "doc_id"] and len(found) < 10
    assert {x for x in found if x[0] == "text 7"} == {("text 7", 7)} and sum(x[0] == "text 7" for x in found) == 2


def test_a_value_of_most_sets_fills_no_task(spark, monkeypatch):
    """One shingle in all sets: its sets get its count by broadcast, with the same prefixes as by an exchange."""
    rows = [(bytes([k % 256, k // 256]), 3, 3, x) for k in range(600) for x in (1, 1000 + k // 2, 5000 + k // 3)]
    values = spark.createDataFrame(rows, "fp binary, n long, size int, x long").repartition(4)
    found = []
    for few in (100_000, 1):
        monkeypatch.setattr(near_dedup, "looked_up", lambda *a, few=few: looked_up(*a, few))
        found.append(rows_of(near_dedup.rarest(values, F.lit(2)), "x", "df", "at", "score"))
    assert found[0] == found[1] and {r[1] for r in found[0]} == {2, 3}  # the common value is in no prefix


def test_sketches_sort_as_hashes(spark):
    """Sets of 65 to 160 shingles, whose sketches reach beyond 2^63: Spark's least values of a union are its least hashes."""
    texts = [prose(3000 + n, n + 4) for n in range(65, 161, 5)]
    texts += [" ".join(t.split(" ")[:-(len(t.split(" ")) - 4) // 5]) for t in texts]
    sets = near_dedup.shingle_sets(texts, 5)
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = near_dedup.sketched(rows, 5).select("doc_id", F.col("sketch").alias("s"))
    half = len(texts) // 2
    other = found.select((F.col("doc_id") - half).alias("doc_id"), F.col("s").alias("t"))
    union = F.slice(F.array_sort(F.array_union("s", "t")), 1, near_dedup.K)
    for r in found.join(other, "doc_id").select("doc_id", union.alias("u")).collect():
        want = np.union1d(sets[r["doc_id"]], sets[r["doc_id"] + half])[:near_dedup.K]
        assert [(x + (1 << 63)) for x in r["u"]] == want.tolist()
    assert any((s[:near_dedup.K] >> np.uint64(63)).any() for s in sets)


def test_blocks_of_a_long_list(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", 3)
    counts = np.array([20, *[0] * 255], np.uint16).tobytes()
    rows = [(7, 10, f"{k:02d}".encode(), 20, f"{k % 4}".encode(), 0, b"" if k == 3 else counts) for k in range(10)]
    found = near_dedup.blocks(spark.createDataFrame(rows, "x long, df long, fp binary, n long, label binary, at long, counts binary"), 80)
    want = {(f"{a:02d}", f"{b:02d}") for a, b in itertools.combinations(range(10), 2) if a % 4 != b % 4}
    assert {(bytes(r["a"]).decode(), bytes(r["b"]).decode()) for r in found.collect()} == want


def test_components_of_chains_and_stars(spark):
    edges = [(f"{k:03d}", f"{k + 1:03d}") for k in range(40)] + [("500", f"6{k:02d}") for k in range(20)] + [("900", "900")]
    found = near_dedup.connected(spark.createDataFrame([(a.encode(), b.encode()) for a, b in edges], "a binary, b binary"))
    assert {bytes(r["node"]).decode(): bytes(r["label"]).decode() for r in found.collect()} == {
        **{f"{k:03d}": "000" for k in range(41)}, "500": "500", **{f"6{k:02d}": "500" for k in range(20)}}


# Language model

def test_lm(odd, odd_rows, none):
    tokens = [(d, (t or "").encode().lower().split() + [b"\n"]) for d, t in odd_rows]
    held = lambda d: d is not None and zlib.crc32(str(d).encode()) % 7 == 2
    counts = collections.Counter(x for d, ts in tokens if not held(d) for x in ts)
    total, distinct = sum(counts.values()), len(counts)
    p = lambda x: math.log10((counts[x] + 1) / (total + distinct + 1))
    want = sorted(((d, held(d), len(ts), sum(counts[x] > 0 for x in ts), total, round(sum(map(p, ts)), 4)) for d, ts in tokens), key=repr)
    found = lm_scoring.scored(odd).withColumn("base", F.round("base_score", 4))
    assert rows_of(found, "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base") == want
    assert lm_scoring.scored(none).count() == 0


def test_automaton_sums_to_one():
    words_ = [(b"\n", 5), (b"a", 40), (b"b", 30), (b"c", 3)]
    pairs = [(1 << 32 | 2, 20), (1 << 32 | 1, 4), (4 << 32 | 1, 4), (2 << 32 | 0, 5)]
    model = lm_scoring.Automaton.build(words_, pairs, 5, 100, 10)
    counts = np.array([5, 40, 30, 3, *[4] * 5, 2, 0])  # ten known words, and one for all unknown
    unigram, number = model.unigram(counts), np.array([0, 1, 2, 3, *[-1] * 7])
    for state in (-1, 1, 2, 3, 4):
        assert math.isclose(sum(10 ** model.traverse(np.full(11, state), number, unigram)), 1, rel_tol=1e-9)


def test_lm_beats_single_words(spark):
    rng = random.Random(2)
    rows = [(k, " ".join(f"a{x} b{x}" for x in rng.choices(range(30), k=40))) for k in range(200)]
    held = lm_scoring.scored(spark.createDataFrame(rows, "doc_id long, text string")).where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert held[0] > 0.8 * held[1]


@pytest.mark.parametrize("part", [12 << 20, 1 << 18])
def test_lm_keeps_rare_pairs_of_a_large_corpus(spark, monkeypatch, part):
    """Scores by all pairs seen twice, among more than a million tokens and with words of any length, in several buckets."""
    monkeypatch.setattr(lm_scoring, "BUCKET_BYTES", 1 << 18)
    monkeypatch.setattr(lm_scoring, "PART_BYTES", part, raising=False)
    rng = random.Random(7)
    rows = [(k, "x " * 30_000) for k in range(50)]
    rows += [(100 + k, " ".join(f"a{x} b{x} {'long' * 20}{x}" for x in rng.choices(range(60), k=3))) for k in range(60)]
    tokens = [(d, t.encode().split() + [b"\n"]) for d, t in rows]
    trained = [ts for d, ts in tokens if zlib.crc32(str(d).encode()) % 7 != 2]
    counts = collections.Counter(x for ts in trained for x in ts)
    pairs = {p: n for p, n in collections.Counter(p for ts in trained for p in zip([None, *ts], ts)).items() if n >= 2}
    total, distinct = sum(counts.values()), len(counts)
    assert total > 1_000_000
    counts[None] = len(trained)
    rest = collections.defaultdict(lambda: 1.0)
    for (a, _), n in pairs.items():
        rest[a] -= (n - lm_scoring.DISCOUNT) / counts[a]
    single = lambda x: (counts[x] + 1) / (total + distinct + 1)
    arc = lambda a, b: ((pairs[a, b] - lm_scoring.DISCOUNT) / counts[a] if (a, b) in pairs else 0) + rest[a] * single(b)
    want = {d: sum(math.log10(arc(a, b)) for a, b in zip([None, *ts], ts)) for d, ts in tokens}
    found = {r["doc_id"]: r["score"] for r in lm_scoring.scored(spark.createDataFrame(rows, "doc_id long, text string").coalesce(2)).collect()}
    assert found == pytest.approx(want, rel=1e-6)


# Toxicity

def test_toxicity(spark, odd, none):
    rng = random.Random(3)
    rows, labels = [], []
    for k in range(600):
        toxic = k % 6 == 0
        ws = prose(k, 80).split(" ")
        for _ in range(rng.randint(1, 6) if toxic else 0):
            ws[rng.randrange(80)] = rng.choice(["idiot", "moron", "loweisch", "loweint", "loweiend"])
        rows.append((k, " ".join(ws)))
        labels.append((k, int(toxic)))
    docs, marks = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    found = toxicity.scored(docs, marks).join(marks, "doc_id").where("held_out").collect()
    assert sum(r["predicted"] == r["toxic"] for r in found) >= 0.97 * len(found)
    assert np.mean([r["severity"] for r in found if r["toxic"]]) > 1 > np.mean([r["severity"] for r in found if not r["toxic"]])
    assert toxicity.scored(none, marks).count() == 0
    assert {r["predicted"] for r in toxicity.scored(odd, marks.limit(0)).collect()} == {0}
    assert toxicity.scored(odd, marks).count() == odd.count()


def test_expected_severity_by_definition():
    """A fitted model's severity is the sum of grade times probability, and its bounds and weights are where the penalised
    likelihood, written out by itself, has no slope."""
    rng = np.random.default_rng(2)
    x = rng.poisson(1.0, (300, 2)).astype(float)
    grades = np.clip(np.round(x @ [1.0, 0.4] + rng.normal(0, 0.8, 300)).astype(int), 0, toxicity.GRADES - 1)
    rows = [dict(enumerate(r)) for r in x.tolist()]
    model = toxicity.Ordinal.fit({"a": 0, "b": 1}, rows, grades, rounds=3000, rate=0.02)
    above = model.above(rows)
    full = np.hstack([np.ones((300, 1)), above, np.zeros((300, 1))])
    share = full[:, :-1] - full[:, 1:]
    assert np.allclose(share.sum(1), 1) and np.allclose(share @ np.arange(toxicity.GRADES), above.sum(1))

    def likelihood(p):
        up = 1 / (1 + np.exp(-((x @ p[:2])[:, None] - p[2:])))
        edges = np.hstack([np.ones((300, 1)), up, np.zeros((300, 1))])
        return (np.log(edges[np.arange(300), grades] - edges[np.arange(300), grades + 1]).sum() - 0.01 * (p[:2] ** 2).sum() / 2) / 300

    found = np.concatenate([model.weights, model.bounds])
    slopes = [(likelihood(found + e) - likelihood(found - e)) / 2e-5 for e in 1e-5 * np.eye(len(found))]
    assert np.abs(slopes).max() < 2e-3


def test_ordinal_thresholds_rise():
    rng = np.random.default_rng(1)
    x = rng.poisson(1.5, (400, 2))
    grades = np.minimum(x[:, 0], 3)
    model = toxicity.Ordinal.fit({"a": 0, "b": 1}, [{0: float(a), 1: float(b)} for a, b in x], grades)
    assert (np.diff(model.bounds) > 0).all() and model.weights[0] > 5 * model.weights[1]
    assert ((model.above([{0: float(a), 1: float(b)} for a, b in x]) >= 0.5).sum(1) == grades).mean() > 0.9


# Fingerprints

def test_fingerprints(odd, odd_rows, none):
    """Edited texts row by row; equal ids in the order of their texts, null ids last."""
    rows = sorted(((d, t or "") for d, t in odd_rows), key=lambda r: (r[0] is None, -(r[0] or 0), r[1].encode()))
    want = []
    for k, (d, t) in enumerate(rows):
        after, half = rows[(k + 1) % len(rows)][1], len(t) // 2
        want.append((d, len(t), hashlib.sha256((t[:len(t) - half] + after[:half]).encode()).hexdigest()))
    found = fingerprints.compared(odd)
    assert rows_of(found, "doc_id", "n_chars", "edited_sha256") == sorted(want, key=repr)
    assert found.where("near_edited < 0 OR near_edited > 1 OR near_next IS NULL").count() == 0
    assert fingerprints.compared(none).count() == 0
    by_text = collections.defaultdict(set)
    for r in fingerprints.fingerprinted(odd).join(pick(odd, "doc_id", "text"), "doc_id").where("doc_id <> 8").collect():
        by_text[r["text"]].add(r["fingerprint"])
    assert all(len(x) == 1 for x in by_text.values())


def test_fingerprints_see_order(spark):
    """The same windows in another order are unlike; a small edit leaves most bins."""
    ws = prose(4, 400).split(" ")
    edited = [*ws[:200], "changed", *ws[201:]]
    parts = [ws[k:k + 10] for k in range(0, 400, 10)]
    random.Random(1).shuffle(parts)
    rows = [(0, " ".join(ws)), (1, " ".join(edited)), (2, " ".join(itertools.chain(*parts)))]
    sketches = spark.createDataFrame(rows, "doc_id long, text string").select("doc_id", fingerprints.sketch(F.col("text")).alias("s"))
    a, b, c = (sketches.where(f"doc_id = {k}").select(F.col("s").alias(f"s{k}")) for k in range(3))
    like = a.join(b).join(c).select(fingerprints.likeness(F.col("s0"), F.col("s1")), fingerprints.likeness(F.col("s0"), F.col("s2"))).first()
    assert like[0] > 0.8 > like[1] + 0.1


# BPE and packing

SPECIAL = ["  double  spaces ", "a <|endoftext|> b", "tab\t\nline\r\n", "éÅÅİΣ", "12²٣ don't WE'LL", "中文\U0001f642\U0001f642",
           "\x00\x1c\x85\xa0　x", "a   \n\n  b"]


def test_bpe(spark, odd, odd_rows, none):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(BYTE_BPE)
    more = spark.createDataFrame([(100 + k, t) for k, t in enumerate(SPECIAL)], "doc_id long, text string")
    found = bpe.coded(pick(odd, "doc_id", "text").unionByName(more), BYTE_BPE).collect()
    want = [(d, t or "") for d, t in odd_rows] + [(100 + k, t) for k, t in enumerate(SPECIAL)]
    ids = {t: library.encode(t, add_special_tokens=False).ids for _, t in want}
    assert sorted(((r["doc_id"], np.frombuffer(r["ids"], "<u4").tolist(), r["n_tokens"], r["decoded"]) for r in found), key=repr) == sorted(
        ((d, ids[t], len(ids[t]), library.decode(ids[t], skip_special_tokens=False)) for d, t in want), key=repr)
    assert bpe.coded(none, BYTE_BPE).count() == 0


def test_bpe_runs_of_one_symbol():
    own = bpe.codec(BYTE_BPE)
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(BYTE_BPE)
    for n in range(1, 70):
        assert np.frombuffer(next(own.encode(["-" * n])), "<u4").tolist() == library.encode("-" * n).ids


def test_packing(spark, odd, odd_rows, none):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(WORD_BPE)
    more = spark.createDataFrame([(100 + k, t) for k, t in enumerate(SPECIAL)], "doc_id long, text string")
    found = packing.packed(pick(odd, "doc_id", "text").unionByName(more), WORD_BPE, with_ids=True).collect()
    want = [(d, t or "") for d, t in odd_rows] + [(100 + k, t) for k, t in enumerate(SPECIAL)]
    ids = sorted((repr(d), [*library.encode(t, add_special_tokens=False).ids, 1]) for d, t in want)
    pieces = collections.defaultdict(list)
    for r in found:
        own = np.frombuffer(r["ids"], "<u4")
        assert len(own) == r["length"] and zlib.crc32(own.tobytes()) == r["ids_crc32"]
        pieces[repr(r["doc_id"])].append((r["start"], own.tolist(), r["doc_tokens"]))
    assert sorted(x for d, known in ids for x in known) == sorted(x for ps in pieces.values() for _, own, _ in ps for x in own)
    for d, known in ids:
        if [x for x, _ in ids].count(d) == 1:
            assert [x for _, own, _ in sorted(pieces[d]) for x in own] == known and pieces[d][0][2] == len(known)
    sequences = collections.defaultdict(list)
    for r in found:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in sequences.values():
        assert [o for o, _ in sorted(parts)] == list(itertools.accumulate((n for _, n in sorted(parts)), initial=0))[:-1]
        assert sum(n for _, n in parts) <= packing.WINDOW
    assert packing.packed(none, WORD_BPE).count() == 0


def test_best_fit_is_best_fit():
    rng = np.random.default_rng(4)
    for window in (7, 100, 2048):
        lengths = rng.integers(1, window + 1, 300)
        names, offsets, made = packing.best_fit(lengths, window)
        room: list[int] = []
        for k in sorted(range(300), key=lambda k: -lengths[k]):
            fits = [(r, w) for w, r in enumerate(room) if r >= lengths[k]]
            if fits:
                assert room[names[k]] == min(fits)[0]
            else:
                assert names[k] == len(room)
                room.append(window)
            assert offsets[k] == window - room[names[k]]
            room[names[k]] -= lengths[k]
        assert made == len(room)


class Caught:
    """Takes the function that an operator hands to its tasks."""

    columns = ["doc_id", "text"]

    def toDF(self, *names):
        return self

    def select(self, *columns):
        return self

    def groupBy(self, *columns):
        return self

    def mapInArrow(self, run, schema):
        self.run = run
        return self

    applyInArrow = mapInArrow


def test_packing_holds_little(monkeypatch, spark):
    task = type("Task", (), {"get": staticmethod(lambda: type("Context", (), {"partitionId": lambda self: 3})())})
    monkeypatch.setattr(packing, "TaskContext", task)
    monkeypatch.setattr(packing, "REMEMBERED", 1000)
    own = packing.word_ids(WORD_BPE)
    texts = ["1" * 2_100_000, *(" ".join(f"w{k}x{j}" for j in range(400)) for k in range(20)), *(" ".join(f"é{k}x{j}" for j in range(400)) for k in range(20))]
    caught = Caught()
    packing.packed(caught, WORD_BPE, with_ids=True)
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts)], ["doc_id", "text"])
    out = list(caught.run([batch]))
    assert max(b.nbytes for b in out) < 3_000_000  # handed on in small batches, whole windows too
    assert len(own.known) <= 1500 and len(own.pieces) <= 1500
    ids = {}
    for b in out:
        for row in b.to_pylist():
            ids.setdefault(row["doc_id"], []).append((row["start"], row["ids"]))
    for k, text in enumerate(texts):
        want = own.tokenizer.encode(text, add_special_tokens=False).ids if k else own.tokenizer.encode("1", add_special_tokens=False).ids * len(text)
        assert b"".join(x for _, x in sorted(ids[k])) == np.array([*want, packing.END], "<u4").tobytes()


def test_packing_cuts_whole_texts_of_all_scripts(monkeypatch):
    """Texts of characters that Python classes as the tokenizer does are not cut word by word; all others still are. The ids
    are those of the tokenizer either way, and also where pieces are forgotten and come back."""
    from tokenizers import Tokenizer

    monkeypatch.setattr(packing, "REMEMBERED", 50)
    own = packing.WordIds(WORD_BPE)
    lines = ["Übergröße naïve Œuvre, l'été n'est-ce pas? 12 ½", "ΟΔΟΣ Σίσυφος ΣΑΣ", "Съешь ещё этих мягких булок 42", "東京都は 日本の首都。", "a\xa0b\u2003c\u2028d é"]
    plain = [x for x in lines if "½" not in x] + ["é'S _x_ “quoted” — 😀😀"]
    odd = [lines[0], "e\u0301te", "a\x1cb é", "İstanbul ²x x² ⅷ", "\u1112\u1161\u11ab", "K (\u212a)", "é<|endoftext|>é", "\u0378é"]
    rng = random.Random(5)
    pool = [c for c in map(chr, range(1, 0x3000)) if c.isprintable() or c.isspace()] + list("THE'S é ß Σ ") * 150
    mixed = ["".join(rng.choices(pool, k=rng.randint(1, 60))) for _ in range(500)]
    want = Tokenizer.from_file(WORD_BPE)
    for texts in (plain, odd, mixed, plain):
        for text, ids in zip(texts, own.encode(texts)):
            assert ids == np.array(want.encode(text, add_special_tokens=False).ids, "<u4").tobytes(), text
    fresh = packing.WordIds(WORD_BPE)
    list(fresh.encode(plain))
    assert fresh.pieces and not fresh.known


def test_packing_of_plain_and_odd_ascii():
    own = packing.word_ids(WORD_BPE)
    odd = ["Don't we'LL I'D\tgo\x0b12ab\r\n!!a,b", "a\x1cb c\x00d \x7f", "x<|endoftext|>y <|startoftext|>", "", " \n ", "é Don't A1"]
    assert [np.frombuffer(x, "<u4").tolist() for x in own.encode(odd)] == [own.tokenizer.encode(t, add_special_tokens=False).ids for t in odd]


def test_pairs_are_counted_one_row_at_a_time():
    """What a part's count holds at once stays a small multiple of its pairs, and the counts are right."""
    import tracemalloc

    n, rng = 20_000, np.random.default_rng(3)
    rows, want = [], collections.Counter()
    for bucket in range(20):
        pair = np.unique(rng.integers(0, 400, (n, 2)), axis=0)
        counts = rng.integers(0, 3, len(pair))
        rows.append((0, bucket, lm_scoring.pressed(pair[:, 0].copy()), pair[:, 1].tobytes(), lm_scoring.pressed(counts)))
        for p, c in zip(map(tuple, pair.tolist()), counts.tolist()):
            want[p] += c
    names = ["part", "bucket", "lefts", "rights", "counts"]
    table = pa.table({name: pa.array(c, pa.int64() if k < 2 else pa.binary()) for k, (name, c) in enumerate(zip(names, zip(*rows)))})
    caught = Caught()
    lm_scoring.counted_pairs(caught)
    tracemalloc.start()
    found = caught.run(table)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    pairs = sum(len(r[3]) // 8 for r in rows)
    assert most < 8 * 8 * pairs
    for (_, bucket, left, right, _), row in zip(rows, found.to_pylist()):
        keys = zip(np.frombuffer(lm_scoring.opened(left), np.int64).tolist(), np.frombuffer(right, np.int64).tolist())
        assert row["bucket"] == bucket and np.frombuffer(lm_scoring.opened(row["counts"]), np.int64).tolist() == [want[k] for k in keys]
    mass = collections.Counter()
    for (x, _), c in want.items():
        mass[x] += (c - lm_scoring.DISCOUNT) * (c >= lm_scoring.LEAST)
    assert {r["key"]: pytest.approx(r["mass"]) for r in found.to_pylist() if r["key"] is not None} == {x: m for x, m in mass.items() if m}


# WARC

@pytest.fixture
def pages(spark):
    rows = [(5, "http://a/x y%", "same"), (3, "http://b/", "same"), (9, None, "same"), (4, "u", ""), (1, "u", None), (7, "u", "é" * 100_000),
            (8, "u", "é" * 100_000), (2, "u\r\nX: 1", "0\r\n\r\nWARC/1.1\r\n"), (None, "u", "same"), (6, "u", prose(1, 60_000)), (6, "u", prose(1, 60_000))]
    return rows, spark.createDataFrame([(*r, "z") for r in rows], "page_id long, url string, html string, HTML string").repartition(3)


@pytest.mark.parametrize("least", [0, 1])
def test_warc(pages, least):
    rows, df = pages
    first = {}
    for p, _, h in rows:
        if p is not None and len((h or "").encode()) >= least:
            first[h or ""] = min(first.get(h or "", p), p)
    want = []
    for p, u, h in rows:
        origin = first.get(h or "")
        revisit = p is not None and origin is not None and p > origin
        want.append((p, u, len((h or "").encode()), warc.digest((h or "").encode()), "revisit" if revisit else "response",
                     origin if revisit else None, None if revisit else (h or "").encode()))
    found = warc.read_archives(warc.write_archives(df, shared_folder(df.sparkSession), least))
    got = [(r["page_id"], r["url"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"],
            None if r["payload"] is None else bytes(r["payload"])) for r in found.collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_warc_without_pages(spark):
    assert warc.archived(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_archives_are_read_in_parallel(spark):
    files = spark.createDataFrame([(f"file:///nowhere/{k}.warc.gz",) for k in range(9)], "path string").coalesce(1)
    assert "RoundRobinPartitioning(9)" in warc.read_archives(files)._jdf.queryExecution().toString()


def test_warc_missing_segment(spark, tmp_path):
    parts = warc.record(1, "u", b"x" * 300_000, None)
    (tmp_path / "a.warc.gz").write_bytes(b"".join(parts[:2] + parts[3:]))
    files = spark.createDataFrame([(f"file://{tmp_path}/a.warc.gz",)], "path string")
    with pytest.raises(Exception, match="segments of .* are missing"):
        warc.read_archives(files).collect()


# Quality by neighbours

def test_quality(spark, odd, none):
    rows, labels = [], []
    for k in range(400):
        good = k % 3 != 0
        text = prose(k, 90).capitalize() + "."
        rows.append((k, text if good else [text.upper().replace(" ", "!! "), text.replace(" ", "&&& "), " | ".join(text.split())][k // 3 % 3]))
        labels.append((k, int(good)))
    docs, marks = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int")
    found = quality_knn.scored(docs, marks).join(marks, "doc_id").where("held_out").collect()
    assert sum(r["predicted"] == r["quality"] for r in found) >= 0.97 * len(found) and all(0 <= r["score"] <= 1 for r in found)
    # Labels of held-out documents change nothing.
    turned = marks.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    assert rows_of(quality_knn.scored(docs, turned), "doc_id", "score") == rows_of(quality_knn.scored(docs, marks), "doc_id", "score")
    assert quality_knn.scored(none, marks).count() == 0
    assert {r["score"] for r in quality_knn.scored(odd, marks.limit(0)).select(F.col("score")).collect()} == {0.5}
    assert quality_knn.scored(odd, marks, keep=["sketch"]).count() == odd.count()


def quality_by_hand(train, labels, texts, axes):
    """Scores from terms counted in plain Python, dense vectors and all cosines, with the given latent axes."""
    kind = {}
    for k, characters in enumerate(quality_knn.CLASSES[:-1]):
        kind |= {b: k for b in characters.encode()}
    kind |= {b: 0 for b in range(128, 256)}
    n, last = len(quality_knn.CLASSES), len(quality_knn.CLASSES) - 1

    def counts(text):
        raw = text.encode()
        codes = [kind.get(b, last) for b in raw]
        out = np.zeros(quality_knn.PATTERNS + quality_knn.WORDS)
        for a, b, c in zip(codes, codes[1:], codes[2:]):
            out[(a * n + b) * n + c] += 1
        found = raw.split()
        same = [a == b for a, b in zip(found, found[1:])]
        both = sum(a and b for a, b in zip(same, same[1:]))
        out[quality_knn.PATTERNS - 4:quality_knn.PATTERNS] = both, sum(same), len(same) - sum(same), bool(found)
        for word in found:
            out[quality_knn.PATTERNS + int(near_dedup.word_hashes([word.decode()])[0][0]) % quality_knn.WORDS] += 1
        return out

    known, asked = np.array([counts(t) for t in train]), np.array([counts(t) for t in texts])
    weights = np.log((1 + len(train)) / (1 + (known > 0).sum(0))) + 1

    def vectors(c):
        p, w = c[:, :quality_knn.PATTERNS], c[:, quality_knn.PATTERNS:]
        p = np.sqrt(p / np.maximum(p.sum(1, keepdims=True), 1)) * weights[:quality_knn.PATTERNS]
        w = np.where(w > 0, 1 + np.log(np.maximum(w, 1)), 0) * weights[quality_knn.PATTERNS:]
        unit = lambda x: x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)
        whole = np.hstack([unit(p), quality_knn.WORD_SHARE * unit(w)])
        return unit(whole @ axes), whole

    out, (mine, whole) = [], vectors(known)
    for v in vectors(asked)[0]:
        cosines = sorted(((float(v @ m), label) for m, label in zip(mine, labels)), reverse=True)[:quality_knn.NEIGHBOURS]
        votes = [(max(c, 0) ** quality_knn.SHARPNESS, label) for c, label in cosines]
        total = sum(w for w, _ in votes)
        out.append(sum(w * label for w, label in votes) / total if total > 1e-9 else sum(labels) / len(labels))
    return out, whole


def test_quality_against_brute_force():
    rng = random.Random(2)
    train = [prose(k, rng.randint(5, 80)) + rng.choice(["", " &&& " * 9, "!!"]) for k in range(120)]
    labels = [int("&" not in t) if k % 9 else 0 for k, t in enumerate(train)]
    texts = [prose(500 + k, 40) + " &&" * (k % 4) for k in range(40)] + ["", " ", "one", train[3]]
    counts = quality_knn.joined([quality_knn.term_counts(train[:50]), quality_knn.term_counts(train[50:])])
    space = quality_knn.Space.fit(counts, np.array(labels, float))
    want, whole = quality_by_hand(train, labels, texts, space.axes.astype(float))
    assert np.allclose(space.scores(texts), want, atol=2e-3)
    # The axes hold nearly as much of the vectors as the best ones do.
    best = np.linalg.svd(whole, compute_uv=False)[:quality_knn.DIMENSIONS]
    assert (np.linalg.norm(whole @ space.axes) ** 2) > 0.97 * (best ** 2).sum()


def test_quality_hears_words():
    """Texts of one pattern of letters and spaces, told apart by their words alone."""
    rng = random.Random(5)
    make = lambda letters: ["".join(rng.choices(letters, k=5)) for _ in range(60)]
    good, bad = make("abcdefghijkl"), make("mnopqrstuvwx")
    text = lambda words: " ".join(rng.choices(words, k=50))
    train = [text(good if k % 2 else bad) for k in range(200)]
    space = quality_knn.Space.fit(quality_knn.term_counts(train), np.arange(200) % 2.0)
    patterns = quality_knn.term_counts([text(good), text(bad)]).patterns
    assert (patterns[0][:-4] == patterns[1][:-4]).all()
    assert space.scores([text(good) for _ in range(20)]).min() > 0.9 and space.scores([text(bad) for _ in range(20)]).max() < 0.1


def test_patterns_of_long_texts(monkeypatch):
    text = "".join(random.Random(1).choices("ab C.\n9#é", k=5000)).encode()
    whole = quality_knn.pattern_counts(text)
    monkeypatch.setattr(quality_knn, "PART_BYTES", 7)
    assert (quality_knn.pattern_counts(text) == whole).all()


# Personal data

def expressions(text):
    out = []
    for k, pattern in enumerate([r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
                                 r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"]):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            fits = [True, k != 1 or all(int(x) <= 255 for x in m.group().split(".")), 12 <= len(digits) <= 19 and pii.luhn(digits), 9 <= len(digits) <= 15][k]
            if fits:
                out.append((m.start(), k, m.end()))
    return sorted(out)


def test_expressions():
    rng = random.Random(3)
    parts = ["a", "B", "@", "@", ".", " ", "-", "+", "1", "2", "55", "4918187128635271", "0", "(", ")", "10.0.0.1", "%", "_", "é", "\n"]
    for _ in range(20_000):
        text = "".join(rng.choices(parts, k=rng.randint(0, 18)))
        assert pii.base_spans(text) == expressions(text), text


def test_pii(odd, odd_rows, none):
    found = pii.detected(odd, with_redacted=True)
    want = []
    for d, t in odd_rows:
        spans = expressions(t or "")
        want.append((d, *(sum(s[1] == k for s in spans) for k in range(4)), hashlib.sha256(pii.joined(spans).encode()).hexdigest()))
    assert rows_of(found, "doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256") == sorted(want, key=repr)
    assert {r["redacted"] is None for r in found.where("doc_id = 2").collect()} == {True}
    assert "[EMAIL] or [PHONE]" in found.where("doc_id = 9").first()["redacted"]
    assert pii.detected(none).count() == 0


def test_field_adds_spans():
    field = pii.trained()
    cases = {"ring (415) 555-0177 now": "phone:5:19", "mail bob@localhost today": "email:5:18", "pay 4918.1871.2863.5271 now": "card:4:23",
             "license version 2.0 of 2019": "", "on 2021-05-04 at 10:30": "", "order 123456789 came": "",
             "+1 (269) 555-3296 4918187128635271": "phone:0:17,card:18:34"}
    assert {t: pii.joined(pii.all_spans([t], field)[0][1]) for t in cases} == cases


def test_field_reads_all_words():
    """Words without digit or @ inside of personal data, words around it, and words of any length."""
    field = pii.trained()
    cases = {"call 555 - 867 - 5309 today": "phone:5:21", "phone +49 30 / 901820 at noon": "phone:6:21",
             "mail j.doe (at) example.com about it": "email:5:27", "mail bob @ host.net today": "email:5:19",
             "we met (at) noon": "", "the years 1914 - 1918 were hard": ""}
    assert {t: pii.joined(pii.all_spans([t], field)[0][1]) for t in cases} == cases
    assert pii.features(["1" * 70]) != pii.features(["1" * 64])
    assert max(len(words) for words, _ in pii.labelled_table()) > 8


def test_viterbi_is_best():
    """Against all paths of short runs."""
    field = pii.trained()
    runs = [["+1", "(578)", "555-6437"], ["2.0."], ["a@b.c", "10.0.0.1"]]
    for run, path in zip(runs, field.decode(runs)):
        scores = np.array([sum(field.emit[field.index[f]] for f in word if f in field.index) for word in pii.features(run)])
        value = lambda p: field.first[p[0]] + sum(scores[k, x] for k, x in enumerate(p)) + sum(field.step[x, y] for x, y in zip(p, p[1:]))
        best = max(itertools.product(range(len(pii.LABELS)), repeat=len(run)), key=value)
        assert math.isclose(value(best), value(path))


def test_shapes_are_found_for_all_words_at_once(monkeypatch):
    calls = []

    class Counted:
        def __init__(self, run):
            self.run = run

        def sub(self, *args):
            calls.append(1)
            return self.run.sub(*args)

    field = pii.trained()
    texts = [prose(k, 300) + f" Call +1 (578) 555-64{k:02} x\x1cé\u2028y A1b--Ü9 mail a.b{k}@mail.example.com" for k in range(20)]
    one_by_one = [pii.all_spans([t], field)[0] for t in texts]
    monkeypatch.setattr(pii, "RUNS", tuple((Counted(run), mark) for run, mark in pii.RUNS))
    assert pii.all_spans(texts, field) == one_by_one
    assert len(calls) <= 10
    run = [w for t in texts for w in pii.WORD.findall(t)]
    monkeypatch.undo()
    scores = field.scores(run, np.array([0]))
    want = np.array([sum(field.emit[field.index[f]] for f in word if f in field.index) for word in pii.features(run)])
    assert np.allclose(scores, want, atol=1e-4)
