"""The pipeline's stages on a made corpus, each held against brute force on its own input."""

import random

import pytest

from conftest import prose

corpus_pipeline = pytest.importorskip("corpus_pipeline")


@pytest.fixture
def corpus(spark, tmp_path):
    rng = random.Random(8)
    rows, labels = [], []
    for k in range(150):
        text = prose(k, 120).capitalize() + "."
        if k % 10 == 0:
            text = text.upper().replace(" ", "!! ")
        if k % 10 == 5:
            text = prose(5, 120).capitalize() + f" extra{k}."
        if k % 7 == 1:
            text += " write to jane.doe@mail.example.com"
        if k % 30 == 2:
            text = "too short"
        rows.append((k, text, "en", "s", len(text)))
        labels.append((k, int(k % 10 != 0), 0))
    rng.shuffle(rows)
    rows += [(500, None, None, None, None), (None, prose(900, 80), "en", None, 1)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    return str(tmp_path)


def test_stages(spark, corpus):
    docs = spark.read.parquet(f"{corpus}/documents.parquet")
    ids = lambda df: sorted(-1 if r["doc_id"] is None else r["doc_id"] for r in df.select("doc_id").distinct().collect())
    before, kept = ids(docs), {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, corpus).collect(), docs.schema)
        assert docs.columns == corpus_pipeline.COLUMNS
        kept[name] = ids(docs)
    assert kept["quality classifier"] == [d for d in before if d < 0 or d % 10 != 0 or d == 500]
    assert kept["quality rules"] == [d for d in kept["quality classifier"] if d != 500 and (d < 0 or d % 30 != 2)]
    copies = [d for d in kept["quality rules"] if d >= 0 and d % 10 == 5]
    assert kept["near-dedup"] == [d for d in kept["quality rules"] if d not in copies[1:]]
    assert kept["PII"] == kept["near-dedup"]
    assert not [r for r in docs.collect() if "@" in r["text"]] and [r for r in docs.collect() if "[EMAIL]" in r["text"]]
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, corpus)
    assert ids(packed) == kept["PII"]


def test_run_gives_rows(spark, corpus):
    assert corpus_pipeline.run(spark, corpus).count() > 0


def test_last_stage_gives_token_ids(spark, corpus):
    docs = spark.createDataFrame([(1, prose(1, 80), "en", "s", 1)], "doc_id long, text string, lang string, source string, n_chars long")
    rows = corpus_pipeline.STAGES[-1][1](spark, docs, corpus).collect()
    assert rows and all(r["ids"] for r in rows)


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def by_stage(spark, folder, rows, schema=SCHEMA):
    docs = spark.createDataFrame(rows, schema)
    return {name: stage(spark, docs, folder) for name, stage in corpus_pipeline.STAGES}


def test_dedup_tells_rows_apart_by_id_and_text(spark, corpus):
    a, b, c = (prose(k, 60) for k in (61, 62, 63))
    rows = [(3, a), (7, a), (7, b), (9, c), (9, c), (None, a), (None, a)]
    docs = spark.createDataFrame([(d, t, "en", "s", 1) for d, t in rows], SCHEMA)
    found = corpus_pipeline.dedup(spark, docs, corpus)
    assert sorted((r["doc_id"], r["text"]) for r in found.collect()) == [(3, a), (7, b), (9, c)]


def test_dedup_of_odd_rows(spark, corpus):
    """Rows without id, ids with several texts that are near copies of each other, texts without words, differing columns."""
    base = prose(64, 80)
    near, other = base + " more", prose(65, 80)
    rows = [(None, other, "a", None, 1), (None, other, "b", None, 1), (5, base, "en", "z", 1), (5, near, "en", "s", 1), (5, base, "de", "s", 1),
            (6, None, "en", "s", 1), (6, None, "en", "s", 1), (7, "", "en", "s", 1), (8, " ", "en", "s", 1)]
    found = corpus_pipeline.dedup(spark, spark.createDataFrame(rows, SCHEMA), corpus).collect()
    kept = {tuple(r) for r in found}
    first = min((base, near), key=lambda t: __import__("hashlib").md5(t.encode()).hexdigest())
    assert len(found) == 5 and {(r["doc_id"], r["text"]) for r in found} == {(None, other), (5, first), (6, None), (7, ""), (8, " ")}
    assert (None, other, "a", None, 1) in kept and (first == near or (5, base, "de", "s", 1) in kept)


def test_stages_with_nothing(spark, corpus):
    for name, found in by_stage(spark, corpus, []).items():
        assert found.count() == 0, name
        assert name == "packing" or found.columns == corpus_pipeline.COLUMNS


def test_stages_with_odd_rows(spark, corpus):
    """Repeated rows, ids with two texts, nulls in every column, columns of clashing names in any case."""
    good = [prose(k, 120).capitalize() + "." for k in (70, 71, 72)]
    rows = [(1, good[0], None, None, None), (1, good[0], None, None, None), (2, good[1], "en", "s", 5), (2, good[2], "en", "s", 6),
            (None, good[2] + " mail a.b@host.example.org", "en", None, 7), (3, None, None, None, None), (None, None, None, None, None)]
    extra = ", TEXT string, score double, kept string, key string, row int, fails int"
    found = by_stage(spark, corpus, [(*r, "x", 0.5, "k", "key", 1, 2) for r in rows], SCHEMA + extra)
    ids = {name: sorted((r["doc_id"] if r["doc_id"] is not None else -1) for r in df.select("doc_id").collect()) for name, df in found.items()}
    assert ids["quality rules"] == [-1, 1, 1, 2, 2]
    assert ids["near-dedup"] == [-1, 1, 2, 2, 3]  # the address is a near copy of 2's second text; null texts have no copies
    assert ids["PII"] == [-1, -1, 1, 1, 2, 2, 3]
    assert set(ids["packing"]) == {-1, 1, 2, 3} and set(ids["quality classifier"]) >= {1, 2}
    texts = {r["text"] for r in found["PII"].collect()}
    assert good[2] + " mail [EMAIL]" in texts and None in texts
