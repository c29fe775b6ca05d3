import random

import pytest


def prose(seed, n):
    rng = random.Random(seed)
    syllables = ["the", "an", "or", "ti", "ble", "é", "ß", "on", "er"]
    return " ".join("".join(rng.choices(syllables, k=rng.randint(1, 3))) for _ in range(n))


BASE = prose(1, 120)


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and white texts, copies, near copies, a repeated row, a repeated id, a very long text, one long word."""
    near = BASE.split(" ")
    near[60] = "changed"
    return [
        (1, BASE), (2, None), (3, ""), (4, " \n\t "), (5, BASE), (6, " ".join(near)), (7, "one"), (8, "one two"), (8, "one two"),
        (9, prose(2, 60) + "\n" + prose(2, 60) + "\nmail a.b@mail.example.com or +1 (578) 555-6437"), (None, BASE), (None, "no id"),
        (10, prose(3, 30_000)), (11, "x" * 50_000), (12, BASE.upper()), (13, "AND!! " * 80), (14, "a&&& b### " * 60),
    ]


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    """The rows with further columns whose names clash with those of operators, in other cases too."""
    extra = "TEXT string, n_words int, kept string, component_id string, fp string, bucket string, score string, sketch int, _0 int"
    rows = [(*r, "other", 1, "k", "c", "f", "b", "s", 1, 2) for r in odd_rows]
    return spark.createDataFrame(rows, f"doc_id long, text string, {extra}").repartition(3)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], "doc_id long, text string, kept int")


def rows_of(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)
