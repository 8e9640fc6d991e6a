import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def make_text(rng, n, vocabulary):
    out = []
    for i in range(n):
        out.append(rng.choice(vocabulary) + (rng.choice([".", ".\n"]) if i % 11 == 10 else ""))
    return " ".join(out)


@pytest.fixture(scope="session")
def vocabulary():
    rng = random.Random(5)
    stems = ["th", "on", "er", "ing", "re", "at", "ou", "st", "en", "ha", "é", "ü", "日本"]
    return ["the", "of", "and", "to", "in"] * 8 + ["".join(rng.choices(stems, k=rng.randint(2, 4))) for _ in range(400)]


@pytest.fixture(scope="session")
def doc_rows(vocabulary):
    """Copies, near copies of several degrees, shared passages, junk, nulls, empty texts."""
    rng = random.Random(11)
    rows = []

    def add(text, source="web"):
        rows.append((len(rows), text, "en", source, len(text) if text is not None else None))

    passage = make_text(rng, 60, vocabulary)
    for k in range(30):
        add(make_text(rng, rng.randint(12, 120), vocabulary))
    for k in range(6):
        add(rows[k][1])  # exact copies
    base = make_text(rng, 90, vocabulary).split(" ")
    for k in range(25):  # one family, from close to unlike
        copy = list(base)
        for _ in range(k // 2):
            copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
        add(" ".join(copy))
    for k in range(8):
        add(make_text(rng, 25, vocabulary) + " " + passage + " " + make_text(rng, 25, vocabulary))
    add("a b c " * 80)
    add("x" * 700)
    add(("same line of words here\n") * 30)
    for text in (None, "", " ", "\n\t", "word", "Word", "two words", "..."):
        add(text)
    add("é" * 150 + " tail")
    add("é" * 150 + " other")
    return rows


@pytest.fixture(scope="session")
def docs(spark, doc_rows):
    return spark.createDataFrame(doc_rows, SCHEMA).repartition(4)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def clashing(spark, doc_rows):
    """The documents with columns that have the operators' own names."""
    from pyspark.sql import functions as F

    names = ("n_words kept row anchor name hash component component_id shard slot size n_tokens id a b node n "
             "registers bucket text_hash runs carried pieces high low cell lang_pred score _id gone").split()
    frame = spark.createDataFrame(doc_rows, SCHEMA)
    return frame.withColumns({c: F.lit("clash") for c in names})
