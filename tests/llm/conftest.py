from __future__ import annotations

import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, taken string"  # `taken` clashes with an output name


def corpus(seed: int = 3, n: int = 60) -> list[tuple]:
    """Small documents with exact and near copies, shared passages, nulls, empty texts, ties, repeated rows and one long text."""
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(1, 7))) for _ in range(150)]
    prose = lambda k: " ".join(rng.choice(vocabulary) for _ in range(k))
    passage, texts = prose(25), []
    for k in range(n):
        t = prose(rng.randint(1, 120))
        if k % 4 == 0 and texts:
            t = rng.choice(texts)
        elif k % 4 == 1:
            t = f"{prose(20)}\n{passage}  {prose(20)}"
        elif k % 4 == 2 and texts:
            words = rng.choice(texts).split(" ")
            words[rng.randrange(len(words))] = "edité"
            t = " ".join(words)
        texts.append(t)
    rows = [(3 * k, t, rng.choice(["en", "fr"]), rng.choice(["s1", "s2", "s3", None]), len(t), "x") for k, t in enumerate(texts)]
    rows += [(1000, None, None, None, None, None), (1001, "", "en", "s1", 0, ""), (1002, " \t\n", None, "s2", 3, ""), (1003, passage * 400, "en", "s1", 1, ""), rows[5], (None, passage, "en", "s9", 1, "")]
    return rows


@pytest.fixture(scope="session")
def rows() -> list[tuple]:
    return corpus()


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
