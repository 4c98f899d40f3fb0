from __future__ import annotations

import random

import pytest

from stockflow.llm.shipping import ship


@pytest.fixture(scope="session")
def spark(spark):
    ship(spark)
    return spark


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, band int, node string, rank int, start int"


@pytest.fixture(scope="session")
def rows():
    """(doc_id, text): copies, near copies, shared passages, very long, empty and null texts, and ties."""
    rng = random.Random(7)
    vocab = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyzäé") for _ in range(rng.randint(2, 9))) for _ in range(400)]
    prose = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    base, passage = prose(120), prose(60)
    texts = [None, "", "   \n\t ", "one", "Two words", base, base, base.upper(), base.replace(" ", "  ")]
    for i in range(12):
        words = base.split(" ")
        for _ in range(i):
            words[rng.randrange(len(words))] = rng.choice(vocab)
        texts.append(" ".join(words))
    texts += [f"{prose(40)}\n{passage}\n{prose(30)}" for _ in range(8)]
    texts += ["x" * 700, "ab" * 300, f"{passage} {passage} {passage}", prose(9000), "line of words here\n" * 60]
    texts += [prose(rng.randint(1, 200)) for _ in range(30)]
    ids = rng.sample(range(5000), len(texts))
    return list(zip(ids, texts, strict=True))


def frame_of(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t or ""), 1, "n", 2, 3) for i, t in rows], SCHEMA)


@pytest.fixture(scope="session")
def docs(spark, rows):
    return frame_of(spark, rows).repartition(3).cache()


@pytest.fixture(scope="session")
def odd(spark, rows):
    """Repeated rows and rows without an id."""
    return frame_of(spark, [*rows[:12], rows[5], rows[5], (None, rows[5][1]), (None, None), (None, None)])


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
