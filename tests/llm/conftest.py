"""Small tables with the cases that every operator must stand: nulls, empties, copies, long texts, clashing columns."""

import random

import pytest
from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)
VOCABULARY = "the of and a in is it over river stone bright window paper listen carry table green".split()


def sentence(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(VOCABULARY) + rng.choice(["", "", "s", "er", "ing"]) for _ in range(n))


def corpus(seed: int = 1, n: int = 60) -> list[tuple]:
    """Documents of several lines with copies, near copies, shared passages and odd texts."""
    rng = random.Random(seed)
    texts: list[str | None] = []
    passage = sentence(rng, 60)
    for i in range(n):
        text = "\n".join(sentence(rng, rng.randint(1, 40)) for _ in range(rng.randint(1, 5)))
        if i % 7 == 3:
            text = texts[rng.randrange(i)] or "x"
        if i % 7 == 5:
            words = (texts[i - 1] or "a b c").split(" ")
            words[rng.randrange(len(words))] = "changed"
            text = " ".join(words)
        if i % 9 == 4:
            text += "\n" + passage
        texts.append(text)
    texts += [None, "", " \t\n ", "one", "two words", "naïve café — 東京   nbsp", "ABC abc\r\n\r\nABC abc\x0bz", " ".join(["again"] * 70)]
    texts += [sentence(rng, 6000), None, ""]
    return [(3 * i, t, "en", "src0" if i % 3 else "src1", len(t or "")) for i, t in enumerate(texts)]


@pytest.fixture(scope="session")
def docs(spark):
    return spark.createDataFrame(corpus(), DOCS).repartition(5)


@pytest.fixture(scope="session")
def empty_docs(spark):
    return spark.createDataFrame([], DOCS)


def twins(n: int, a: str, b: str) -> tuple[list[str], list[str]]:
    """Two different sequences of n letters (n a power of two) that agree in every polynomial hash modulo 2**64."""
    first, second = [a], [b]
    while len(first) < n:
        first, second = first + second, second + first
    return first, second
