from __future__ import annotations

import random

import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, uid string, name string, size string, kept string, h int, _key int"
TAIL = ("u", "n", "s", "k", 1, 2)


def _text(seed: int, words: int, per_line: int = 9) -> str:
    pick = random.Random(seed)
    vocabulary = ["".join(pick.choice("abcdefghilmnorstuéß") for _ in range(pick.randint(2, 8))) for _ in range(400)]
    out = [pick.choice(vocabulary) for _ in range(words)]
    return "\n".join(" ".join(out[i : i + per_line]) + "." for i in range(0, words, per_line))


def _edited(text: str, seed: int, edits: int) -> str:
    pick = random.Random(seed)
    words = text.split(" ")
    for _ in range(edits):
        words[pick.randrange(len(words))] = f"changed{pick.randrange(1000)}"
    return " ".join(words)


@pytest.fixture(scope="session")
def corpus() -> list[tuple]:
    """Rows of odd and ordinary documents; sources and languages with nulls and ties."""
    texts: list[tuple] = [(0, None), (1, ""), (2, " \n\t "), (3, "one"), (4, "One two three"), (5, "Ñandú 漢字 🙂 İstanbul ΣΑΣ don't we'LL")]
    base = _text(1, 300)
    texts += [(10, base), (11, base), (12, base.replace(" ", "  ")), (13, base.upper()), (None, base), (14, base + "\n" + base)]
    texts += [(20 + i, _edited(base, i, 1 + i)) for i in range(8)]
    passage = _text(2, 70)
    texts += [(30 + i, _text(100 + i, 60) + "\n" + passage + "\n" + _text(200 + i, 60)) for i in range(8)]
    texts += [(40, _text(3, 30_000)), (41, "na " * 3_000), (42, "x" * 5_000), (43, "\n".join(["same line here"] * 50))]
    texts += [(50 + i, _text(300 + i, 20 + 13 * i)) for i in range(20)]
    texts += [(80, "repeated row " * 30)] * 3 + [(81, "repeated row " * 30)]
    texts += [(90, "Released under the MIT License.\n" + _text(4, 40) + "\nLicensed under the\tApache Licence, Version 2.0.")]
    sources = ["a", "a", "a", "b", None, "c", "Z", "é"]
    langs = ["en", "de", None]
    return [
        (i, t, langs[k % 3], sources[k % 8], len(t or "") if k % 5 else None, *TAIL) for k, (i, t) in enumerate(texts)
    ]


@pytest.fixture(scope="session")
def documents(spark, corpus):
    return spark.createDataFrame(corpus, SCHEMA)


@pytest.fixture(autouse=True)
def few_partitions(spark):
    """Another number of partitions than the rest of the tests have, put back after
    each test."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


@pytest.fixture(scope="session")
def no_documents(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def text_of(spark):
    """A frame of ids and texts."""

    def make(*rows: tuple):
        return spark.createDataFrame(list(rows), "doc_id bigint, text string")

    return make


@pytest.fixture(scope="session")
def some_text():
    return _text
