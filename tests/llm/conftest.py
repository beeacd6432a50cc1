import random

import pytest

DOC = "doc_id long, text string, lang string, source string, n_chars long, size int, score double, keep_id string, copies int"


def words(rng, n):
    parts = ["the", "on", "er", "tion", "and", "of", "in", "re", "é", "ß"]
    return ["".join(rng.choice(parts) for _ in range(rng.randint(1, 4))) + rng.choice(["", "", "", ".", ","]) for _ in range(n)]


@pytest.fixture(scope="session")
def texts():
    """Null, empty, blank, long, repeated and nearly repeated texts."""
    rng = random.Random(4)
    prose = [" ".join(words(rng, rng.choice([1, 5, 60, 200]))) for _ in range(40)]
    long = " ".join(words(rng, 9000))
    near = prose[3].split() if len(prose[3].split()) > 50 else " ".join(prose).split()[:200]
    changed = [*near[:70], "changed", *near[71:]]
    special = ["", None, " \t\n ", "a", "A", "ThE oN", "the on", long, long.upper(), " ".join(near), " ".join(changed), "x" * 50_000, "<|endoftext|> end <|startoftext|>", "日本語 text 😀 ́́ İ", "two  spaces \n\n lines\r\n"]
    return prose + special + prose[:5]


@pytest.fixture(scope="session")
def docs(spark, texts):
    """Documents with null and repeated ids, null sources, and columns whose names operators use too."""
    rows = [(i, t, "en", None if i % 11 == 0 else f"s{i % 3}", None, 1, 0.5, "k", 2) for i, t in enumerate(texts)]
    rows += [rows[2], rows[7], rows[7], (None, "a", None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, DOC).repartition(5)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], DOC)
