import pytest
from pyspark.sql import functions as F

PROSE = "the river and the old stone bridge of a small town in the hills where people walk to work every day"


def words(seed, count):
    vocabulary = PROSE.split()
    return " ".join(vocabulary[(seed * 7 + k * k + k * seed) % len(vocabulary)] + str(k % (seed + 3)) for k in range(count))


ROWS = [
    (1, PROSE, "en", "a", 1),
    (1, PROSE, "en", "a", 1),  # a repeated row
    (2, PROSE, "en", "b", 1),  # a copy
    (3, PROSE + " today", "en", None, 1),
    (4, None, None, "b", None),
    (5, "", "de", "b", 0),
    (6, " \n\t ", "de", "a", 4),
    (7, "word", "fr", "a", 4),
    (None, PROSE, "en", "a", 1),
    (None, None, None, None, None),
    (8, words(3, 400), "fr", "c", 1),
    (8, words(5, 300), "fr", "c", 1),  # the same id, another text
    (9, "x" * 120_000, "en", "a", 120_000),  # one very long word
    (10, (PROSE + " ") * 1_500, "en", "a", 1),
    (11, "mail me: Ana.Lee@example.org, +1 (555) 123-4567; ana.lee@EXAMPLE.org", "en", "a", 1),
    (12, "日本語 текст 😀 é́   ﻿", "en", "d", 1),
]
#: Names that operators use for columns of their own.
CLASHES = ["score", "kept", "ids", "h", "size", "limit", "component_id", "n_tokens", "s", "l", "rep", "a", "b", "key", "__id", "toxicity", "language", "copies"]


@pytest.fixture(scope="session")
def odd(spark):
    """Documents with every kind of odd row, and columns with clashing names."""
    df = spark.createDataFrame(ROWS, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    return df.withColumns({c: F.lit("x") for c in CLASHES})


@pytest.fixture(scope="session")
def nothing(odd):
    return odd.where("1 = 0")


@pytest.fixture(scope="session")
def sf_dir():
    from conftest import SF_DIR

    return SF_DIR
