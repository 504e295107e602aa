from __future__ import annotations

import pytest

WORDS = "the of and to in that it was for on with as at by from this are be or an which one you had not but were have".split()


def sentence(seed: int, words: int) -> str:
    """Some text that differs from seed to seed."""
    import random

    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + str(r.randrange(40)) for _ in range(words))


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Nulls in every column, empty and very long texts, repeated rows, an extra column whose names clash."""
    rows = [
        (1, "The quick brown fox. token = abcdef123456 and more words of it", "en", "a", 1),
        (1, "The quick brown fox. token = abcdef123456 and more words of it", "en", "a", 1),
        (2, None, "en", None, None),
        (3, "", None, "b", 0),
        (None, "no id here, but a text with some words", "en", "b", 3),
        (None, None, None, None, None),
        (4, "   \n\n \t ", "en", "c", 5),
        (5, "12345 !!! ???", "de", "c", 5),
        (6, "x" * 50_000, "en", "c", 5),
        (7, " ".join(sentence(7, 40) for _ in range(200)), "en", "d", 5),
        (8, "Ünïcödé ☃ text \u0000 with odd   spaces ▁ and <|endoftext|> marks | \\ ", "fr", "d", 5),
    ]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    clashing = {"ids": "start", "spans": "block", "group": "root", "fp": "h"}
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, schema)
    for a, b in clashing.items():
        df = df.withColumn(a, F.lit(a)).withColumn(b, F.lit(b))
    return df
