import pytest


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and long texts, ties, repeated rows, and columns named like the operators' own."""
    long = "lorem ipsum dolor sit amet, " * 40_000
    once = "The quick brown fox jumps over the lazy dog and runs to the river with all of its friends on a warm day."
    rows = [
        (1, once, "en", "a", 5), (1, once, "en", "a", 5), (1, "another text of the same id with some words in it", "en", "a", 5),
        (None, once, None, None, None), (None, None, None, None, None), (None, None, None, None, None), (None, "", "de", "b", 0),
        (4, None, "fr", "b", 0), (5, "", None, "c", 0), (6, "   \n\t \n", "en", None, 3), (7, "123 !!! ???", "en", "a", 1),
        (8, long, "en", "b", 9), (9, long + "end", None, "c", 9), (10, "x" * 50_000, "en", "a", 9), (11, "word", "en", "a", 4),
        (12, "日本語のテキスト。 Привет мир", "de", "c", 1), (13, "a\x00b   ▁ <|endoftext|> <s>", "en", "a", 1), (-3, once + " More.", "en", "a", 2),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    clash = "id row key start end shard slot size node head record bucket words lines place near drop parity score spans __pattern __hash item items t1 t2 h1 line bands".split()
    from pyspark.sql import functions as F

    return df.withColumns({c: F.lit("clash") for c in clash})


@pytest.fixture(scope="session")
def nothing(odd):
    return odd.limit(0)
