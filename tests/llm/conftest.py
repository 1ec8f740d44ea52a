import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns that operators use inside, or call their own.
CLASHING = ["shard", "slot", "size", "rejected_by", "row", "fp", "key", "rate", "rank", "part", "_row", "_key", "word", "tokens"]


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty and long texts, repeated rows and ids, clashing columns."""
    from pyspark.sql import functions as F

    long = " ".join(f"w{i % 700}" for i in range(30_000))
    plain = " ".join(f"word{i}" for i in range(60))
    rows = [
        (1, plain, "en", "a", 5), (2, plain, "en", "a", 5), (2, plain, "en", "a", 5), (3, None, None, None, None), (4, "", "en", "b", 0),
        (None, "a b c", "fr", "b", 3), (None, "a b c", "fr", "b", 3), (5, " \t\n ", "", "", -1), (6, long, "en", "a", len(long)),
        (7, "é ü 漢字 <|endoftext|> \x00\x1f", "zh", "c", 9), (7, "same id, other text", "en", "c", 9), (8, "#### $$$ %%% " * 40, "en", "c", 9),
    ]
    return spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("x") for c in CLASHING})


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
