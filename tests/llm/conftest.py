import pytest

#: Texts that every operator must take: null, empty, blank, very long, repeated, tied.
LONG = " ".join(f"word{i % 977}" for i in range(40_000))
PASSAGE = " ".join(f"shared{i}" for i in range(60))
ODD = [
    (1, None, "en", "a", 0),
    (2, "", "en", "a", 0),
    (3, " \t\n ", None, "a", 4),
    (4, LONG, "en", None, None),
    (5, f"one two {PASSAGE} three", "en", "a", 1),
    (6, f"four {PASSAGE} five\nsix", "en", "a", 1),
    (7, f"four {PASSAGE} five\nsix", "en", "a", 1),
    (8, f"four {PASSAGE} five\nsix", "en", "a", 1),
    (8, f"four {PASSAGE} five\nsix", "en", "a", 1),
    (9, "x", "en", "a", 1),
    (None, "a text without an id, of a few words", "en", "a", 3),
    (10, "emoji 🙂 \U0001d11e é ｆｕｌｌ \x00 nul", "fr", "b", 9),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def odd_docs(spark):
    return spark.createDataFrame(ODD, SCHEMA)


@pytest.fixture(scope="session")
def wide_docs(odd_docs):
    """The same rows with columns whose names the operators use themselves."""
    from pyspark.sql import functions as F

    names = ("r", "fp", "a", "b", "key", "part", "score", "drop", "pos", "n", "line", "group", "component", "label", "docs", "words")
    return odd_docs.withColumns({c: F.lit(7) for c in names})


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
