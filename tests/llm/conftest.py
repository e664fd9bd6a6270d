import pytest

LONG = "wörter und Worte\n" * 4000
#: Rows (doc_id, text, lang, source) with every awkward case.
AWKWARD = [
    (1, "the cat sat on the mat and the cat sat on the mat again today", "en", "a"),
    (2, None, "en", "a"),
    (3, "", None, None),
    (4, "   \n\t ", "de", "b"),
    (5, LONG, "de", "b"),
    (6, "the cat sat on the mat and the cat sat on the mat again today", "en", None),
    (6, "the cat sat on the mat and the cat sat on the mat again today", "en", None),
    (None, "no id here, but some words all the same", None, "c"),
    (7, "12345 67890 --- !!! 😀", "fr", "c"),
    (8, "\x00 odd  spaces \n and\r\nlines ▁ <|endoftext|> é é ", "fr", "ü"),
]
SCHEMA = "doc_id bigint, text string, lang string, source string"
#: Extra columns named like those that operators make.
EXTRA = ("size", "fp", "key", "h", "component", "component_id", "n", "score", "_sim_key", "_mix_key", "_mix_n", "copies", "rank")


@pytest.fixture(scope="session")
def awkward(spark):
    from pyspark.sql import functions as F

    return spark.createDataFrame(AWKWARD, SCHEMA).withColumns({c: F.lit("x") for c in EXTRA})


@pytest.fixture(scope="session")
def nothing(awkward):
    return awkward.limit(0)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


@pytest.fixture(scope="session")
def doc_rows(documents):
    return [r.asDict() for r in documents.collect()]
