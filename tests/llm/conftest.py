import pytest

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, rows):
    return spark.createDataFrame([(i, t, lang, s, None if t is None else len(t)) for i, t, lang, s in rows], DOCUMENTS)


@pytest.fixture(scope="session")
def edge_rows():
    """Nulls in every column, empty and blank texts, a very long one, equal ids, equal rows."""
    long = " ".join(f"word{i % 9973}" for i in range(120_000))
    return [(1, "The cat sat on the mat and the dog ran.", "en", "a"), (2, None, "en", "a"), (3, "", None, None), (4, " \n\t ", "de", "b"),
            (5, long, "en", "b"), (6, "Der Hund und die Katze sind im Haus.", "de", None), (6, "Der Hund und die Katze sind im Haus.", "de", None),
            (7, "The cat sat on the mat and the dog ran.", None, "a"), (7, "Another text of the same id.", "en", "c"),
            (None, "A text without an id but with words.", "en", "c"), (8, "123 456 ... !!!", None, "c"), (9, "naïve café \U0001f600  x y", "fr", "")]


@pytest.fixture(scope="session")
def edge_docs(spark, edge_rows):
    return documents(spark, edge_rows).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return documents(spark, [])


def clashing(df):
    """Extra columns with names that the operators add or use."""
    from pyspark.sql import functions as F

    names = "score predicted size taken target copies label n held_out fingerprint _text _id _key cls component host decoded".split()
    return df.withColumns({n: F.lit("x") for n in names})
