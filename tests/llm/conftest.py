import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture
def docs(spark):
    """docs(rows of (id, text)): a documents table, with extra columns whose names clash with the operators' own."""

    def make(rows, extra=True):
        df = spark.createDataFrame([(i, t, "en", "s", len(t) if t is not None else None) for i, t in rows], DOCS)
        if extra:
            from pyspark.sql import functions as F

            for c in ("score", "h", "pos", "fp", "part", "labels", "words", "key", "y", "comp", "g"):
                df = df.withColumn(c, F.lit("x"))
        return df

    return make


@pytest.fixture(scope="session")
def odd_texts():
    """Nulls, empties, blanks, letters outside ASCII, a very long text, repeated rows and ties."""
    long = " ".join(f"word{i % 997} is {i}" for i in range(30000))
    return [(1, None), (2, ""), (3, " \n\t "), (4, "É K İ ß 漢字 😀"), (5, long), (6, "same text here and there"), (6, "same text here and there"), (7, "same text here and there"), (None, "a null id with some words"), (None, None), (8, "\u0000 odd \u0000"), (9, "one")]
