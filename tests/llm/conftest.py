import pytest
from pyspark.sql.types import StructType

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    """A documents table from texts, or from (text, lang, source); ids count from 0."""

    def build(texts, partitions=2):
        rows = []
        for k, x in enumerate(texts):
            text, lang, source = x if isinstance(x, tuple) else (x, "en", "s")
            rows.append((k, text, lang, source, len(text or "")))
        return spark.createDataFrame(rows, StructType.fromDDL(DOCUMENTS)).repartition(partitions, "doc_id")

    return build


#: Texts that every operator must take: nothing, nulls, repeats, one very long word and text.
ODD = [None, "", " \n\t ", "a", "a", "é" * 5000, "word " * 3000, "x\n" * 2000, "\x00\x01 - --", "1.2.3.4 @ +1 a@b.c", "𝒳 😀 ß y"]


@pytest.fixture
def odd():
    return ODD


@pytest.fixture
def clashing():
    """Adds columns whose names operators might use inside."""
    from pyspark.sql import functions as F

    names = "words n_words spans items score label key node rep class_id line chunk hash count features h w prob value".split()

    def add(df):
        return df.select("*", *(F.lit("z").alias(n) for n in names))

    return add
