import pytest
from pyspark.sql import Row
from pyspark.sql import types as T

LONG = " ".join(f"w{i % 9973}x{i}" for i in range(60_000))
DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                     T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
                     # names that operators use or return
                     T.StructField("kept", T.StringType()), T.StructField("_row", T.StringType()), T.StructField("_id", T.StringType()),
                     T.StructField("component_id", T.StringType()), T.StructField("n_words", T.StringType()), T.StructField("_text", T.StringType()),
                     T.StructField("n_lines", T.StringType()), T.StructField("copies", T.StringType()), T.StructField("_n", T.StringType())])


def _doc(i, text, lang="en"):
    return Row(i, text, lang, "s", None if text is None else len(text), "a", "b", "c", "d", "e", "f", "g", "h", "i")


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and very long texts, ties and repeated rows."""
    same = "The quick brown fox jumps over the lazy dog again."
    rows = [
        _doc(1, same), _doc(2, same.upper()), _doc(2, same.upper()), _doc(3, None), _doc(4, ""), _doc(5, " \t\n "), _doc(6, LONG), _doc(7, LONG),
        _doc(None, same), _doc(None, None), _doc(None, "only one without an id"), _doc(8, "Ünïcode ÀÉ words ß x 漢字 🙂"), _doc(9, "one"),
        _doc(10, "a b c d e f g h i j"), _doc(11, "a b c d e f g h i j k"), _doc(12, "a b c X e f g h i j"), _doc(13, "***", None), _doc(14, same + "\n" + same, None),
        Row(*[None] * len(DOCS)), Row(*[None] * len(DOCS)),
    ]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def odd_labels(spark):
    rows = [(1, 1, 0), (2, 0, 1), (2, 1, 0), (3, None, 0), (None, 1, 1), (6, 1, None), (99, 0, 0), (6, 1, None)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


@pytest.fixture(scope="session")
def no_labels(spark):
    return spark.createDataFrame([], "doc_id long, quality int, toxic int")


SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")
