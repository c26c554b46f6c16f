import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make_docs(spark):
    """[(id, text)] -> rows with the columns of documents."""
    def make(pairs):
        return spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t)) for i, t in pairs], DOCS)
    return make


@pytest.fixture(scope="session")
def small_docs(spark, small):
    return spark.read.parquet(f"{small}/documents.parquet")


@pytest.fixture(scope="session")
def odd_docs(make_docs):
    """Nulls, empty and very long texts, ties, repeated rows, odd white space, no spaces, other scripts."""
    return make_docs([
        (1, None), (2, ""), (3, " "), (4, "a  b \n c\t\td  "), (5, "word " * 5000), (6, "x" * 6000),
        (7, "Hello, it's <|endoftext|> me"), (7, "Hello, it's <|endoftext|> me"), (8, "日本語 の テキスト 🙂 é é"),
        (None, "no id"), (9, "tie one two three"), (10, "tie one two three"), (11, " lead space  x")])


@pytest.fixture(scope="session")
def clashing(small_docs):
    """Extra columns whose names an operator may use itself."""
    from pyspark.sql import functions as F
    return small_docs.select("*", *[F.lit("x").alias(c) for c in (
        "start", "length", "a", "b", "node", "root", "bucket", "line", "hash", "score", "pack_group", "part", "key",
        "id", "ids", "value", "class_id", "n_tokens", "row")])
