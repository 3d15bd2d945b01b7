import pytest
from pyspark.sql import types as T


@pytest.fixture(scope="session", autouse=True)
def checkpoints(spark):
    """The shared folder of the test session (set by the outer ``spark`` fixture)."""
    return spark.conf.get("spark.checkpoint.dir")


DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture
def documents(spark):
    """Documents from texts or (id, text) pairs."""
    def make(rows, schema=DOCUMENTS):
        rows = [r if isinstance(r, tuple) else (i, r) for i, r in enumerate(rows)]
        return spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t)) for i, t in rows], schema)
    return make


@pytest.fixture
def clashing(documents):
    """Documents with extra columns whose names clash with others, also in case only."""
    def make(rows):
        df = documents(rows)
        return df.toDF("doc_id", "text", "TEXT", "text", "score")
    return make


#: What every operator must get through: NULLs, empty and long texts, ties, repeats.
ODD_TEXTS = [None, "", " \t\n", "x", "a b", "a b c", "a b c", "é ☃ ẞ", "word " * 30_000, "z" * 20_000,
             "\x00 \x1f\x85 nul", "## || && **", "one\n\none\none"]


def empty_like(spark, schema):
    return spark.createDataFrame([], T._parse_datatype_string(schema) if isinstance(schema, str) else schema)
