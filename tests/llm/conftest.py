import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from pyspark.sql import SparkSession  # noqa: E402

SF = "/root/testdata/sf0.001"
DOC = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"


@pytest.fixture(scope="session")
def spark():
    s = (SparkSession.builder.master("local[4]").appName("clickflow-llm-tests")
         .config("spark.sql.shuffle.partitions", "4").config("spark.sql.session.timeZone", "UTC")
         .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(s.conf.get("spark.checkpoint.dir", None) or tempfile.mkdtemp(prefix="clickflow-llm-"))
    yield s


LONG = "the quick brown fox jumps over the lazy dog " * 3000
#: nulls in every column, empty and blank texts, repeated rows, ties, one very long text
EDGE = [(1, "a plain text with some words in it and a few more to count", "en", "h1", 5), (2, None, None, None, None),
        (3, "", "en", "h1", 0), (4, "  \t\n ", None, "h2", 3), (5, "one", "en", None, 3), (6, "Two words", "en", "h2", 9),
        (None, "a row without an id but with words in its text", "en", "h1", 1), (None, None, None, None, None),
        (7, LONG, "en", "h3", len(LONG)), (8, "same text again and again here", "en", "h1", 1),
        (9, "same text again and again here", "en", "h1", 1), (9, "same text again and again here", "en", "h1", 1),
        (10, "Über straße  façade 日本語 テキスト 😀   end", "de", "h2", 1), (11, "123 456 !!! ###", "en", "h2", 1)]


@pytest.fixture(scope="session")
def edge(spark):
    """EDGE with extra columns whose names operators use inside."""
    from pyspark.sql import functions as F
    df = spark.createDataFrame(EDGE, DOC)
    return df.withColumns({c: F.lit("x") for c in ("h", "size", "lead", "set_id", "sketch", "n", "host", "c", "rank",
                                                   "part", "seq", "row", "v", "__text", "lang_pred", "score")})


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], DOC)


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")
