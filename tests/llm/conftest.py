import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

@pytest.fixture(scope="session")
def spark():
    from featspark.session import local_session
    return local_session(cores=4, shuffle_partitions=4, app="corpus-tests")


@pytest.fixture
def odd_docs(spark):
    """Nulls in every column, empty texts, ties, repeated rows, clashing extra columns."""
    long = "word " * 30_000
    rows = [(1, "Alpha beta gamma delta epsilon", "en", "s1", 1), (1, "Alpha beta gamma delta epsilon", "en", "s1", 1),
            (2, "alpha BETA gamma delta epsilon", None, None, 2), (3, None, "en", "s2", None), (4, "", "de", "s1", 0),
            (None, "no id at all", "en", None, 3), (None, None, None, None, None), (5, long, "en", "s3", 4),
            (6, " \n\t ", "fr", "s2", 5), (7, "é😀 x@y.org 10.0.0.1 +1 (687) 555-2224", "es", "s3", 6)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    df = spark.createDataFrame(rows, schema)
    for extra in ("row", "size", "fp", "key", "block", "tid", "g", "kept", "component", "score"):
        df = df.selectExpr("*", f"'x' AS {extra}")
    return df


@pytest.fixture
def no_docs(odd_docs):
    return odd_docs.filter("false")
