"""Documents that are awkward in every way, shared by the tests of this folder."""

import duckdb
import pytest
from pyspark.sql import functions as F

LONG = "lorem ipsum dolor sit amet consectetur " * 4000
MESSY = [
    (1, "The cat sat on the mat, and the dog did not.", "en", "a", 44),
    (1, "The cat sat on the mat, and the dog did not.", "en", "a", 44),  # a repeated row
    (2, "the CAT sat on the mat, and the DOG did not.", "en", "b", 44),
    (3, None, None, None, None),
    (4, "", "", "", 0),
    (5, "   \n\t ", "en", "a", 6),
    (6, LONG, "en", "a", len(LONG)),
    (7, "größe ñandú \U0001f600 日本語 test", "de", None, 30),
    (None, "a text without an id that is long enough to have shingles", "en", "a", 5),
    (None, None, None, None, None),
    (8, "!!! ??? ...", "en", "a", 11),
    (9, "w", "en", "a", 1),
    (-5, "nul \x00 byte and \r\n line ends and blanks", "en", "a", 40),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that the operators use inside.
CLASHING = ["id", "label", "score", "rows", "bucket", "chunk", "kind", "weight", "u", "v", "n",
            "key", "digest", "at", "normal", "labels", "rate", "hits", "bands", "learn"]


def ascii_lower(text):
    return "".join(c.lower() if c.isascii() else c for c in text or "")


@pytest.fixture(scope="session")
def messy(spark):
    docs = spark.createDataFrame(MESSY, SCHEMA).repartition(3, "text")
    return docs.select("*", *[F.lit(i).alias(c) for i, c in enumerate(CLASHING)])


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def no_labels(spark):
    return spark.createDataFrame([], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="session")
def labels(spark):
    rows = [(1, 1, 0), (2, 1, 0), (2, 0, 1), (3, 0, 1), (6, 1, None), (None, 1, 1), (99, 0, 0)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def table_rows(sf, sql):
    return duckdb.sql(sql.format(d=f"/root/testdata/{sf}")).fetchall()
