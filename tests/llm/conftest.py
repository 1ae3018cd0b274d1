import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from llm_rows import CLASHING, frame, invented, rows_of  # noqa: E402


@pytest.fixture(scope="session")
def messy_rows():
    """NULLs in every column, empty and very long texts, repeated rows and ids, odd letters."""
    plain = invented(12, 40)
    rows = rows_of(plain)
    rows += [rows[3], rows[3], (3, "another text of the same id", "en", "s0", 27, *CLASHING)]
    rows += [(None, plain[0], None, None, None, *[None] * len(CLASHING)),
             (None, None, None, None, None, *[None] * len(CLASHING)),
             (100, None, "en", "s1", 0, *CLASHING), (101, "", None, None, 0, *CLASHING),
             (102, " \t\n\x0b ", "de", "s1", 5, *CLASHING), (103, "!!! ... ???", "de", "s2", 11, *CLASHING),
             (104, "ÀÉ ñandú Straße 中文字 \U0001F600 ﬁ É́ \x1c x", "fr", "s2", 30, *CLASHING),
             (105, " ".join(invented(1, 60_000, seed=9)), "en", "s0", 0, *CLASHING)]
    return rows


@pytest.fixture(scope="session")
def messy(spark, messy_rows):
    return frame(spark, messy_rows)


@pytest.fixture(scope="session")
def nothing(spark):
    return frame(spark, [])


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame(
        [(0, 1, 0), (1, 0, 1), (1, 0, 1), (2, None, None), (None, 1, 1), (3, 1, 0), (4, 0, 1)],
        "doc_id long, quality int, toxic int")


@pytest.fixture(scope="session")
def no_labels(spark):
    return spark.createDataFrame([], "doc_id long, quality int, toxic int")
