import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
sys.path.append(os.path.dirname(os.path.abspath(__file__)))

from llm_cases import HARD  # noqa: E402


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    from snapfeed.llm.registry import ship

    ship(spark)


@pytest.fixture(scope="session")
def hard(spark):
    rows = [(*r, i, i, i, "x", True, 0.5) for i, r in enumerate(HARD)]
    names = "doc_id long, text string, lang string, source string, n_chars long, size int, rep int, token int, bucket string, kept boolean, score double"
    return spark.createDataFrame(rows, names)


@pytest.fixture(scope="session")
def no_docs(hard):
    return hard.where("false")


@pytest.fixture(scope="session")
def hard_labels(spark):
    return spark.createDataFrame([(1, 1, 0), (1, 0, 0), (2, 1, None), (2, 1, 0), (5, 0, 0), (None, 1, 0), (6, None, 1), (99, 1, 1)], "doc_id long, quality int, toxic int")
