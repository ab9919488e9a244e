import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
from llm_helpers import DOCS  # noqa: E402


@pytest.fixture(scope="session")
def docs(spark):
    return spark.createDataFrame([(i, t, "clash", 1) for i, t in DOCS], "doc_id long, text string, node string, chunk int")


@pytest.fixture(scope="session")
def none(docs):
    return docs.where("doc_id = -1")
