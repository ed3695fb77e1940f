import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def make(spark):
    """Documents from (doc_id, text) pairs; the other columns are null, one clashes with a helper name."""

    def build(rows):
        rows = [(i, t, None, None, None) for i, t in rows]
        return spark.createDataFrame(rows, SCHEMA).repartition(3).withColumnRenamed("source", "__row")

    return build
