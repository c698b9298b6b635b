import os
import sys

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def docs(spark):
    """Frame of documents from (doc_id, text) pairs, with the other columns and one whose name clashes with results."""

    def make(rows):
        full = [(i, t, "en", "s", len(t or "")) for i, t in rows]
        frame = spark.createDataFrame(full, DOCS)
        for name in ("component_id", "n_words", "spans", "rejected", "start", "kept"):
            frame = frame.withColumn(name, F.lit("x"))
        return frame

    return make
