import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

SF = "/root/testdata/sf0.001"
DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs_of(spark):
    """documents from texts, or from (doc_id, text) pairs; extra columns that
    clash with names the operators use themselves."""
    from pyspark.sql import functions as F

    def make(items):
        rows = [(i, x, "en", "s", None) if not isinstance(x, tuple) else (*x, "en", None, None) for i, x in enumerate(items)]
        df = spark.createDataFrame(rows, DOC_SCHEMA)
        for name in ("shard", "slot", "node", "bucket", "label", "toxic", "kept", "counts", "piece", "length", "part", "rank", "t", "key", "n"):
            df = df.withColumn(name, F.lit("x"))
        return df

    return make


#: Texts with nulls, empties, blanks, ties, one that is very long, and others.
HARD = [None, "", " \t\n ", "a", "same text here", "same text here", "x" * 50_000, ("word " * 30_000).strip(), "ÀÉ ñandú 日本語 🙂 é Σ", "a\x1cb\x00c d e", "<|endoftext|> tail", "don't I'LL 1234 ½"]
