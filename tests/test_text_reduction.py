"""Reduced text features: texts are read and tokenised once."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tenderlens.operators import text as TX

ROWS = [(1, "alpha beta beta"), (2, None), (3, "! ?"), (4, "gamma alpha"), (4, "delta, alpha"), (5, "Beta_2 x yy"), (None, "lost words"),
        (6, "alpha alpha zeta")]


def test_texts_are_read_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(t):
        seen.add(1)
        return t

    read = F.udf(count, T.StringType()).asNondeterministic()
    df = spark.createDataFrame(ROWS, "k long, t string").withColumn("t", read("t"))
    assert len(TX.reduced_text_features(df, "k", "t", k=2, dim=8).collect()) == 7
    assert seen.value == len(ROWS)


def test_dense_embedding_equals_the_long_form(spark):
    """Repeated keys are one row, keys without tokens and the null key have zeros."""
    df = spark.createDataFrame(ROWS, "k long, t string")
    want = {r["k"]: r["embedding"] for r in TX.long_to_dense(TX.embed_text_long(df, "k", "t", 8), "k", 8, all_keys=df).collect()}
    rows = TX.embed_text_dense(df, "k", "t", 8).collect()
    assert len(rows) == len(want) == 7
    assert all(r["embedding"] == pytest.approx(want[r["k"]], abs=1e-15) for r in rows)
    assert sum(want[None]) == sum(want[2]) == sum(want[3]) == 0
