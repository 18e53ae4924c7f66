"""Windows as rows are the windows that the array functions list."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from textkg.functions import text as tx
from textkg.operators import counts as ct

TEXTS = [(1, ["a", "b", "a", "b"]), (2, ["a"]), (3, []), (4, None), (5, ["a", "b"]), (6, ["c", "", "a b", "c"])]


@pytest.mark.parametrize("sizes", [(1,), (2,), (3,), (1, 2, 3), (3, 5)])
def test_rows_equal_lists(spark, sizes):
    docs = spark.createDataFrame(TEXTS, "doc_id int, w array<string>")
    want = Counter()
    for n in sizes:
        want.update((n, r.gram) for r in docs.select(F.explode(tx.ngrams(F.col("w"), n)).alias("gram")).collect())
    found = ct.gram_rows(docs, "w", *sizes)
    assert Counter((r.size, r.gram) for r in found.collect()) == want


def test_words_are_joined_without_a_lambda(spark):
    docs = spark.createDataFrame(TEXTS, "doc_id int, w array<string>")
    plan = ct.count_by(ct.gram_rows(docs, "w", 1, 2, 3), "size", "gram")._jdf.queryExecution().optimizedPlan().toString()
    assert "lambda" not in plan
