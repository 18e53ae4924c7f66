"""Words of the chain are folded and lemmas formed once for all their uses."""

from __future__ import annotations

from pyspark.sql import functions as F

from textkg.functions import offsets as of


def test_a_word_is_folded_once(spark):
    made = str(of.located_lemmas(F.col("m"), F.col("start")))
    assert made.count("lower(") == 1 and made.count("endswith(") + made.count("endsWith(") <= 12
    df = spark.createDataFrame([("The AD CITIES￿ moved, walkings x", 5)], "m string, start int")
    found = [tuple(r) for r in df.select(F.inline(of.located_lemmas(F.col("m"), F.col("start")))).collect()]
    assert found == [
        ("the", "dt", 5, 3), ("alzheimers_disease", "nn", 9, 2), ("city", "nn", 12, 6),
        ("mov", "vb", 20, 5), ("walking", "nn", 27, 8), (".", "", 37, 0),
    ]


def test_sums_cross_blocks(spark):
    n = 3 * of._SUM_BLOCK + 5
    got = spark.range(1).select(of.running_sums(F.sequence(F.lit(1), F.lit(n))).alias("s")).first().s
    assert got == [i * (i + 1) // 2 for i in range(n)]
