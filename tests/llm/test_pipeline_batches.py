"""Stages bound the batches of their session by bytes."""

from __future__ import annotations

import corpus_pipeline as cp


def test_larger_settings_are_lowered_and_smaller_ones_stay(spark):
    key = cp._BATCH_KEY
    old = spark.conf.get(key)
    try:
        for said, want in (("64m", cp.BATCH_BYTES), (str(cp.BATCH_BYTES + 1), cp.BATCH_BYTES), ("1000", 1000)):
            spark.conf.set(key, said)
            cp.bound_batches(spark)
            assert int(spark.conf.get(key).rstrip("b")) == want
    finally:
        spark.conf.set(key, old)
