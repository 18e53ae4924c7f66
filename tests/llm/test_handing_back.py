"""Workers give memory that is free back to the system when a task ends."""

from __future__ import annotations

from pathlib import Path

import numpy as np
import pyarrow as pa

from textkg.llm.common import handing_back


def resident_mb() -> float:
    return int(Path("/proc/self/statm").read_text().split()[1]) * 4096 / 1e6


def test_free_memory_goes_back_and_batches_stay(spark):
    pinned = []

    def run(batches):
        for batch in batches:
            held = [np.ones(12_000) for _ in range(2000)]  # 192 MB in pieces of the heap
            pinned.append(np.ones(12_000))  # above them, so the heap cannot shrink by itself
            del held
            yield batch

    batches = [pa.record_batch({"x": [i]}) for i in range(2)]
    assert list(run(batches)) == batches
    before = resident_mb()
    assert list(handing_back(run)(batches)) == batches
    assert resident_mb() < before - 100


def test_a_worker_of_a_stage_hands_back(spark):
    @handing_back
    def run(batches):
        for batch in batches:
            yield batch

    assert spark.range(5).mapInArrow(run, "id long").count() == 5
