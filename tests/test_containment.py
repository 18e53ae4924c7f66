"""Types by containment: what is searched for, and what is shuffled when the terms are many."""

from __future__ import annotations

from pyspark.sql import functions as F

from textkg.operators import matching
from textkg.operators import triples as tr
from conftest import rows


def test_typed_items_are_their_own_holders_and_not_searched_for(spark, monkeypatch):
    searched = []

    def noted(texts, text, terms, term, *more):
        searched.extend(r[0] for r in terms.collect())
        return matching.substring_pairs(texts, text, terms, term, *more)

    monkeypatch.setattr(tr, "substring_pairs", noted)
    typed = spark.createDataFrame(
        [("greenhouse", "B"), ("greenhouse", "A"), ("old_greenhouse", "C"), ("house", "D"), ("big_house_door", None)], "entity string, type string"
    )
    items = spark.createDataFrame([(x,) for x in ("greenhouse", "reenhouse", "house", "ous", "house_doo", "absent_thing")], "entity string")
    found = rows(tr._type_by_containment(items, typed))
    assert sorted(searched) == ["absent_thing", "house_doo", "reenhouse"]
    assert found == [("greenhouse", "A"), ("house", "D"), ("house_doo", None), ("ous", "D"), ("reenhouse", "A")]


def test_marked_keys_leave_out_most_pieces_and_lose_no_pair(spark, monkeypatch):
    keyed = spark.range(0, 1000).select(F.xxhash64("id").alias("__key"))
    pieces = spark.range(0, 50_000).select("id", F.xxhash64("id").alias("__key"))
    left = {r.id for r in matching._with_marked_keys(pieces, keyed).collect()}
    assert set(range(1000)) <= left and len(left) < 1100

    texts = spark.createDataFrame([("the grass is green",), ("évergreen",), ("no",), ("",)], "t string")
    terms = spark.createDataFrame([("green",), ("gras",), ("é",), ("o",), ("blue",)], "w string")
    plain = rows(matching.substring_pairs(texts, "t", terms, "w"))
    monkeypatch.setattr(matching, "BROADCAST_BYTES", -1)
    assert rows(matching.substring_pairs(texts, "t", terms, "w")) == plain
    assert len(plain) == 5


def test_types_are_written_before_they_are_looked_up(spark):
    """What is left to do has no pieces of holders, so their exchanges are off the disk, and the sides are the same when read late."""
    triples = spark.createDataFrame([("cat", "p", "catfish"), ("fish", "q", "dog"), ("x", "r", "")], "subject string, predicate string, object string")
    typed = spark.createDataFrame([("catfish", "Species"), ("hotdog", "Food")], "entity string, type string")
    types = tr.triple_types(triples, typed, typed)
    plan = types._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan and "parquet" in plan
    want = {("cat", "Species", "Species"), ("fish", "Species", "Food"), ("x", "Other", "Other")}
    assert {(r.subject, r.subject_type, r.object_type) for r in types.collect()} == want
