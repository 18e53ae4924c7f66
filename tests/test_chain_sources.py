"""Mentions of the chain come from the source of their sentence, not from the whole text."""

from __future__ import annotations

from pyspark.sql import functions as F

from textkg.functions import offsets as of
from textkg.plans import q_chain

TEXT = "Été (von ’98) begins, 12 slowly/surely. The cats' tails moved the dogs!\n\nNaïve 𝒳 readers named 3.5 plans. End"


def test_sentences_come_with_their_sources(spark):
    df = spark.createDataFrame([(TEXT,), (None,), ("",)], "text string")
    masked = df.select("text", of.mask_clean(F.col("text")).alias("m"))
    found = masked.select("text", F.inline(of.with_sources(F.col("text"), F.col("m")))).toDF("whole", "text", "start", "source").collect()
    assert len(found) >= 3
    for r in found:
        assert r.source == TEXT[r.start : r.start + len(r.text)]


def test_mentions_are_cut_from_the_sentence(spark, tmp_path):
    spark.createDataFrame([(1, TEXT, "en"), (2, None, "en"), (3, "", None)], "doc_id long, text string, lang string").write.parquet(
        f"{tmp_path}/documents.parquet"
    )
    assert "text" not in q_chain.placed_sentences(spark, str(tmp_path)).columns
    lemmas = q_chain.chain_lemmas(spark, str(tmp_path)).collect()
    assert lemmas and all(r.mention == TEXT[r.start : r.start + r.length] for r in lemmas)
    triples = q_chain.chain_triples(spark, str(tmp_path)).collect()
    assert triples
    for r in triples:
        for part in ("subject", "predicate", "object"):
            start, length = r[f"{part}_start"], r[f"{part}_length"]
            assert r[f"{part}_mention"] == TEXT[start : start + length]
