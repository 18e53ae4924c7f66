"""The registered queries of this subpackage: thin calls of its operators over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textkg.llm import ann, bpe, chat, ctw, divergence, fim, langid, ngram_join, packing, quality, spotsigs, suffix_dedup, toxicity
from textkg.llm.common import table

VOCABULARY = "word_bpe_49k.json"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def vocabulary_path() -> str:
    """The vocabulary file of the public tokenizer, which every executor has installed."""
    import public_tokenizers

    return str(public_tokenizers.path(VOCABULARY))


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


@query("op1_quality_rules", quality.rules_sql())
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.apply_rules(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


@query("op2_bpe_round_trip")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_digests(table(spark, sf_dir, "documents"), vocabulary_path())


@query("op6_packing")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), vocabulary_path())


@query("op10_chat_format", chat.DIGEST_SQL)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = [(-1, 0, "user", chat.PROBE), (-1, 1, "assistant", chat.PROBE)]
    probe = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    return chat.conversation_digests(table(spark, sf_dir, "conversations").select(probe.columns).unionByName(probe))


@query("op4_context_tree")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ctw.score_documents(table(spark, sf_dir, "documents"))


@query("op5_toxicity")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op8_language_id")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify_languages(table(spark, sf_dir, "documents"))


@query("op7_nearest_vectors")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest_neighbours(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


@query("op9_suffix_dedup")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.span_digests(table(spark, sf_dir, "documents"))


@query("op3_ngram_jaccard_join")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicate_groups(table(spark, sf_dir, "documents"))


@query("op11_fill_in_middle", fim.DIGEST_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    restored = fim.restore_texts(fim.fill_in_middle(table(spark, sf_dir, "documents")))
    digests = [F.sha2(F.col(c).cast("binary"), 256).alias(f"{c}_sha256") for c in ("output", "restored")]
    return restored.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *digests)


@query("op12_source_divergence", divergence.AUDIT_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit_sources(table(spark, sf_dir, "documents"))


@query("op13_spot_signatures")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    edited = spotsigs.with_edited(spotsigs.next_documents(table(spark, sf_dir, "documents"))).withColumns(
        {"n_chars": F.length("text").cast("bigint"), "edited_sha256": F.sha2(F.col("edited").cast("binary"), 256)}
    )
    return spotsigs.fingerprint_texts(
        edited,
        texts={"text": "fingerprint", "edited": "edited_fingerprint", "next_text": ""},
        keep=["doc_id", "n_chars", "edited_sha256"],
        pairs={"near_edited": ("text", "edited"), "near_next": ("text", "next_text")},
    )


@query("pipeline")
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline  # stands beside the package and imports this subpackage itself

    return corpus_pipeline.run(spark, sf_dir)
