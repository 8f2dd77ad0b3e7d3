"""The operators as registered queries over the given tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm import (
    conversations,
    cutting_stock,
    interpolation,
    kneser_ney,
    langid,
    line_dedup,
    mixing,
    prefix_hash,
    risk_rules,
    simhash,
    token_store,
    toxicity,
    whitening,
)
from tickloom.llm.texts import table
from tickloom.session import prepare, scratch_path

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

#: Share of tokens that each domain is to have.
WEIGHTS = {"en": 0.4, "de": 0.2, "fr": 0.2, "es": 0.2}


def tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(prepare(spark), sf_dir)

    QUERIES[fn.__name__] = run
    return fn


def domains(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, domain: the language of labelled good documents (the first by name if rows differ), `junk` for the others."""
    lang = docs.groupBy("doc_id").agg(F.min("lang").alias("lang"))
    domain = F.when(F.col("quality") == 1, F.col("lang")).when(F.col("quality") == 0, F.lit("junk"))
    return labels.select("doc_id", "quality").distinct().join(lang, "doc_id").select("doc_id", domain.alias("domain"))


@query
def op1_toxicity(spark, sf_dir):
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op2_mixing(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return mixing.rates(docs, domains(docs, table(spark, sf_dir, "labels")), WEIGHTS)


@query
def op3_prefix_fingerprints(spark, sf_dir):
    return prefix_hash.next_document_fingerprints(table(spark, sf_dir, "documents"))


@query
def op4_language(spark, sf_dir):
    return langid.identify(table(spark, sf_dir, "documents"))


@query
def op5_simhash(spark, sf_dir):
    return simhash.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


@query
def op6_token_store(spark, sf_dir):
    path = scratch_path(spark, "token-store")
    token_store.write_store(table(spark, sf_dir, "documents"), tokenizer(), path)
    found = token_store.read_store(spark, path)
    return found.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query
def op7_risk_rules(spark, sf_dir):
    judged = risk_rules.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


@query
def op8_line_dedup(spark, sf_dir):
    found = line_dedup.without_repeats(table(spark, sf_dir, "documents"))
    spans = F.transform("removed", lambda s: F.concat_ws(":", s["start"].cast("string"), s["end"].cast("string")))
    return found.select("doc_id", "text", F.size("removed").alias("n_removed"), F.array_join(spans, " ").alias("removed_spans"))


@query
def op9_kneser_ney(spark, sf_dir):
    judged = kneser_ney.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "n_symbols", "perplexity", "kept")


@query
def op10_cutting_stock(spark, sf_dir):
    return cutting_stock.pack(table(spark, sf_dir, "documents"), tokenizer())


@query
def op11_deleted_interpolation(spark, sf_dir):
    return interpolation.score(table(spark, sf_dir, "documents"))


@query
def op12_whitening(spark, sf_dir):
    return whitening.components_of_rows(whitening.whiten(table(spark, sf_dir, "embeddings")))


@query
def op13_conversations(spark, sf_dir):
    return conversations.repaired_after_damage(table(spark, sf_dir, "conversations"))


@query
def pipeline(spark, sf_dir):
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)
