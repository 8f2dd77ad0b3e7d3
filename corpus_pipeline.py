"""A training corpus from the documents table, in five stages.

Each stage takes (spark, docs, sf_dir), where docs are the rows that the stage before kept, and
returns the columns of `documents`; the last returns the pieces of the packed sequences.

Cases, the same in all stages: a null text is the empty text, and stays null where a stage only selects;
a null doc_id is a document like others, ranked last by substring dedup; rows that repeat are one document
in near-dedup and as many elsewhere; columns beside doc_id and text are passed on, whatever their names;
an empty table gives an empty table. Without labels no document is toxic and every rate is 1.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm import cutting_stock, line_dedup, mixing, queries, simhash, toxicity
from tickloom.llm.texts import free_name, saved, table, text_key
from tickloom.session import prepare


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity score does not reject; labels outside its held-out fold teach it."""
    labels = toxicity.outside(table(prepare(spark), sf_dir, "labels"), 5, 0)
    value = toxicity.learned(docs, labels)(F.col("text"))
    score = free_name(docs, "toxicity")
    return docs.withColumn(score, value).where(F.col(score) < 0.5).drop(score)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each near-duplicate group the document of smallest doc_id; of its repeated rows one."""
    prepare(spark)
    found = simhash.near_duplicates(docs)
    same = F.col("doc_id").eqNullSafe(F.col("component_id"))
    first = found.where(same).groupBy("component_id").agg(F.min("text_key").alias("text_key"))
    doc, key = free_name(docs, "kept_doc"), free_name(docs, "kept_text")
    first = first.select(F.col("component_id").alias(doc), F.col("text_key").alias(key))
    matches = docs["doc_id"].eqNullSafe(first[doc]) & (text_key(docs["text"]) == first[key])
    # by doc_id too: different texts whose keys agree are no repeated rows
    return docs.join(first, matches).dropDuplicates([doc, key]).drop(doc, key)


def remove_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of 50 words that an earlier document, or an earlier place, already has."""
    prepare(spark)
    names = docs.columns
    cut = line_dedup.without_repeats(docs).select(*[f"`{n}`" for n in names])
    return cut.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in names else cut


def mix_domains(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows repeated so that the domains' expected tokens meet op2's weights; every row stays at least once.

    Junk has no weight, but as no row may go, it keeps what it has.
    """
    labels = queries.domains(docs, table(prepare(spark), sf_dir, "labels"))
    return mixing.mixed(docs, labels, queries.WEIGHTS, lowest=1.0)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, copies included, and their places in sequences of 2048 tokens."""
    prepare(spark)
    return cutting_stock.pack(docs, queries.tokenizer())


STAGES = [
    ("toxicity", remove_toxic),
    ("simhash near-dedup", one_of_each_group),
    ("substring dedup", remove_repeats),
    ("mixing", mix_domains),
    ("packing", pack_sequences),
]

#: The stages learn models and solve a linear program; SQL cannot express that.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(prepare(spark), sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
