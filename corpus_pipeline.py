"""Corpus pipeline: from raw documents to token ids, stage by stage.

Each stage reads all that the one before it kept and returns the columns of ``documents``;
the last adds the token ids.  ``run`` writes every stage's result to the shared folder and
reads it again, so a lost executor repeats at most one stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstream.llm import mixing, ngram_join, secrets, toxicity, unigram
from quillstream.llm.common import Written, read, set_aside, small_or_shuffled
from quillstream.llm.queries import tokenizer


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not scored as toxic."""
    return toxicity.keep_clean(docs, read(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group: the one with the smallest id, rows without an id last.

    Documents are told apart by id and text, so repeated ids with other texts are others.
    """
    key = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", F.xxhash64("text").alias("text_hash"))
    apart, back = set_aside(docs, "doc_id", "text")
    keyed = apart.withColumn("_key", key)
    found = ngram_join.near_duplicates(keyed, "_key")
    chosen = Written(found.filter(F.col("_key") == F.col("component_id")).groupBy("_key").agg(
        F.max(F.col("n_links") > 0).alias("_many")), "chosen").df
    kept = keyed.join(small_or_shuffled(chosen), "_key")
    # Only groups can hold repeated rows of the chosen document.
    one = kept.filter("_many").dropDuplicates(["_key"])
    return kept.filter("not _many").unionByName(one).select(*back)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; every document stays."""
    return secrets.redact(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    return mixing.mixed(docs)


def sentence_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with the token ids of their text."""
    return unigram.encode(docs, tokenizer("piece_bpe_32k.model"))


STAGES = [
    ("toxicity", toxic),
    ("n-gram Jaccard join", near_duplicates),
    ("secret scans", secret_scan),
    ("mixing sources", source_mix),
    ("sentencepiece", sentence_pieces),
]

# Trees and segmentation have no SQL form; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = Written(stage(spark, docs, sf_dir), name.replace(" ", "-")).df
    return docs
