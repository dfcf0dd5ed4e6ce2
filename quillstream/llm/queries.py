"""The operators as named queries over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillstream.llm import (
    cross_polytope, divergence, line_dedup, mixing, ngram_join, quality, secrets, token_counts, topk, toxicity, unigram,
    vector_codes, warc,
)
from quillstream.llm.common import read


def tokenizer(name: str) -> str:
    """Path of a public vocabulary file, where the package that describes them lies."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_sentencepiece(spark, sf_dir) -> DataFrame:
    return unigram.digest(read(spark, sf_dir, "documents"), tokenizer("piece_bpe_32k.model"))


def op2_secrets(spark, sf_dir) -> DataFrame:
    return secrets.find_secrets(read(spark, sf_dir, "documents"))


def op3_ngram_join(spark, sf_dir) -> DataFrame:
    return ngram_join.near_duplicates(read(spark, sf_dir, "documents"))


def op4_quality(spark, sf_dir) -> DataFrame:
    return quality.score_quality(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op5_warc(spark, sf_dir) -> DataFrame:
    return warc.derivatives(read(spark, sf_dir, "pages"))


def op6_token_counts(spark, sf_dir) -> DataFrame:
    return token_counts.count_tokens(read(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"))


def op7_topk(spark, sf_dir) -> DataFrame:
    return topk.top_k(read(spark, sf_dir, "embeddings")).select(
        F.col("query_id").cast("bigint").alias("query_id"), "rank", "vec_id", "score")


def op8_cross_polytope(spark, sf_dir) -> DataFrame:
    return cross_polytope.nearest(read(spark, sf_dir, "embeddings"))


def op9_toxicity(spark, sf_dir) -> DataFrame:
    return toxicity.score_toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op10_mixing(spark, sf_dir) -> DataFrame:
    return mixing.mix(read(spark, sf_dir, "documents")).drop("times")


def op11_line_dedup(spark, sf_dir) -> DataFrame:
    return line_dedup.digest(read(spark, sf_dir, "documents"))


def op12_vector_codes(spark, sf_dir) -> DataFrame:
    return vector_codes.digest(read(spark, sf_dir, "embeddings"))


def op13_source_divergence(spark, sf_dir) -> DataFrame:
    return divergence.audit(read(spark, sf_dir, "documents"))


def pipeline(spark, sf_dir) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (
    op1_sentencepiece, op2_secrets, op3_ngram_join, op4_quality, op5_warc, op6_token_counts, op7_topk,
    op8_cross_polytope, op9_toxicity, op10_mixing, op11_line_dedup,
    op12_vector_codes, op13_source_divergence, pipeline)}
