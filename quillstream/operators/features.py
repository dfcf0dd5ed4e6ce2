"""TF-IDF features, class weights and the train/test split."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.feature import IDF, HashingTF, Tokenizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillstream.functions.keys import hash_bucket
from quillstream.operators.layout import dealt
from quillstream.operators.sizes import MAX_ROWS, join_by_word, stored

# Fixed value: default width of the hashed term space.
NUM_FEATURES = 262_144


def tokenizer(input_col: str = "tweet") -> Tokenizer:
    return Tokenizer(inputCol=input_col, outputCol="words")


def hashing_tf(num_features: int = NUM_FEATURES) -> HashingTF:
    return HashingTF(inputCol="words", outputCol="rawFeatures", numFeatures=num_features)


def idf() -> IDF:
    return IDF(inputCol="rawFeatures", outputCol="features")


def term_counts(df: DataFrame, num_features: int = NUM_FEATURES) -> DataFrame:
    """Adds ``words`` and hashed ``rawFeatures`` from cleaned ``tweet``."""
    return hashing_tf(num_features).transform(tokenizer().transform(df))


def bucket_values(df: DataFrame, vector: str, *keep: str) -> DataFrame:
    """One row (``keep``, ``bucket``, ``value``) per stored entry of a sparse vector column.

    Sums per bucket then merge inside each task and are shuffled by bucket, where a sum of
    whole vectors would send buffers as wide as the term space to one reducer.
    """
    entries = F.unwrap_udt(vector)
    pairs = F.arrays_zip(entries["indices"].alias("bucket"), entries["values"].alias("value"))
    return df.select(*keep, F.inline(pairs).alias("bucket", "value"))


def bucket_totals(df: DataFrame, vector: str) -> DataFrame:
    """Sum of the values and number of documents of every bucket."""
    return bucket_values(df, vector).groupBy("bucket").agg(
        F.sum("value").alias("total"), F.count(F.lit(1)).alias("doc_freq"))


def fit_features(df: DataFrame, num_features: int = NUM_FEATURES) -> PipelineModel:
    """Tokenizer, hashed counts and fitted document frequencies as one model."""
    model = idf().fit(term_counts(df, num_features))
    return PipelineModel([tokenizer(), hashing_tf(num_features), model])


def _with_idf(doc_freq: DataFrame, df: DataFrame) -> DataFrame:
    n_docs = df.agg(F.count(F.lit(1))).scalar()
    return doc_freq.withColumn("idf", F.log((n_docs + 1.0) / (F.col("doc_freq") + 1.0)))


def document_frequency(df: DataFrame, tokens: Column) -> DataFrame:
    """Number of rows holding each word, with ``ln((m+1)/(df+1))`` as ``idf``.

    One input row is one document, so repeats are removed inside the row and no
    distinct over (document, word) pairs is shuffled.
    """
    words = df.select(F.explode(F.array_distinct(tokens)).alias("word"))
    return _with_idf(words.groupBy("word").agg(F.count(F.lit(1)).alias("doc_freq")), df)


def tfidf_terms(df: DataFrame, tokens: Column, id_col: str = "id",
                max_broadcast: int = MAX_ROWS) -> DataFrame:
    """Exact (unhashed) TF-IDF weight per document and word.

    Rows are placed by id before their text is exploded: the text crosses the
    network once, in its smallest form, in as many partitions as its size needs, and
    the count per document and word then needs no further shuffle.  The counts are stored, since cleaning is the
    dear part, and document frequencies are taken from them.
    """
    counts = stored(
        dealt(df, id_col)
        .select(id_col, F.explode(tokens).alias("word"))
        .groupBy(id_col, "word")
        .agg(F.count(F.lit(1)).alias("tf")),
        "terms",
    )
    doc_freq = counts.groupBy("word").agg(F.count(F.lit(1)).alias("doc_freq"))
    words = stored(_with_idf(doc_freq, df), "words")
    return join_by_word(counts, words, "word", "doc_freq", max_broadcast).select(
        id_col, "word", "tf", (F.col("tf") * F.col("idf")).alias("tfidf")
    )


def hate_ratio(df: DataFrame, label: str = "label") -> Column:
    """Share of rows labelled 1, as a scalar subquery (null labels count as rows)."""
    return df.agg(
        F.avg(F.when(F.col(label) == 1, 1.0).otherwise(0.0))
    ).scalar()


def class_weights(df: DataFrame, label: str = "label", over: DataFrame | None = None) -> DataFrame:
    """Adds ``weight`` (rarer class heavier) and constant ``no_weight``.

    ``over`` names the rows the ratio is taken from when it is not ``df`` itself.
    """
    ratio = hate_ratio(df if over is None else over, label)
    return df.withColumn(
        "weight", F.when(F.col(label) == 1, 1.0 - ratio).otherwise(ratio)
    ).withColumn("no_weight", F.lit(1.0))


def is_train(key: Column) -> Column:
    """True for the 80 % of ids that train; stable under any partitioning."""
    return hash_bucket(key, 10) < 8


def split(df: DataFrame, id_col: str = "id") -> tuple[DataFrame, DataFrame]:
    """Disjoint, complete train and test parts decided by id alone."""
    flag = is_train(F.col(id_col))
    return df.filter(flag), df.filter(~flag)
