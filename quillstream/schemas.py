"""Explicit schemas of the tables that enter and leave the jobs."""

from pyspark.sql.types import (
    FloatType,
    IntegerType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _struct(**fields) -> StructType:
    return StructType([StructField(name, dtype, True) for name, dtype in fields.items()])


TRAIN = _struct(id=StringType(), tweet=StringType(), label=IntegerType())
TEST = _struct(id=StringType(), tweet=StringType())

# Message body on the queue.  ``id`` is optional: older producers never sent it.
MESSAGE = _struct(id=StringType(), text=StringType(), source=StringType(),
                  created_at=StringType())

POSTS = _struct(id=StringType(), tweet=StringType(), time_stamp=StringType())

SCORED = _struct(id=StringType(), tweet=StringType(), tweet_wo_hashtag=StringType(),
                 time_stamp=StringType(), prediction=StringType(),
                 confidence_score=FloatType())

CLEAN_TABLE = _struct(id=StringType(), tweet=StringType(), tweet_wo_hashtag=StringType(),
                      time_stamp=TimestampType(), prediction=StringType(),
                      confidence_score=FloatType())

WORD_TABLE = _struct(word=StringType(), time=StringType(), prediction=StringType())

FAILED_TABLE = _struct(id=StringType(), tweet=StringType(), raw_tweet=StringType(),
                       prediction=StringType())

# Documents table of the test data, needed as an explicit schema by stream readers.
DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
