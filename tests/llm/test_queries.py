"""Queries with SQL give its rows; the others are compared with the tokenizers' libraries."""

import public_tokenizers
import pytest
from oracle_check import connect, differences
from tokenizers import Tokenizer

from quillstream.llm.queries import QUERIES
from quillstream.llm.sql import ORACLE


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_equals_sql(spark, sf_dir, name):
    got = QUERIES[name](spark, sf_dir).toPandas()
    assert differences(got, connect(sf_dir).execute(ORACLE[name]).df()) is None


def test_token_counts_equal_the_library(spark, sf_dir):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").toPandas()
    wanted = {i: len(e.ids) for i, e in zip(docs["doc_id"], library.encode_batch(list(docs["text"]), add_special_tokens=False))}
    got = QUERIES["op6_token_counts"](spark, sf_dir).toPandas()
    assert dict(zip(got["doc_id"], got["n_tokens"])) == wanted
    assert (got["over_limit"] == (got["n_tokens"] > 1024)).all()


def test_pieces_restore_every_text(spark, sf_dir):
    got = QUERIES["op1_sentencepiece"](spark, sf_dir).toPandas()
    assert got["restored"].all() and (got["n_pieces"] > 0).all()
