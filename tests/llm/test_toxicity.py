"""The training sample is bounded in rows, whatever ids repeat."""

from pyspark.sql import functions as F

from quillstream.llm import toxicity


def test_repeated_ids_give_one_training_row(spark):
    ids = spark.range(50).withColumnRenamed("id", "doc_id")
    labels = ids.withColumn("toxic", (F.col("doc_id") % 2).cast("int"))
    docs = ids.union(spark.range(500).select(F.lit(3).cast("bigint"))).withColumn(
        "text", F.concat(F.lit("text "), F.monotonically_increasing_id().cast("string")))
    assert docs.filter(~toxicity.held_out() & (F.col("doc_id") == 3)).count() == 501
    learned = ids.filter(~toxicity.held_out()).count()
    rows = toxicity.training_rows(docs, labels, "toxic").collect()
    assert len(rows) == learned
    assert sorted(map(str, rows)) == sorted(map(str, toxicity.training_rows(docs.repartition(5), labels, "toxic").collect()))
    assert len(toxicity.training_rows(docs, labels, "toxic", 10).collect()) == 10


def test_conflicting_labels_and_long_texts_are_defined(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "TRAIN_BYTES", 100)
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(1, 40)] + [(50, "x" * 101), (51, None)], "doc_id bigint, text string")
    pairs = [(i, i % 2) for i in range(1, 40)] + [(2, 1), (3, 0), (50, 1), (51, 1)]
    rows = []
    for order in (pairs, pairs[::-1]):
        labels = spark.createDataFrame(order, "doc_id bigint, toxic int").coalesce(1)
        rows.append(sorted(map(str, toxicity.training_rows(docs, labels, "toxic").collect())))
    assert rows[0] == rows[1]
    kept = {r.text: r.label for r in toxicity.training_rows(docs, labels, "toxic").collect()}
    assert "x" * 101 not in kept and all(kept.get(f"text {i}", 1) == 1 for i in (2, 3))
