"""Message queue: encode, publish, read, decode.

The transport is a Spark source/sink format plus options, so ``kafka`` on a
cluster and JSON or text files in a test run the same code.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstream import schemas
from quillstream.functions.keys import content_id


def kafka_options(brokers: str, topic: str, user: str | None = None,
                  password: str | None = None, writing: bool = False) -> dict[str, str]:
    """Options of the ``kafka`` format with SASL/SCRAM over TLS when a user is given."""
    options = {"kafka.bootstrap.servers": brokers, ("topic" if writing else "subscribe"): topic}
    if user:
        user, password = (v.replace("\\", "\\\\").replace('"', '\\"') for v in (user, password or ""))
        module = "org.apache.kafka.common.security.scram.ScramLoginModule"
        options |= {
            "kafka.security.protocol": "SASL_SSL",
            "kafka.sasl.mechanism": "SCRAM-SHA-256",
            "kafka.sasl.jaas.config": f'{module} required username="{user}" password="{password}";',
        }
    if not writing:
        options["startingOffsets"] = "earliest"
    return options


def encode(posts: DataFrame) -> DataFrame:
    """Posts (``text``, ``source``, ``created_at``, optionally ``id``) as JSON ``value`` rows."""
    derived = content_id("text", "created_at", "source")
    ident = F.coalesce("id", derived) if "id" in posts.columns else derived
    return posts.select(
        F.to_json(F.struct(ident.alias("id"), "text", "source", "created_at")).alias("value")
    )


def publish(posts: DataFrame, fmt: str = "kafka", path: str | None = None, **options) -> None:
    """Encode and append to the queue."""
    encode(posts).write.format(fmt).options(**options).mode("append").save(path)


def read(spark: SparkSession, fmt: str = "kafka", path: str | None = None, **options) -> DataFrame:
    """Everything the queue holds now, as a batch."""
    return spark.read.format(fmt).options(**options).load(path)


def read_stream(spark: SparkSession, fmt: str = "kafka", path: str | None = None,
                max_records: int | None = None, **options) -> DataFrame:
    """The queue as a stream.

    ``max_records`` bounds one micro-batch of a Kafka read, not the run: an
    ``availableNow`` run goes on until the backlog is gone.
    """
    if max_records and fmt == "kafka":
        options["maxOffsetsPerTrigger"] = str(max_records)
    reader = spark.readStream.format(fmt).options(**options)
    if fmt == "text":
        reader = reader.schema("value string")
    return reader.load(path)


def decode(messages: DataFrame, value: str = "value") -> DataFrame:
    """Message fields; ``_bad`` holds the raw body of a message that is not valid JSON."""
    schema = schemas.MESSAGE.simpleString()[len("struct<"):-1].replace(":", " ")
    body = F.from_json(
        F.col(value).cast("string"),
        f"{schema.replace(',', ', ')}, _bad string",
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"},
    )
    return messages.select(body.alias("m"), F.col(value).cast("string").alias("_raw")).select(
        "m.id", "m.text", "m.source", "m.created_at",
        # An empty body decodes to null; it is as unusable as a broken one.
        F.when(F.col("m").isNull(), F.coalesce("_raw", F.lit(""))).otherwise(
            F.col("m._bad")).alias("_bad"),
    )


def is_usable() -> Column:
    """Decoded message with a text; others belong in quarantine."""
    return F.col("_bad").isNull() & F.col("text").isNotNull()


def to_posts(decoded: DataFrame) -> DataFrame:
    """Decoded messages as posts; a missing id is derived from the content."""
    return decoded.select(
        F.coalesce("id", content_id("text", "created_at", "source")).alias("id"),
        F.col("text").alias("tweet"),
        F.col("created_at").alias("time_stamp"),
    )


def select_recent(posts: DataFrame, end: Column, phrase: str, lang: str = "en",
                  minutes: int = 15, ts: str = "ts", text: str = "tweet") -> DataFrame:
    """Posts of the ``minutes`` before ``end`` (exclusive) in one language naming a phrase."""
    start = end - F.make_dt_interval(mins=F.lit(minutes))
    return posts.filter(
        (F.col(ts) >= start)
        & (F.col(ts) < end)
        & (F.col("lang") == lang)
        & F.lower(F.col(text)).contains(phrase.lower())
    )


def search_window_end(lag_minutes: int = 1) -> Column:
    """Upper bound of a live search: a little behind now."""
    return F.current_timestamp() - F.make_dt_interval(mins=F.lit(lag_minutes))


def cap_recent(posts: DataFrame, n: int = 35, ts: str = "ts", id_col: str = "id") -> DataFrame:
    """The ``n`` newest posts, exactly."""
    return posts.orderBy(F.desc(ts), F.asc(id_col)).limit(n)
