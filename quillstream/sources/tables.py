"""Result tables and the model store."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstream import schemas

CLEAN = "clean_tweets"
WORDS = "processed_tweets"
FAILED = "failed_tweets"
QUARANTINE = "quarantine"
SCHEMAS = {CLEAN: schemas.CLEAN_TABLE, FAILED: schemas.FAILED_TABLE}


def write_batch(df: DataFrame, root: str, table: str, batch_id: int) -> None:
    """Write one batch of a table, replacing an earlier attempt at the same batch.

    The batch id is part of the path, so a replay after a failure overwrites its
    own files and never adds rows twice.
    """
    df.write.mode("overwrite").parquet(f"{root}/{table}/batch={batch_id}")


def read_table(spark: SparkSession, root: str, table: str) -> DataFrame:
    """All batches of a table, without the batch number."""
    reader = spark.read
    if table in SCHEMAS:
        # A schema given once saves reading file footers on every call.
        reader = reader.schema(SCHEMAS[table])
    return reader.parquet(f"{root}/{table}").drop("batch")


class ModelStore:
    """Versioned pipeline models under one folder.

    A model is saved to a new folder first and then listed in an append-only
    log, so a reader never meets a half-written model and older versions stay
    available.  One writer at a time.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def _log(self) -> str:
        return f"{self.root}/log"

    def latest(self) -> int | None:
        """Number of the newest complete version."""
        try:
            log = self.spark.read.schema("version int").parquet(self._log())
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return None
            raise
        return log.agg(F.max("version")).first()[0]

    def path(self, version: int) -> str:
        return f"{self.root}/v{version:06d}"

    def save(self, model: PipelineModel) -> int:
        version = (self.latest() or 0) + 1
        model.write().overwrite().save(self.path(version))
        self.spark.range(1).select(F.lit(version).alias("version")).write.mode("append").parquet(
            self._log()
        )
        return version

    def load(self, version: int | None = None) -> PipelineModel:
        version = version or self.latest()
        if version is None:
            raise FileNotFoundError(f"no model in {self.root}")
        return PipelineModel.load(self.path(version))
