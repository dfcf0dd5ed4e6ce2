"""From model output to result rows."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from quillstream.functions.labels import class_code, name_classes, predicted_confidence

# Fixed value: scores below this confidence go to annotation.
CONFIDENCE_THRESHOLD = 0.7

RESULT_COLUMNS = ("id", "tweet", "tweet_wo_hashtag", "time_stamp")


def format_predictions(predictions: DataFrame, keep: tuple[str, ...] = RESULT_COLUMNS,
                       also_name: tuple[str, ...] = ()) -> DataFrame:
    """Class name and confidence of the predicted class beside the kept columns.

    ``also_name`` lists further 0/1 columns (a true label) to show by class name.
    """
    if isinstance(predictions.schema["probability"].dataType, ArrayType):
        probability = F.col("probability")
    else:
        probability = vector_to_array("probability")
    formatted = predictions.select(
        *keep,
        *[class_code(F.col(c)).alias(c) for c in also_name],
        class_code(F.col("prediction")).alias("prediction"),
        predicted_confidence(probability, F.col("prediction")).alias("confidence_score"),
    )
    return name_classes(formatted, *also_name, "prediction")


def low_confidence(scored: DataFrame, threshold: float = CONFIDENCE_THRESHOLD) -> DataFrame:
    """Posts to annotate.  The float32 score is compared as a double."""
    return scored.filter(F.col("confidence_score") < F.lit(threshold).cast("double")).drop(
        "confidence_score", "time_stamp", "tweet_wo_hashtag"
    )
