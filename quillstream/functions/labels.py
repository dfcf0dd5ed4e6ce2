"""Class names and confidence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Class names by label.
CLASS_NAMES = {"0": "not_hate", "1": "hate"}


def class_code(value: Column) -> Column:
    """``1.0`` -> ``"1"``."""
    return value.cast("int").cast("string")


def name_classes(df: DataFrame, *columns: str) -> DataFrame:
    """Replace class codes by class names in string columns; other values pass."""
    return df.replace(CLASS_NAMES, subset=list(columns))


def class_label(name: Column) -> Column:
    """Class name back to 0/1."""
    return F.when(name == CLASS_NAMES["1"], 1).when(name == CLASS_NAMES["0"], 0)


def predicted_confidence(probability: Column, prediction: Column) -> Column:
    """Probability of the predicted class as float32."""
    return F.get(probability, prediction.cast("int")).cast("float")
