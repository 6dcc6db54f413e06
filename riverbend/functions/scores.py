"""Model-score expressions: class probability, bands, binary labels."""

from __future__ import annotations

from pyspark.ml.feature import StringIndexerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's: band edges and labels.
# A score above 0.55 is 'positive', below 0.45 'negative', else 'undefine'
# (the reference's spelling); a raw target of 4 is the positive class.
BAND_HIGH = 0.55
BAND_LOW = 0.45
BAND_POSITIVE = "positive"
BAND_NEGATIVE = "negative"
BAND_UNDEFINED = "undefine"
POSITIVE_TARGET = 4


def positive_index(model, positive: float = 1.0) -> int:
    """Place of the ``positive`` label in the probability vectors of a fitted
    pipeline: its index in the fitted label names where the pipeline indexes
    labels, else the label itself.  Raises when the model has not met it."""
    for stage in model.stages:
        if isinstance(stage, StringIndexerModel):
            names = [float(x) for x in stage.labels]
            if positive not in names:
                raise ValueError(f"label {positive:g} was not in the training rows (labels: {names})")
            return names.index(positive)
    classes = next(s.numClasses for s in reversed(model.stages) if hasattr(s, "numClasses"))
    if positive >= classes:
        raise ValueError(f"label {positive:g} was not in the training rows ({classes} classes)")
    return int(positive)


def positive_probability(col: Column | str = "probability", index: int = 1) -> Column:
    """Element ``index`` (see ``positive_index``) of an ML probability vector, without a UDF."""
    c = F.col(col) if isinstance(col, str) else col
    return vector_to_array(c).getItem(index)


def band(col: Column | str, high: float = BAND_HIGH, low: float = BAND_LOW) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return (F.when(c > F.lit(high), BAND_POSITIVE)
             .when(c < F.lit(low), BAND_NEGATIVE)
             .otherwise(BAND_UNDEFINED))


def binary_label(col: Column | str, positive=POSITIVE_TARGET) -> Column:
    """1 when ``col`` equals the positive target, else 0 (null -> 0)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.when(c == F.lit(positive), 1).otherwise(0)
