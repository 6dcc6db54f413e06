"""Epoch conversions.  Wall-clock (``timestamp_ntz``) inputs are read as UTC:
the library's sessions run with ``spark.sql.session.timeZone=UTC``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def epoch_seconds_to_ts(col: Column | str) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return c.cast("long").cast("timestamp")
