"""Hash keys and row-change hashes of a hub/satellite model."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def hash_key(col: Column | str) -> Column:
    """MD5 hex of the business key's text."""
    c = F.col(col) if isinstance(col, str) else col
    return F.md5(c.cast("string"))


def hashdiff(parts: Sequence[tuple[str, str, object]]) -> Column:
    """MD5 of the concatenated texts of typed, defaulted values.

    ``parts`` holds ``(column, spark_type, default)``; each value is cast to
    the type, a null replaced by the default (in that type), and the texts
    are joined with no delimiter, as the reference does (so ``1||23``
    equals ``12||3``; kept for hash compatibility).
    """
    texts = []
    for name, dtype, default in parts:
        typed = F.col(name).cast(dtype)
        texts.append(F.coalesce(typed, F.lit(default).cast(dtype)).cast("string"))
    return F.md5(F.concat(*texts))
