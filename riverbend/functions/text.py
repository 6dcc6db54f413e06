"""String expressions: name heads, letter cleaning, long tokens, ranked lists."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _quoted(sep: str) -> str:
    # split() takes a Java regex; quote the separator so '-', '.', '|' are literal
    return "\\Q" + sep + "\\E"


def head_before(col: Column | str, sep: str = "-") -> Column:
    """Text before the first ``sep``, trimmed: ``'LARCENY - SHOPLIFTING'`` -> ``'LARCENY'``.

    A null input gives null (the reference fails the job there); the string
    ``'-'`` gives ``''``.
    """
    c = F.col(col) if isinstance(col, str) else col
    return F.trim(F.split(c, _quoted(sep)).getItem(0))


def clean_long_tokens(col: Column | str, min_len: int = 3) -> Column:
    """Letter runs longer than ``min_len``: non-letters to spaces, split, filter, in one regex pass.

    After non-letters become spaces the tokens are exactly the maximal runs
    of ASCII letters, so the runs longer than ``min_len`` are the matches of
    ``[a-zA-Z]{min_len+1,}`` (no lambda, no intermediate string).
    """
    c = F.col(col) if isinstance(col, str) else col
    return F.regexp_extract_all(c, F.lit("[a-zA-Z]{%d,}" % (min_len + 1)), 0)


def letter_count(col: Column | str) -> Column:
    """Number of ASCII letters: the length left after dropping every run of
    non-letters (measured faster than a character map or a match count)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.length(F.regexp_replace(c, "[^a-zA-Z]+", ""))


def top_k_text(rank_col: str, item_col: str, sep: str = ", ") -> Column:
    """Aggregate expression: items of a group joined by ``sep`` in rank order.

    Use after the group was cut to its top k rows, so the list is bounded.
    """
    ordered = F.array_sort(F.collect_list(F.struct(F.col(rank_col).alias("r"),
                                                   F.col(item_col).alias("v"))))
    return F.array_join(F.transform(ordered, lambda x: x["v"]), sep)
