"""Column-expression helpers.  All of them are built-in Spark expressions, so
they stay inside whole-stage codegen (no Python UDF on the hot path)."""

from riverbend.functions.text import clean_long_tokens, head_before, letter_count, top_k_text
from riverbend.functions.hashing import hash_key, hashdiff
from riverbend.functions.scores import band, binary_label, positive_probability
from riverbend.functions.time import epoch_seconds_to_ts

__all__ = [
    "clean_long_tokens", "head_before", "letter_count", "top_k_text",
    "hash_key", "hashdiff",
    "band", "binary_label", "positive_probability",
    "epoch_seconds_to_ts",
]
