"""riverbend: PySpark-native analytics toolkit.

Every operator is a function from DataFrame(s) to a DataFrame built on the
public DataFrame / SQL / Structured Streaming / ``pyspark.ml`` APIs, so it
works on batch and streaming inputs alike and leaves physical planning to
Catalyst and AQE.
"""

from riverbend.session import build_session, scratch_path

__all__ = ["build_session", "scratch_path"]
