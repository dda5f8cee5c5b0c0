"""tessera — change-data and data-quality operators on plain PySpark.

Every operator is a DataFrame -> DataFrame function built from Catalyst
expressions (no Python UDF on any hot path).  Streaming drivers wrap the same
functions in Structured Streaming queries.
"""

from tessera.session import get_spark, scratch_path

__all__ = ["get_spark", "scratch_path"]
