"""Library expressions callable from SQL text."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Each body is expanded by the analyzer into plain expressions, so SQL callers stay in codegen.
_BODIES = {
    "add_counts(a BIGINT, b BIGINT) RETURNS BIGINT": "coalesce(a, 0L) + coalesce(b, 0L)",
    "float_ratio(a BIGINT, b BIGINT) RETURNS FLOAT": (
        "cast(cast(a AS FLOAT) * cast(1 AS FLOAT) / "
        "nullif(cast(b AS FLOAT) * cast(1 AS FLOAT), cast(0 AS FLOAT)) AS FLOAT)"
    ),
}


def register_sql_functions(spark: SparkSession) -> None:
    """Create the temporary SQL functions ``add_counts`` and ``float_ratio``."""
    for signature, body in _BODIES.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURN {body}")
