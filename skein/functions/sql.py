"""The scalar functions as SQL temporary functions of a session.

`register(spark)` makes `has_<script>_text(text)` and `<script>_pct(text)` callable in
`spark.sql(...)`.  Their bodies are SQL expressions, so Catalyst inlines them (no
Python is called).
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from .scalars import SCRIPT_RANGES


def definitions() -> dict[str, str]:
    """Signature and body of each function."""
    out = {}
    for script, letters in SCRIPT_RANGES.items():
        out[f"has_{script}_text(t STRING) RETURNS BOOLEAN"] = f"t RLIKE '[{letters}]'"
        out[f"{script}_pct(t STRING) RETURNS DOUBLE"] = (
            f"coalesce(try_divide(CAST(length(regexp_replace(t, '[^{letters}]', '')) AS DOUBLE), CAST(length(t) AS DOUBLE)), 0.0D)")
    return out


def register(spark: SparkSession) -> None:
    for signature, body in definitions().items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURN {body}")
