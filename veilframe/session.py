"""The session that the engine expects: UTC, adaptive execution, dynamic partition overwrite, key material redacted."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.redaction.string.regex": r"(?i)\b(key|secret|hmac)\w*\s*[=:]\s*\S+",
    "spark.ui.enabled": "false",
}


def build(master: str | None = None, app: str = "veilframe", **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    return builder.config(map={**SETTINGS, **settings}).getOrCreate()
