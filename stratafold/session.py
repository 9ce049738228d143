"""Session settings this library is written for.

Only settings that change a plan are listed; sizes (memory, executor counts)
belong to the cluster, as does ``spark.sql.shuffle.partitions``: set it so that a
partition holds some 256 MB; adaptive execution merges what turns out small.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

RECOMMENDED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(app_name: str, **overrides: str) -> SparkSession:
    """A session with the recommended settings; ``overrides`` win."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**RECOMMENDED, **overrides}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
