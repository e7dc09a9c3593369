"""Sessions with the settings that the engine's plans assume."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.executorEnv.OMP_NUM_THREADS": "1",  # numpy kernels run one task a core
}


def session(app: str = "skyquilt", **settings: str) -> SparkSession:
    """A session on the configured master; settings override SETTINGS."""
    return SparkSession.builder.appName(app).config(map=SETTINGS | settings).getOrCreate()
