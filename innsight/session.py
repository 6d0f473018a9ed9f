"""Session settings the library is tuned for."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(app: str = "innsight", master: str | None = None, **conf: str) -> SparkSession:
    """Return a session with adaptive execution and UTC dates.

    Shuffle partition counts are left to the caller: on a cluster start high and
    let adaptive execution coalesce, on a laptop pass a small number.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
