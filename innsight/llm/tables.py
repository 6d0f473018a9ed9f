"""Intermediate tables of the operators, as the tasks leave them.

Their tasks are even already, so they are written without another shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from innsight.sources.storage import scratch_path


def stored_at(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored(df: DataFrame, label: str) -> DataFrame:
    """Cut the lineage with a table in the shared folder; it outlives executors."""
    return stored_at(df, scratch_path(df.sparkSession, label))
