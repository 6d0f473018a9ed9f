"""Helpers of the registered queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from innsight.sources.catalog import Catalog, open_catalog

# Parameters shared by both spellings.
START, END = "1995-01-01", "2001-12-31"
AS_OF = "2001-08-02"
ENGAGEMENT_AS_OF = "2000-01-30"


def portable(df: DataFrame) -> DataFrame:
    """Result columns in the few types both engines print alike."""
    out = []
    for field in df.schema.fields:
        kind = field.dataType.typeName()
        column = F.col(f"`{field.name}`")
        if kind in ("decimal", "float"):
            column = column.cast("double")
        elif kind in ("integer", "short", "byte"):
            column = column.cast("long")
        elif kind in ("timestamp", "timestamp_ntz"):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss")
        out.append(column.alias(field.name))
    return df.select(*out)


Query = Callable[[Catalog], DataFrame]


def runnable(query: Query) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return portable(query(open_catalog(spark, sf_dir)))

    return run
