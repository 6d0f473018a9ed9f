"""Keyed-table operators: newest row, surrogate key, upsert, grain and reference checks, schema conformance."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def dedup_latest(df: DataFrame, keys: Sequence[str], newest_first: Sequence[Column]) -> DataFrame:
    """Newest row per key.

    ``newest_first`` must be a total order for the answer to be repeatable. The
    ``row_number <= 1`` filter lets Spark cut every key to one row per input task
    before the shuffle, so a hot key costs no more than any other.
    """
    order = Window.partitionBy(*keys).orderBy(*newest_first)
    return df.withColumn("_rank", F.row_number().over(order)).where("_rank <= 1").drop("_rank")


def surrogate_key(*parts: str | Column) -> Column:
    columns = [F.col(p) if isinstance(p, str) else p for p in parts]
    return F.md5(F.concat_ws("||", *[c.cast("string") for c in columns]))


def upsert(
    target: DataFrame, source: DataFrame, keys: Sequence[str], update: Sequence[str] | None = None
) -> DataFrame:
    """Target after inserting new keys and updating matched ones.

    ``update`` names the columns a match overwrites (default: all). The source must
    hold one row per key. Both sides are read once, in one full outer join; rows with a
    null key match nothing.
    """
    keys = list(keys)
    columns = target.columns
    overwrite = set(columns if update is None else update) - set(keys)
    packed = lambda df, name: df.select(*keys, F.struct(*[F.col(c) for c in columns]).alias(name))
    both = packed(target, "_old").join(packed(source, "_new"), keys, "full_outer")
    known, fresh = F.col("_old").isNotNull(), F.col("_new").isNotNull()
    return both.select(*[
        F.when(fresh & ~known if c not in overwrite else fresh, F.col(f"_new.{c}")).otherwise(F.col(f"_old.{c}")).alias(c) for c in columns
    ])


def grain_report(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows, distinct keys and keys that repeat, in one aggregation pass."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"),
        F.count(F.lit(1)).alias("distinct_keys"),
        F.count_if(F.col("n") > 1).alias("duplicated_keys"),
    )


class GrainError(ValueError):
    """Raised when a table has several rows for one declared key."""


def validate_grain(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Return ``df`` unchanged, or raise with the counts when the key repeats."""
    report = grain_report(df, keys).first()
    if report.duplicated_keys:
        raise GrainError(
            f"expected one row per ({', '.join(keys)}): {report.total_rows} rows, "
            f"{report.distinct_keys} keys, {report.duplicated_keys} repeated"
        )
    return df


def orphan_count(fact: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Fact rows whose key is set but absent from the dimension."""
    per_key = fact.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return per_key.join(dim.select(key), key, "left_anti").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("orphan_rows"), F.count(F.lit(1)).alias("orphan_keys")
    )


@dataclass(frozen=True)
class Related:
    """A table of an integrity check: what its own key is called, and which key its references point to.

    ``refers``: name of a check to (column of this table, name of the key it points to).
    """

    table: DataFrame
    refers: dict[str, tuple[str, str]] = field(default_factory=dict)
    key: tuple[str, str] | None = None  # (column, name)


def orphans(tables: Sequence[Related], nulls: bool = False) -> DataFrame:
    """(check, orphan_rows, orphan_keys) of all checks, every table read once.

    Each row gives its own key and its references as (name, value) rows, merged per task; one
    grouping by (name, value) then tells which values have an owner and how many rows of each
    check point at those that have none. ``nulls``: whether a reference without a value counts.
    """
    checks = [c for t in tables for c in t.refers]
    parts = []
    for t in tables:
        rows = [F.struct(F.lit(name).alias("name"), F.col(column).alias("value"), F.lit(check).alias("check")) for check, (column, name) in t.refers.items()]
        if t.key is not None:
            rows.append(F.struct(F.lit(t.key[1]).alias("name"), F.col(t.key[0]).alias("value"), F.lit(None).cast("string").alias("check")))
        parts.append(t.table.select(F.inline(F.array(*rows))))
    # A null owns nothing.
    every = reduce(DataFrame.unionByName, parts).where(F.col("value").isNotNull() | (F.col("check").isNotNull() & F.lit(nulls)))
    found = every.groupBy("name", "value").agg(F.count_if(F.col("check").isNull()).alias("_owners"), *[F.count_if(F.col("check") == c).alias(f"_n{k}") for k, c in enumerate(checks)])
    lost = found.where("_owners = 0").agg(*[
        F.struct(F.lit(c).alias("check"), F.coalesce(F.sum(f"_n{k}"), F.lit(0)).alias("orphan_rows"), F.count_if(F.col(f"_n{k}") > 0).alias("orphan_keys")).alias(f"_r{k}")
        for k, c in enumerate(checks)])
    return lost.select(F.inline(F.array(*[F.col(f"_r{k}") for k in range(len(checks))])))


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project and cast to the declared columns, in order; missing columns become NULL."""
    have = set(df.columns)
    return df.select(
        *[
            (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name, metadata=f.metadata)
            for f in schema.fields
        ]
    )


def null_report(df: DataFrame, schema: T.StructType) -> DataFrame:
    """NULLs found in columns declared NOT NULL, one row per column."""
    required = [f.name for f in schema.fields if not f.nullable]
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in required])
    return counted.select(
        F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("null_rows")) for c in required]))
    )
