"""Rule-driven data quality: keep, quarantine, explain, count.

A rule passes only when its predicate is TRUE. FALSE and NULL both fail, so the
kept rows and the quarantined rows always add up to the input.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CRITICAL, WARNING = "critical", "warning"

RULE_SCHEMA = T.StructType(
    [
        T.StructField("table_name", T.StringType(), False),
        T.StructField("rule_name", T.StringType(), False),
        T.StructField("constraint_sql", T.StringType(), False),
        T.StructField("severity", T.StringType(), False),
        T.StructField("description", T.StringType(), False),
    ]
)


@dataclass(frozen=True)
class Rule:
    table: str
    name: str
    sql: str
    severity: str = CRITICAL
    note: str = ""

    def passes(self) -> Column:
        return F.coalesce(F.expr(self.sql), F.lit(False))


def rules_frame(spark: SparkSession, rules: Sequence[Rule]) -> DataFrame:
    return spark.createDataFrame([(r.table, r.name, r.sql, r.severity, r.note) for r in rules], RULE_SCHEMA)


def load_rules(rules: DataFrame, table: str, severity: str | None = None) -> list[Rule]:
    """Rules of one table from a rule table (configuration, a few dozen rows)."""
    wanted = rules.where(F.col("table_name") == table)
    if severity:
        wanted = wanted.where(F.col("severity") == severity)
    return [Rule(*row) for row in wanted.select(*RULE_SCHEMA.names).collect()]


def critical(rules: Iterable[Rule]) -> list[Rule]:
    return [r for r in rules if r.severity == CRITICAL]


def warnings(rules: Iterable[Rule]) -> list[Rule]:
    return [r for r in rules if r.severity == WARNING]


def all_pass(rules: Iterable[Rule]) -> Column:
    return reduce(lambda a, b: a & b, [r.passes() for r in rules], F.lit(True))


def quarantine_condition(rules: Iterable[Rule]) -> Column:
    """True when at least one critical rule fails; false when there are none."""
    return ~all_pass(critical(rules))


def keep_valid(df: DataFrame, rules: Iterable[Rule]) -> DataFrame:
    return df.where(all_pass(critical(rules)))


def quarantine(df: DataFrame, rules: Iterable[Rule], reasons: Sequence[tuple[str, str]], fallback: str) -> DataFrame:
    """Failing rows with the first matching reason of an ordered (predicate, text) list."""
    reason = reduce(
        lambda chain, item: chain.when(F.expr(item[0]), item[1]),
        reasons[1:],
        F.when(F.expr(reasons[0][0]), reasons[0][1]),
    ).otherwise(fallback)
    return df.where(quarantine_condition(rules)).withColumn("quarantine_reason", reason)


def split(df: DataFrame, rules: Iterable[Rule]) -> tuple[DataFrame, DataFrame]:
    rules = list(rules)
    return keep_valid(df, rules), df.where(quarantine_condition(rules))


def violation_columns(rules: Iterable[Rule]) -> list[Column]:
    """One counter per rule, for ``observe`` (batch or stream) or a plain aggregate."""
    return [F.coalesce(F.sum((~r.passes()).cast("long")), F.lit(0)).alias(r.name) for r in rules]


def observe_warnings(df: DataFrame, name, rules: Iterable[Rule]) -> DataFrame:
    """Count violations while rows flow through; no row is removed.

    ``name`` is an observation name (streams) or an ``Observation`` (batch).
    """
    return df.observe(name, F.count(F.lit(1)).alias("rows_seen"), *violation_columns(rules))


def violation_report(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Violations per rule in one pass: one wide aggregate turned into rows."""
    wide = df.agg(F.count(F.lit(1)).alias("row_count"), *violation_columns(rules))
    entries = F.array(
        *[F.struct(F.lit(r.name).alias("rule_name"), F.lit(r.severity).alias("severity"),
                   F.col(r.name).alias("violations")) for r in rules]
    )
    return wide.select("row_count", F.inline(entries))


# --- row diagnostics from metadata checks -------------------------------------------

_CHECK_FUNCTIONS = {
    "is_not_null": lambda c, a: c.isNotNull(),
    "is_not_null_and_not_empty": lambda c, a: c.isNotNull() & (F.length(c.cast("string")) > 0),
    "is_greater_than": lambda c, a: c > F.lit(a["value"]),
    "is_greater_than_or_equal_to": lambda c, a: c >= F.lit(a["value"]),
    "is_less_than_or_equal_to": lambda c, a: c <= F.lit(a["value"]),
    "is_between": lambda c, a: c.between(F.lit(a["min_value"]), F.lit(a["max_value"])),
    "is_in": lambda c, a: c.isin(*a["values"]),
}


def diagnose(df: DataFrame, checks: Sequence[dict]) -> DataFrame:
    """Add ``_failures``: every failed check of the row with its criticality."""
    entries = []
    for check in checks:
        spec = check["check"]
        args = spec["arguments"]
        ok = F.coalesce(_CHECK_FUNCTIONS[spec["function"]](F.col(args["column"]), args), F.lit(False))
        entries.append(
            F.when(
                ~ok,
                F.struct(
                    F.lit(check["name"]).alias("check_name"),
                    F.lit(check["criticality"]).alias("criticality"),
                    F.lit(args["column"]).alias("column_name"),
                ),
            )
        )
    return df.withColumn("_failures", F.array_compact(F.array(*entries)))


def split_diagnosed(diagnosed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows without an ``error`` failure (warnings stay attached), and the rest."""
    failed = F.exists("_failures", lambda f: f["criticality"] == "error")
    return diagnosed.where(~failed), diagnosed.where(failed)
