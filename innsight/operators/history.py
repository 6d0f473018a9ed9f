"""Versioned dimensions: apply a change batch, rebuild from a change log, check validity."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from innsight.operators.keys import dedup_latest, surrogate_key, upsert
from innsight.operators.ordered import neighbour

VERSION_COLUMNS = ("effective_from", "effective_to", "is_current")


def _state(columns: Sequence[str]) -> Column:
    """The compared attributes as one value; ``<=>`` on it takes two NULLs as equal."""
    return F.struct(*[F.col(c) for c in columns])


def initial_versions(df: DataFrame, key: str, effective_from: Column, key_name: str) -> DataFrame:
    """First load of a versioned dimension: every row open and current."""
    return df.withColumns(
        {
            "effective_from": effective_from,
            "effective_to": F.lit(None).cast(effective_from_type(df, effective_from)),
            "is_current": F.lit(True),
        }
    ).withColumn(key_name, surrogate_key(key, "effective_from"))


def effective_from_type(df: DataFrame, effective_from: Column):
    return df.select(effective_from.alias("t")).schema["t"].dataType


def scd1_upsert(dim: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Overwrite type: matched rows take every column of the batch."""
    return upsert(dim, batch, keys)


def scd2_apply(
    dim: DataFrame, batch: DataFrame, key: str, tracked: Sequence[str], key_name: str, effective_from: str
) -> DataFrame:
    """Close changed current versions and open new ones.

    ``batch`` holds one row per key with the dimension's attributes and the change
    time ``effective_from``. Unchanged keys and changes not newer than the current
    version leave the dimension as it is, so applying a batch twice changes nothing.
    Late changes go through :func:`scd2_history`. Only current versions join, always
    with the batch on the small side; closed history passes through untouched.
    """
    attributes = [c for c in dim.columns if c not in (*VERSION_COLUMNS, key_name)]
    closed = dim.where(~F.col("is_current"))
    current = dim.where("is_current")
    incoming = batch.select(
        key,
        F.struct(*[F.col(c) for c in attributes]).alias("_new"),
        F.col(effective_from).alias("_since"),
        _state(tracked).alias("_state"),
    )
    joined = current.join(incoming, key, "left").withColumn(
        "_changed",
        F.coalesce(~F.col("_state").eqNullSafe(_state(tracked)) & (F.col("_since") > F.col("effective_from")), F.lit(False)),
    )
    stay = joined.select(
        *[
            F.when(F.col("_changed"), F.col("_since")).otherwise(F.col("effective_to")).alias(c)
            if c == "effective_to"
            else (~F.col("_changed")).alias(c)
            if c == "is_current"
            else F.col(c)
            for c in dim.columns
        ]
    )
    known = current.select(key).join(incoming.select(key), key, "left_semi")
    unseen = incoming.join(known, key, "left_anti")
    opened = (
        joined.where("_changed").select("_new", "_since").unionByName(unseen.select("_new", "_since"))
        .select("_new.*", F.col("_since").alias("effective_from"))
        .withColumns({"effective_to": F.lit(None).cast(dim.schema["effective_to"].dataType), "is_current": F.lit(True)})
        .withColumn(key_name, surrogate_key(key, "effective_from"))
        .select(*dim.columns)
    )
    return closed.unionByName(stay).unionByName(opened)


def scd2_history(
    changes: DataFrame, key: str, changed_at: str, tracked: Sequence[str], tie_break: Sequence[Column], grain: str | None = None
) -> DataFrame:
    """Full version history from a change log, in any arrival order.

    The last change of a (key, time) wins, repeats of the same attributes are
    dropped, and every version ends where the next begins. A log by date holds at most one
    row per key and day, so one window per key serves both steps; a log by finer time
    takes ``grain``, and a key is then windowed period by period.
    """
    tracked = list(tracked)
    log = dedup_latest(changes, [key, changed_at], list(tie_break)).select(key, changed_at, *tracked).withColumn("_state", _state(tracked))
    if grain is None:
        along = Window.partitionBy(key).orderBy(changed_at)
        kept = log.withColumn("_before", F.lag("_state").over(along)).where(~F.col("_before").eqNullSafe(F.col("_state")))
        timed = kept.withColumn("_until", F.lead(changed_at).over(along))
    else:
        period = F.date_trunc(grain, F.col(changed_at)).cast("date")
        marked = neighbour(log, [key], [changed_at], ["_state"], period, step=-1, into="_before")
        kept = marked.where(~F.col("_before._state").eqNullSafe(F.col("_state"))).drop("_before", "_state")
        timed = neighbour(kept, [key], [changed_at], [changed_at], period, step=1, into="_after").withColumn("_until", F.col(f"_after.{changed_at}"))
    return timed.select(
        key, *tracked, F.col(changed_at).alias("effective_from"), F.col("_until").alias("effective_to"), F.col("_until").isNull().alias("is_current"),
    )


def _points(history: DataFrame, key: str, changed_at: str, tracked: Sequence[str], tie: str) -> DataFrame:
    """Every change that is known of a history: the start of each version, and what only repeated it."""
    start = F.struct(F.col("effective_from").alias("at"), F.col("decided").alias("tie"))
    every = F.concat(F.array(start), F.col("repeats"))
    return history.select(key, *tracked, F.explode(every).alias("_p")).select(key, F.col("_p.at").alias(changed_at), F.col("_p.tie").alias(tie), *tracked)


def scd2_from_log(changes: DataFrame, key: str, changed_at: str, tracked: Sequence[str], tie: str) -> DataFrame:
    """The versions of :func:`scd2_history` that can take late changes.

    Of several changes of a (key, time) the largest ``tie`` wins (then the largest attributes).
    ``decided`` is the winner's, and ``repeats`` holds (at, tie) of the changes inside a
    version that did not alter it: a late change between them splits the version there.
    """
    tracked = list(tracked)
    log = dedup_latest(changes.select(key, changed_at, tie, *tracked), [key, changed_at], [F.desc(tie), *[F.desc(c) for c in tracked]])
    along = Window.partitionBy(key).orderBy(changed_at)
    state = _state(tracked)
    marked = log.withColumn("_new", (F.row_number().over(along) == 1) | ~F.lag(state).over(along).eqNullSafe(state))
    numbered = marked.withColumn("_version", F.count_if("_new").over(along.rowsBetween(Window.unboundedPreceding, 0)))
    point = F.struct(F.col(changed_at).alias("at"), F.col(tie).alias("tie"))
    versions = numbered.groupBy(key, "_version").agg(
        F.max_by(state, F.col("_new")).alias("_state"), F.min(point).alias("_first"), F.array_sort(F.collect_list(F.when(~F.col("_new"), point))).alias("repeats"))
    following = F.lead("_first.at").over(Window.partitionBy(key).orderBy("_version"))
    return versions.withColumn("effective_to", following).select(
        key, "_state.*", F.col("_first.at").alias("effective_from"), "effective_to", F.col("effective_to").isNull().alias("is_current"), F.col("_first.tie").alias("decided"), "repeats")


def scd2_insert(history: DataFrame, changes: DataFrame, key: str, changed_at: str, tracked: Sequence[str], tie: str) -> DataFrame:
    """A history of :func:`scd2_from_log` after changes of any time, late ones included.

    Versions of keys without a change pass through. Those of the others are split and joined
    again from their known changes, so batches in any order, or twice, give the same history
    as the whole log at once. Rows with a null key or time are ignored.
    """
    known = changes.where(F.col(key).isNotNull() & F.col(changed_at).isNotNull()).select(key, changed_at, tie, *tracked)
    touched = known.select(key).distinct()
    points = _points(history.join(touched, key, "left_semi"), key, changed_at, tracked, tie).unionByName(known)
    return history.join(touched, key, "left_anti").unionByName(scd2_from_log(points, key, changed_at, tracked, tie))


def version_problems(dim: DataFrame, key: str, grain: str = "month") -> DataFrame:
    """Keys with overlapping validity or more than one current version.

    Compares each version with the next one in start order instead of joining the
    table to itself on a range.
    """
    versions = dim.select(key, "effective_from", "effective_to", "is_current", F.xxhash64(*dim.columns).alias("_id"))
    period = F.date_trunc(grain, F.col("effective_from")).cast("date")
    following = neighbour(versions, [key], ["effective_from", "_id"], ["effective_from"], period, step=1, into="_next")
    overlaps = following.where(
        F.col("_next").isNotNull()
        & (F.col("effective_to").isNull() | (F.col("effective_to") > F.col("_next.effective_from")))
    )
    current = dim.groupBy(key).agg(F.count_if(F.col("is_current")).alias("n")).where("n > 1")
    return (
        overlaps.groupBy(key).agg(F.count(F.lit(1)).alias("occurrences"))
        .select(key, F.lit("overlap").alias("problem"), "occurrences")
        .unionByName(current.select(key, F.lit("several_current").alias("problem"), F.col("n").alias("occurrences")))
    )
