"""Order-dependent operators that never gather one key, or the whole table, in a task."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from innsight.sources.storage import scratch_path


def neighbour(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    values: Sequence[str],
    bucket: Column,
    step: int = -1,
    into: str = "_neighbour",
) -> DataFrame:
    """Add a struct with ``values`` of the previous (-1) or next (+1) row of the key.

    ``bucket`` must not decrease along ``order`` (for example the month of the first
    order column). Rows are windowed per (key, bucket); the edge row of each bucket
    is carried over in a second window that sees one row per bucket, so a key with a
    large share of all rows is still spread over its buckets. Rows with a NULL key have
    no neighbours.
    """
    keys, order = list(keys), list(order)
    rows = df.withColumn("_bucket", bucket)
    forward = step < 0
    inner = Window.partitionBy(*keys, "_bucket").orderBy(*order)
    outer = Window.partitionBy(*keys).orderBy("_bucket")
    shift = F.lag if forward else F.lead
    edge_by = F.max_by if forward else F.min_by
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in [*keys, "_bucket"]])
    edges = (
        rows.where(known)
        .groupBy(*keys, "_bucket")
        .agg(edge_by(F.struct(*values), F.struct(*order)).alias("_edge"))
        .select(*keys, "_bucket", shift("_edge").over(outer).alias("_carry"))
    )
    return (
        rows.withColumn("_inside", F.when(known, shift(F.struct(*values)).over(inner)))
        .join(edges, [*keys, "_bucket"], "left")
        .select(*df.columns, F.coalesce("_inside", "_carry").alias(into))
    )


def _spread(df: DataFrame) -> Column:
    """A number that tells the rows of one key and time apart, the same whenever a task runs."""
    return F.xxhash64(*[F.col(f"`{f.name}`") for f in df.schema.fields if "map<" not in f.dataType.simpleString()])


def swept(left: DataFrame, keys: Sequence[str], left_ts: str, tables: Sequence[tuple[DataFrame, str, Sequence[str]]]) -> DataFrame:
    """Rows of all sides in ranges of equal size by (key, time), written once: ``_range``, keys, ``_at``, ``_row`` or ``_pay<i>``.

    Ranges come from a sample of the rows, not from the calendar, so a busy key, and even one
    instant of it, is cut into as many ranges as it needs.
    """
    keys = list(keys)
    # Columns keep their names only inside the structs, so they cannot collide.
    sides = [left.select(*keys, F.col(left_ts).alias("_at"), F.lit(1).alias("_side"), _spread(left).alias("_tie"), F.struct(*[F.col(f"`{c}`") for c in left.columns]).alias("_row"))]
    for i, (table, ts, values) in enumerate(tables):
        pay = F.struct(F.col(ts).alias("_ts"), *[F.col(f"`{v}`").alias(f"_v{j}") for j, v in enumerate(values)])
        sides.append(table.dropna(subset=[*keys, ts]).select(*keys, F.col(ts).alias("_at"), F.lit(0).alias("_side"), F.lit(0).cast("long").alias("_tie"), pay.alias(f"_pay{i}")))
    both = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), sides)
    staged = both.repartitionByRange(*keys, "_at", "_side", "_tie").withColumn("_range", F.spark_partition_id())
    path = scratch_path(left.sparkSession, "sweep")
    staged.write.parquet(path)
    return left.sparkSession.read.schema(staged.schema).parquet(path)


def asof_sweep(left: DataFrame, keys: Sequence[str], left_ts: str, tables: Sequence[tuple[DataFrame, str, Sequence[str]]]) -> DataFrame:
    """Newest row at or before each left row, of each of several tables, in one pass.

    ``tables`` holds (table, time column, value columns); each has one row per (key, time). All
    rows are put in order together and shuffled once, whatever the number of tables. Inside a
    range the newest row of each table is filled forward; from the end of each range the last
    row of each table is handed on, one row per range, and counts where its key is the same.
    NULL keys match nothing, and a row without a time finds nothing. A column that the left
    side has as well gets the suffix ``_asof``.
    """
    keys = list(keys)
    rows = swept(left, keys, left_ts, tables)
    order = Window.partitionBy("_range", *keys).orderBy("_at", "_side")
    count = range(len(tables))
    key = F.struct(*[F.col(k) for k in keys])
    local = rows.withColumns({f"_local{i}": F.last(f"_pay{i}", ignorenulls=True).over(order) for i in count}).where("_side = 1")
    # The last row of each table in a range, in the order of keys and times.
    ends = rows.groupBy("_range").agg(*[
        F.max_by(F.struct(key.alias("key"), F.col(f"_pay{i}").alias("pay")), F.when(F.col(f"_pay{i}").isNotNull(), F.struct(*keys, "_at"))).alias(f"_end{i}") for i in count])
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    carried = ends.select("_range", *[F.last(f"_end{i}", ignorenulls=True).over(before).alias(f"_carry{i}") for i in count])
    found = local.join(F.broadcast(carried), "_range", "left")
    taken, out = set(left.columns), [F.col("_row.*")]
    for i, (_, ts, values) in enumerate(tables):
        carry = F.when(F.col(f"_carry{i}.key") == key, F.col(f"_carry{i}.pay"))
        found = found.withColumn(f"_found{i}", F.when(F.col("_at").isNotNull(), F.coalesce(F.col(f"_local{i}"), carry)))
        for name, source in ((ts, "_ts"), *((v, f"_v{j}") for j, v in enumerate(values))):
            name = f"{name}_asof" if name in taken else name
            taken.add(name)
            out.append(F.col(f"_found{i}.{source}").alias(name))
    return found.select(*out)


def asof_join(left: DataFrame, right: DataFrame, keys: Sequence[str], left_ts: str, right_ts: str, values: Sequence[str]) -> DataFrame:
    """Newest right row at or before each left row, per key (point-in-time lookup); see :func:`asof_sweep`."""
    return asof_sweep(left, keys, left_ts, [(right, right_ts, values)])


def running_totals(df: DataFrame, order: Sequence[str], totals: dict[str, Column], with_total: bool = False) -> DataFrame:
    """Inclusive running sums over a total order of the whole table.

    ``with_total`` adds the grand total of each sum as ``<name>_total``.

    Rows are range-partitioned and written once with their range number. Each range
    is summed on its own; the sums of earlier ranges (one row per range, at most the
    shuffle partition count) are added back. ``order`` must be unique per row, which
    also lets the range partitioner split a frequent leading value.
    """
    order = list(order)
    path = scratch_path(df.sparkSession, "ranges")
    staged = df.withColumns({f"_v_{name}": expr for name, expr in totals.items()})
    staged = staged.repartitionByRange(*order).withColumn("_range", F.spark_partition_id())
    staged.write.parquet(path)
    rows = df.sparkSession.read.schema(staged.schema).parquet(path)

    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    grand = [F.sum(f"_s_{name}").over(every).alias(f"{name}_total") for name in totals] if with_total else []
    offsets = (
        rows.groupBy("_range")
        .agg(*[F.sum(f"_v_{name}").alias(f"_s_{name}") for name in totals])
        .select("_range", *[F.coalesce(F.sum(f"_s_{name}").over(earlier), F.lit(0)).alias(f"_o_{name}") for name in totals], *grand)
    )
    inside = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    summed = rows.withColumns({f"_c_{name}": F.sum(f"_v_{name}").over(inside) for name in totals})
    return summed.join(offsets, "_range").select(
        *df.columns, *[(F.col(f"_c_{name}") + F.col(f"_o_{name}")).alias(name) for name in totals],
        *([f"{name}_total" for name in totals] if with_total else []),
    )


def global_row_number(df: DataFrame, order: Sequence[str], into: str = "row_number") -> DataFrame:
    return running_totals(df, order, {into: F.lit(1).cast("long")})


def ntile(df: DataFrame, buckets: int, order: Sequence[str], into: str) -> DataFrame:
    """Equal-sized ordered buckets over the whole table; earlier buckets take the remainder."""
    numbered = running_totals(df, order, {"_rn": F.lit(1).cast("long")}, with_total=True)
    size = F.col("_rn_total")
    base, extra = F.floor(size / F.lit(buckets)), size % F.lit(buckets)
    cut = extra * (base + 1)
    row = F.col("_rn") - 1
    tile = F.when(row < cut, F.floor(row / (base + 1))).otherwise(extra + F.floor(F.try_divide(row - cut, base)))
    return numbered.withColumn(into, (tile + 1).cast("int")).drop("_rn", "_rn_total")


def exact_quantiles(df: DataFrame, value: str, quantiles: dict[str, float]) -> DataFrame:
    """One row of interpolated quantiles of ``value``; exact, without a single-task collect.

    Equal values are merged first; positions come from running totals.
    """
    counted = df.where(F.col(value).isNotNull()).groupBy(F.col(value).cast("double").alias("_x")).agg(
        F.count(F.lit(1)).alias("_n")
    )
    ranked = running_totals(counted, ["_x"], {"_upto": F.col("_n")}, with_total=True)
    size = F.col("_upto_total")
    holds = lambda pos: (F.col("_upto") - F.col("_n") <= pos) & (pos < F.col("_upto"))
    picks = []
    for name, q in quantiles.items():
        at = (size - 1) * F.lit(float(q))
        picks += [
            F.max(F.when(holds(F.floor(at)), F.col("_x"))).alias(f"_lo_{name}"),
            F.max(F.when(holds(F.ceil(at)), F.col("_x"))).alias(f"_hi_{name}"),
            F.max(at - F.floor(at)).alias(f"_at_{name}"),
        ]
    edges = ranked.agg(*picks)
    return edges.select(
        *[
            (F.col(f"_lo_{n}") + (F.col(f"_hi_{n}") - F.col(f"_lo_{n}")) * F.col(f"_at_{n}")).alias(n)
            for n in quantiles
        ]
    )


def top_ranked(df: DataFrame, top_n: int | None, order: Sequence[Column], rank: str = "rank") -> DataFrame:
    """The first ``top_n`` rows with their rank as first column; with None all rows, for a few groups only.

    ``limit`` after ``orderBy`` keeps ``top_n`` rows per task; only the survivors are
    numbered.
    """
    kept = df if top_n is None else df.orderBy(*order).limit(top_n)
    return kept.select(F.row_number().over(Window.orderBy(*order)).cast("long").alias(rank), *df.columns)
