"""Table storage: ingest, overwrite, staged swap and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, for written intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``. Only a local master may
    fall back to a temporary folder; a cluster without the setting is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if spark.sparkContext.master.startswith("local"):
        made = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", made)
        return made
    raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_dir(spark)}/innsight-{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex[:12]}"


def clear_scratch(spark: SparkSession) -> bool:
    """Delete this application's intermediate tables; call it when no result is read any more."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/innsight-{spark.sparkContext.applicationId}")
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def remove(spark: SparkSession, path: str) -> bool:
    """Delete an intermediate table that nothing reads any more."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def write_table(df: DataFrame, path: str, cluster_by: tuple[str, ...] = (), rebalance: bool = True) -> DataFrame:
    """Overwrite ``path`` and read it back.

    Rows are rebalanced (adaptive execution splits oversized and merges undersized
    write tasks, so a hot key cannot make one huge file) and sorted inside each task
    by ``cluster_by``, which gives the Parquet page index tight min/max ranges for
    the date filters the reports push down. ``rebalance`` False spares that shuffle of
    the whole table where the plan ends partitioned by a key that few rows share.
    """
    out = df.hint("rebalance") if rebalance else df
    if cluster_by:
        out = out.sortWithinPartitions(*cluster_by)
    out.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialize(df: DataFrame, label: str, cluster_by: tuple[str, ...] = (), rebalance: bool = True) -> DataFrame:
    """Cut lineage with a written table; survives executor loss."""
    return write_table(df, scratch_path(df.sparkSession, label), cluster_by, rebalance)


def ingest(source: DataFrame, source_name: str, ingested_at: Column | None = None) -> DataFrame:
    """Copy of a source table with the two audit columns of the landing layer."""
    stamp = F.current_timestamp() if ingested_at is None else ingested_at
    return source.withColumns(
        {"_bronze_ingestion_timestamp": stamp, "_bronze_source_table": F.lit(source_name)}
    )


def ingest_table(
    spark: SparkSession, source_path: str, target_path: str, source_name: str, ingested_at: Column | None = None
) -> int:
    """Land one table, replacing earlier content, and return its row count.

    The count is an observed metric of the write job, so the data is read once.
    """
    from pyspark.sql import Observation

    seen = Observation(f"ingest_{source_name}")
    landed = ingest(spark.read.parquet(source_path), source_name, ingested_at)
    landed.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(target_path)
    return seen.get["rows"]


def rows_source(spark: SparkSession, rows: list[tuple], schema: T.StructType) -> DataFrame:
    """Literal configuration rows with a declared schema."""
    return spark.createDataFrame(rows, schema)


def parts(spark: SparkSession, path: str, column: str) -> list[str]:
    """Values of a partition column of the table at ``path``, from the names of its folders."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(folder)] if fs.exists(folder) else []
    return sorted(n.split("=", 1)[1] for n in names if n.startswith(f"{column}="))


def read_parts(spark: SparkSession, path: str, column: str, values: list[str], schema: T.StructType) -> DataFrame:
    """Rows of the named partitions only; no other folder is listed. ``schema`` holds ``column`` as well."""
    if not values:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(*[f"{path}/{column}={v}" for v in values])


def swap_in(spark: SparkSession, staged: str, target: str) -> None:
    """Replace ``target`` by the finished table at ``staged``.

    Both paths must be on one Hadoop file system. The old table is kept aside until
    the rename succeeded, so a reader never finds a half-written table.
    """
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    new, old = jvm.org.apache.hadoop.fs.Path(staged), jvm.org.apache.hadoop.fs.Path(target)
    aside = jvm.org.apache.hadoop.fs.Path(f"{target.rstrip('/')}.old-{uuid.uuid4().hex[:8]}")
    fs = new.getFileSystem(conf)
    had_old = fs.exists(old)
    if had_old and not fs.rename(old, aside):
        raise RuntimeError(f"could not move {target} aside")
    if not fs.exists(old.getParent()):
        fs.mkdirs(old.getParent())
    if not fs.rename(new, old):
        if had_old:
            fs.rename(aside, old)
        raise RuntimeError(f"could not swap {staged} into {target}")
    if had_old:
        fs.delete(aside, True)
    spark.catalog.refreshByPath(target)
