"""Batch readers and writers."""

from __future__ import annotations

import json
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardlens import schemas
from cardlens.functions.scalar import utc_date
from cardlens.operators.joins import new_rows, time_slice
from cardlens.sources import slices


def scan_table(spark: SparkSession, path: str, table: str) -> DataFrame:
    """A source table by its declared schema; nothing is inferred."""
    return spark.read.schema(schemas.schema(table)).parquet(path)


def scan_jdbc(spark: SparkSession, url: str, table: str, column: str, lower, upper, partitions: int, **options: str) -> DataFrame:
    """A database table read in ranges of a column; needs the driver's jar on the class path."""
    ranges = {"partitionColumn": column, "lowerBound": str(lower), "upperBound": str(upper), "numPartitions": str(partitions)}
    return spark.read.format("jdbc").options(url=url, dbtable=table, **ranges, **options).load()


def digest(df: DataFrame) -> str:
    """Content digest that row order and partitioning don't change: row count and two sums of row hashes."""
    row = df.select(F.xxhash64(*df.columns).alias("h"), F.hash(*df.columns).alias("g")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("h").cast("decimal(38,0)")).alias("a"), F.sum(F.col("g").cast("decimal(38,0)")).alias("b")
    ).first()
    return f"{row['n']}-{row['a'] or 0}-{row['b'] or 0}"


def write_snapshot(df: DataFrame, path: str) -> str:
    """Write a training frame under version=<digest>; the same content has the same version and is written once."""
    version = digest(df)
    slices.write_version(df, path, version)
    return version


def bulk_load(df: DataFrame, path: str, partition_by: str | None = None) -> None:
    writer = df.write.mode("append")
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def insert_if_absent(batch: DataFrame, path: str, key: str, order: list[str] | None = None, partition_by: str | None = None) -> int:
    """Append the batch's rows whose key the whole table lacks, whatever partition they would go to; returns how many. A second
    run of a batch adds nothing. Of rows with the same key the first by `order` stays.

    The table's key column alone is read, and cut down to the batch's keys where it is read: only keys that both sides have
    are shuffled, and a batch of few keys is sent to the scan. For batches that come all the time, see ingest.write_once.
    """
    spark = batch.sparkSession
    existing = batch.select(key).limit(0)
    if exists(spark, path):
        existing = spark.read.parquet(path).select(F.col(key).cast(dict(batch.dtypes)[key])).join(batch.select(key).distinct(), key, "left_semi")
    rows = new_rows(batch, existing, key, order).persist()
    try:
        n = rows.count()
        if n:
            bulk_load(rows, path, partition_by)
        return n
    finally:
        rows.unpersist()


def insert_if_absent_jdbc(batch: DataFrame, url: str, table: str, key: str, order: list[str] | None = None, partitions: int = 8, **options: str) -> int:
    """insert_if_absent for a database table: known keys between the batch's least and largest are read, and only new rows
    are written. The table's own key constraint stays the last word between writers; needs the driver's jar."""
    spark = batch.sparkSession
    ends = batch.agg(F.min(key).alias("lo"), F.max(key).alias("hi")).first()
    if ends["lo"] is None:
        return 0
    known = spark.read.format("jdbc").options(url=url, dbtable=table, **options).load()
    existing = known.select(key).where(F.col(key).between(ends["lo"], ends["hi"]))  # the database filters
    rows = new_rows(batch, existing, key, order).persist()
    try:
        n = rows.count()
        if n:
            rows.repartition(partitions).write.format("jdbc").options(url=url, dbtable=table, **options).mode("append").save()
        return n
    finally:
        rows.unpersist()


def work_folder(spark: SparkSession, name: str) -> str:
    """A new folder of this name for results of a job, in spark.checkpoint.dir, the folder that the cluster shares; only a
    local session without that setting gets a temporary one."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir names no shared folder")
        folder = "file://" + tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return f"{folder.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def backfill(build: Callable[..., DataFrame], path: str, start: str, end: str, partition_by: str = "date") -> int:
    """Build the rows of [start, end) again and replace their slices at once; returns the number of the new manifest."""
    return slices.replace_slices(build(start, end).withColumn(partition_by, utc_date(F.col("created_at"))), path, partition_by)


def patch_labels(path: str, labels: DataFrame, since, until, partition_by: str = "date") -> None:
    """Give the stored rows (transaction_id, label, ...) under path the labels that came in [since, until): only the
    partitions that hold such rows are read and written again."""
    spark = labels.sparkSession
    new = time_slice(labels, "created_at", since, until).select("transaction_id", F.col("label").alias("_new"))
    stored = spark.read.parquet(path)
    touched = [r[0] for r in stored.select("transaction_id", partition_by).join(new, "transaction_id", "left_semi").select(partition_by).distinct().collect()]
    if touched:
        kind = dict(stored.dtypes)["label"]
        merged = stored.where(F.col(partition_by).isin(touched)).join(new, "transaction_id", "left")
        patched = merged.withColumn("label", F.coalesce(F.col("_new"), F.col("label")).cast(kind)).select(stored.columns)
        # written aside first: a partition can't be read and replaced at once
        aside = f"{path.rstrip('/')}_patch_{uuid.uuid4().hex}"
        patched.write.parquet(aside)
        overwrite_slice(spark.read.schema(patched.schema).parquet(aside), path, partition_by)


def overwrite_slice(df: DataFrame, path: str, partition_by: str) -> None:
    """Replace just the partitions that df has rows of."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition_by).parquet(path)


def load_contract(spark: SparkSession, path: str) -> dict:
    """Ordered columns and encoders of a model, from JSON on any file system that Spark reads."""
    content = json.loads("\n".join(r[0] for r in spark.read.option("wholetext", "true").text(path).collect()))
    return {"columns": content.get("columns") or content.get("feature_columns"), "encoders": content.get("encoders", {})}


def write_contract(spark: SparkSession, contract: dict, path: str) -> None:
    spark.createDataFrame([(json.dumps(contract, sort_keys=True),)], "value string").coalesce(1).write.mode("overwrite").text(path)
