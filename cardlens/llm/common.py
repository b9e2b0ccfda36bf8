"""Helpers that several training-data operators share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Arrow batches stay small enough that a batch of very long texts fits a Python worker.
BATCH_ROWS = 512
BATCH_BYTES = 8 << 20
SALTS = 16  # that rows of one component are dealt over


def bound_batches(spark: SparkSession) -> None:
    """Bound what one Arrow batch hands to Python, by rows and by bytes."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def shared_folder(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir; a local session without it (tests) gets one of its own."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir names no shared folder")
        folder = "file://" + tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def durable(df: DataFrame, name: str = "step") -> DataFrame:
    """Write df to the shared folder and read it back: later plans start from files that survive a lost executor."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def empty_if_null(column: str | Column) -> Column:
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def whole_row(df: DataFrame) -> Column:
    """All columns of df as one struct, so that names used along the way can't clash with theirs."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns])


def salted_rank(df: DataFrame, key: str, order: Sequence[str], salts: int, out: str = "rank") -> DataFrame:
    """A 0-based rank of each row among the rows of its key, without ever gathering a key in one task.

    Rows of a key are dealt over `salts` buckets by a hash of the order columns and ranked in each; the counts of
    the buckets before (keys x salts rows) are added. The order is by bucket, then by `order`. Key must not be null.
    """
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*order), F.lit(salts)).cast("int"))
    return ranked_within(salted, key, ("_salt",), order, out).drop("_salt")


def ranked_within(df: DataFrame, key: str, groups: Sequence[str], order: Sequence[str], out: str) -> DataFrame:
    """A 0-based rank of each row among the rows of its key, by groups, then order: made in each group and completed by
    the counts of the groups before. A key's groups, not its rows, meet in one task. Key and groups must not be null."""
    before = Window.partitionBy(key).orderBy(*groups).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        df.groupBy(key, *groups)
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(key, *groups, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    )
    own = Window.partitionBy(key, *groups).orderBy(*order)
    return (
        df.withColumn("_row_in_group", F.row_number().over(own).cast("long"))
        .join(offsets, [key, *groups])
        .withColumn(out, F.col("_before") + F.col("_row_in_group") - 1)
        .drop("_row_in_group", "_before")
    )


def components(edges: DataFrame) -> DataFrame:
    """Connected components of edges (a, b): rows (node, root), root the smallest node reachable.

    Smallest labels spread along edges and jump along labels until none changes, so the rounds grow with the
    logarithm of the diameter; each round is written to the shared folder. Only a flag comes to the driver.
    """
    pairs = edges.where("a <> b").select("a", "b")
    both = durable(pairs.union(pairs.select("b", "a")).toDF("node", "other").distinct(), "edges")
    labels = both.groupBy("node").agg(F.min("other").alias("m")).select("node", F.least("node", "m").alias("root"))
    while True:
        spread = (
            both.join(labels.select(F.col("node").alias("other"), F.col("root").alias("seen")), "other")
            .groupBy("node")
            .agg(F.min("seen").alias("seen"))
        )
        near = durable(
            labels.join(spread, "node").select("node", F.col("root").alias("was"), F.least("root", "seen").alias("root")), "labels"
        )
        if not near.where("was <> root").take(1):
            return near.select("node", "root")
        # only nodes that still are below another one are worth a jump; a root's rows are dealt over SALTS
        up = near.where("node <> root").select(F.col("node").alias("root"), F.col("root").alias("higher"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt"))
        dealt = near.withColumn("_salt", F.pmod(F.xxhash64("node"), F.lit(SALTS)).cast("int"))
        labels = durable(dealt.join(up, ["root", "_salt"], "left").select("node", F.least("root", F.coalesce("higher", "root")).alias("root")), "labels")


def with_least(rows: DataFrame, value: str, out: str) -> DataFrame:
    """rows (root, value, ...) with the least value of their root; those with a null root keep their own.

    Least values are made before any shuffle of rows, and the rows of a root are dealt over SALTS.
    """
    grouped, single = rows.where("root is not null"), rows.where("root is null")
    least = grouped.groupBy("root").agg(F.min(value).alias(out)).withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    dealt = grouped.withColumn("_salt", F.pmod(F.xxhash64(*[c for c in rows.columns if c != "root"]), F.lit(SALTS)).cast("int"))
    return dealt.join(least, ["root", "_salt"]).drop("_salt").unionByName(single.withColumn(out, F.col(value)))
