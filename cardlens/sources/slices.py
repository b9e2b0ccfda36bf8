"""Tables whose slices are replaced at once: files of a new version are written aside, and a manifest that names each slice's
version takes effect by one rename. Readers see the old slices or the new ones, never a part."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession


def _file_system(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _newest(spark: SparkSession, path: str) -> int:
    """The number of the manifest in force; 0 if there is none yet."""
    fs, folder = _file_system(spark, f"{path}/manifest")
    if not fs.exists(folder):
        return 0
    return max((int(s.getPath().getName()) for s in fs.listStatus(folder) if s.getPath().getName().isdigit()), default=0)


def manifest(spark: SparkSession, path: str, number: int | None = None) -> dict[str, str]:
    """slice (such as date=2024-01-10) -> version; an earlier number gives the table as it was."""
    number = _newest(spark, path) if number is None else number
    if not number:
        return {}
    return json.loads("\n".join(r[0] for r in spark.read.option("wholetext", "true").text(f"{path}/manifest/{number}").collect()))


def _switch(spark: SparkSession, path: str, number: int, content: dict[str, str]) -> None:
    """Put a manifest in force as `number`; fails if another writer has been first."""
    aside = f"{path}/aside-{uuid.uuid4().hex}"
    spark.createDataFrame([(json.dumps(content, sort_keys=True),)], "value string").coalesce(1).write.text(aside)
    fs, folder = _file_system(spark, f"{path}/manifest")
    fs.mkdirs(folder)
    _, source = _file_system(spark, aside)
    _, target = _file_system(spark, f"{path}/manifest/{number}")
    if fs.exists(target) or not fs.rename(source, target):
        raise RuntimeError(f"{path}: another writer has put manifest {number} in force")


def replace_slices(df: DataFrame, path: str, partition_by: str, drop: tuple[str, ...] = ()) -> int:
    """Replace the slices that df has rows of, and take out those named in `drop`; returns the manifest's number.

    A run that fails before the switch leaves the table as it was, and what it wrote aside is read by nobody. Slices, such as
    days, are listed by the driver; rows are not.
    """
    spark = df.sparkSession
    number = _newest(spark, path)
    version = uuid.uuid4().hex
    df.write.partitionBy(partition_by).parquet(f"{path}/data/{version}")
    fs, folder = _file_system(spark, f"{path}/data/{version}")
    new = {s.getPath().getName(): version for s in fs.listStatus(folder) if s.isDirectory() and "=" in s.getPath().getName()}
    kept = {k: v for k, v in manifest(spark, path, number).items() if k not in drop}
    _switch(spark, path, number + 1, {**kept, **new})
    return number + 1


def read_slices(spark: SparkSession, path: str, number: int | None = None) -> DataFrame:
    """The table under the manifest in force, or under an earlier one. A table that was never written can't be read."""
    held = manifest(spark, path, number)
    if not held:
        raise FileNotFoundError(f"{path}: no slices")
    by_version: dict[str, list[str]] = {}
    for name, version in held.items():
        by_version.setdefault(version, []).append(f"{path}/data/{version}/{name}")
    parts = [spark.read.option("basePath", f"{path}/data/{version}").parquet(*sorted(files)) for version, files in sorted(by_version.items())]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def write_version(df: DataFrame, path: str, version: str) -> bool:
    """Write a whole version once: it is there complete or not at all. Returns False if it is there already."""
    spark = df.sparkSession
    fs, target = _file_system(spark, f"{path}/version={version}")
    if fs.exists(target):
        return False
    aside = f"{path}/_aside-{uuid.uuid4().hex}"  # readers pass over such names
    df.write.parquet(aside)
    if not fs.rename(_file_system(spark, aside)[1], target):
        raise RuntimeError(f"{path}: version {version} can't be put in place")
    return True


def move_files(spark: SparkSession, source: str, target: str, prefix: str) -> None:
    """Move what Spark has written into another folder under names with a prefix; each file is there whole or not."""
    fs, folder = _file_system(spark, source)
    fs.mkdirs(_file_system(spark, target)[1])
    for s in fs.listStatus(folder):
        name = s.getPath().getName()
        if s.isFile() and name.startswith("part-") and not fs.rename(s.getPath(), _file_system(spark, f"{target}/{prefix}{name}")[1]):
            raise RuntimeError(f"{target}/{prefix}{name} can't be put in place")
