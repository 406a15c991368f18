"""Versions of a table: data folders that nobody reads until a log entry names them.

A commit writes its data under a name of its own and then makes one log entry, written aside and renamed to its number. The
rename fails where that number is taken, so of two writers that start from one version only one wins; a torn write leaves
data that no entry names. Readers pin a version by reading its entry.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession


class VersionTaken(RuntimeError):
    """Another writer has committed this version."""


def _files(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, at, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def versions(spark: SparkSession, path: str) -> list[int]:
    """Committed versions, ascending; none where nothing was committed yet."""
    jvm, at, fs = _files(spark, f"{path}/log")
    names = [s.getPath().getName() for s in fs.listStatus(at)] if fs.exists(at) else []
    return sorted(int(n.removesuffix(".json")) for n in names if n.removesuffix(".json").isdigit())


def latest_version(spark: SparkSession, path: str) -> int | None:
    return max(versions(spark, path), default=None)


def commit_version(df: DataFrame, path: str, version: int) -> DataFrame:
    """Writes df as this version and gives it back as it was stored; VersionTaken if the number is in use by then.

    A writer that loses takes its data away again and may read the winner's version and try the next number.
    """
    spark, name = df.sparkSession, uuid.uuid4().hex
    if version in versions(spark, path):
        raise VersionTaken(f"{path} has a version {version}")
    data = f"{path}/data/{name}"
    df.write.parquet(data)
    jvm, entry, fs = _files(spark, f"{path}/log/{version:020d}.json")
    fs.mkdirs(entry.getParent())
    aside = jvm.org.apache.hadoop.fs.Path(f"{path}/log/.{name}")
    out = fs.create(aside, True)
    out.write(bytearray(json.dumps({"version": version, "data": name, "schema": json.loads(df.schema.json())}).encode()))
    out.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    never = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 1)
    never[0] = getattr(jvm.org.apache.hadoop.fs, "Options$Rename").NONE
    try:
        context.rename(aside, entry, never)
    except Exception as e:
        fs.delete(aside, False)
        fs.delete(jvm.org.apache.hadoop.fs.Path(data), True)
        if version in versions(spark, path):
            raise VersionTaken(f"{path} has a version {version}") from e
        raise
    return read_version(spark, path, version)


def read_version(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """A version, the latest if none is named. Later commits don't change what it reads."""
    from pyspark.sql.types import StructType

    version = latest_version(spark, path) if version is None else version
    if version is None:
        raise FileNotFoundError(f"nothing was committed to {path}")
    text = spark.read.text(f"{path}/log/{version:020d}.json", wholetext=True).first()[0]
    said = json.loads(text)
    return spark.read.schema(StructType.fromJson(said["schema"])).parquet(f"{path}/data/{said['data']}")


def unnamed_data(spark: SparkSession, path: str) -> list[str]:
    """Data folders that no version names: of torn writes, or of writers that are still at work."""
    jvm, at, fs = _files(spark, f"{path}/data")
    there = {s.getPath().getName() for s in fs.listStatus(at)} if fs.exists(at) else set()
    named = {json.loads(r[0])["data"] for r in spark.read.text([f"{path}/log/{v:020d}.json" for v in versions(spark, path)], wholetext=True).collect()} if versions(spark, path) else set()
    return sorted(there - named)
