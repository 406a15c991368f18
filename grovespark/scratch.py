"""Shared working storage: tables written to the folder that the cluster names in spark.checkpoint.dir."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_FOLDERS: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """This application's folder inside the cluster's checkpoint folder; it goes when the application ends.

    Only a session in local mode may leave spark.checkpoint.dir unset (as in tests) and gets a folder of its own: on a
    cluster every host would write to its own disk, so that is an error.
    """
    sc = spark.sparkContext
    if sc.applicationId not in _FOLDERS:
        folder = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
        if not folder:
            if not re.match(r"local(\[|$)", sc.master):
                raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
            folder = tempfile.mkdtemp(prefix="grovespark-")
        own = f"{folder.rstrip('/')}/grovespark-{sc.applicationId}-{uuid.uuid4().hex[:8]}"
        path = sc._jvm.org.apache.hadoop.fs.Path(own)
        path.getFileSystem(sc._jsc.hadoopConfiguration()).deleteOnExit(path)
        _FOLDERS[sc.applicationId] = own
    return _FOLDERS[sc.applicationId]


def materialize(df: DataFrame, bucket_by: str | None = None) -> DataFrame:
    """Write df once as a shared table and read it back: cuts the lineage, survives lost executors.

    bucket_by: dealt into buckets by this column, as many as a shuffle has partitions, so that a join on it moves the
    other side alone. The catalog is told of the table for no longer than it takes to read its layout.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{uuid.uuid4().hex}"
    if bucket_by:
        name = f"grovespark_{uuid.uuid4().hex}"
        df.write.option("path", path).bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), bucket_by).saveAsTable(name)
        out = spark.table(name)
        spark.sql(f"DROP TABLE {name}")  # an external table: its files stay
        out._scratch = path
        return out
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch = path
    return out


def settled(df: DataFrame) -> DataFrame:
    """materialize(df), after which the files of its shuffles go at once: nothing reads them again, and else they stay until
    the driver happens to collect its garbage."""
    spark, name = df.sparkSession, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    was = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        return materialize(df)
    finally:
        spark.conf.unset(name) if was is None else spark.conf.set(name, was)


def discard(*tables: DataFrame) -> None:
    """Delete tables of materialize that nothing will read again; others are left alone."""
    for t in tables:
        if path := getattr(t, "_scratch", None):
            sc = t.sparkSession.sparkContext
            at = sc._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(sc._jsc.hadoopConfiguration()).delete(at, True)
