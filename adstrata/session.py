"""Session settings, and the shared folder that jobs stage data in."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

# What the jobs rely on: UTC days, run-time re-planning, skew splitting, even output files.
JOB_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(app_name: str, master: str | None = None, **conf: str) -> SparkSession:
    """A session with the job settings. `conf` keys use `__` for the dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {**JOB_CONF, **{k.replace("__", "."): v for k, v in conf.items()}}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by `spark.checkpoint.dir`.

    Where that is unset, as in tests, it is set to a folder in the warehouse. Only on one machine: on a cluster a warehouse
    may be a folder of the driver's own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors reach")
        folder = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_staged"
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def staging_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder."""
    return f"{shared_folder(spark)}/adstrata/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write `df` to the shared folder and read it back.

    Cuts the lineage at files that outlive any executor. Parquet, so that later passes read only
    the columns they need, and compressed by a codec that takes a third less room than the default.
    """
    path = staging_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
