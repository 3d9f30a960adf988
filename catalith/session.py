"""Session settings and the few cluster facts the operators ask for."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "catalith", master: str | None = None, **conf: str) -> SparkSession:
    """Session with adaptive execution, skew-join splitting and UTC; callers override by keyword."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    settings.update({k.replace("__", "."): v for k, v in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder under the cluster's shared checkpoint folder.

    The folder comes from ``spark.checkpoint.dir`` (or the context's checkpoint folder). Only a local master may fall
    back to a machine-local folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        base = tempfile.mkdtemp(prefix="catalith-")
        spark.conf.set("spark.checkpoint.dir", base)
    return os.path.join(base, f"{purpose}-{uuid.uuid4().hex}")


def materialize(df: DataFrame, purpose: str, by: str | None = None) -> DataFrame:
    """Write once to the shared folder and read back: cuts lineage and survives the loss of executors.

    With ``by``, rows are laid out in as many buckets of that column as a shuffle has partitions, so that joins and groups by it read them without a shuffle.
    ``df`` should come from a join or repartitioning by it; each task writes a file per bucket that it holds.
    """
    spark, path = df.sparkSession, shared_dir(df.sparkSession, purpose)
    if by is None:
        df.write.mode("overwrite").parquet(path)
        return spark.read.schema(df.schema).parquet(path)
    name = os.path.basename(path).replace("-", "_")
    df.write.format("parquet").bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), by).option("path", path).saveAsTable(name)
    out = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # its files stay; only the catalog forgets it
    return out
