"""Cutting lineage with a written table in the shared checkpoint folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from clinicflow.session import ensure_checkpoint_dir


def materialize(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` once as Parquet under the checkpoint folder and read it back.

    Used where later steps must see *fixed* values of nondeterministic
    columns (partition ids, positions): a retried task or a lost executor
    then re-reads the written rows instead of recomputing them. The folder
    is ``spark.checkpoint.dir`` (shared storage on a cluster), never a
    machine-local temp folder; Parquet keeps the write columnar and cheap.
    """
    spark = df.sparkSession
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/clinicflow-{tag}-{uuid.uuid4().hex}"
    df.write.mode("error").parquet(path)
    # The folder goes when the application ends.
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(hadoop_path)
    return spark.read.parquet(path)
