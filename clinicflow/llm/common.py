"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clinicflow.session import ensure_checkpoint_dir

PACKAGE_DIR = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

_shipped: set[str] = set()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Give the executors' Python workers this package (once per application).

    The zip is served by the driver through ``addPyFile``; nothing is read
    from the driver's folders by the executors.
    """
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    path = os.path.join(tempfile.mkdtemp(prefix="clinicflow-py-"), "clinicflow_llm_code.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as out:
        for folder, _, names in os.walk(PACKAGE_DIR):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    out.write(full, os.path.relpath(full, os.path.dirname(PACKAGE_DIR)))
    sc.addPyFile(path)
    _shipped.add(sc.applicationId)


def written(df: DataFrame, tag: str) -> DataFrame:
    """``df`` written once as Parquet in the shared checkpoint folder and read back.

    Cuts the lineage where rows are used several times or must not be computed
    anew; a lost executor loses nothing of it. The folder is removed when the
    application ends.
    """
    return written_at(df, tag)[0]


def written_at(df: DataFrame, tag: str) -> tuple[DataFrame, str]:
    """As ``written``, and the path, for ``discard`` once no plan reads it."""
    spark = df.sparkSession
    path = scratch_path(spark, tag)
    schema = df.schema
    df.write.mode("error").option("compression", "zstd").parquet(path)
    discard_at_exit(spark, path)
    return spark.read.schema(schema).parquet(path), path


def scratch_path(spark: SparkSession, tag: str) -> str:
    """A new path in the shared checkpoint folder, removed when the application ends."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{tag}-{uuid.uuid4().hex}"


def discard_at_exit(spark: SparkSession, path: str) -> None:
    sc = spark.sparkContext
    hadoop_path = sc._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(sc._jsc.hadoopConfiguration()).deleteOnExit(hadoop_path)


def discard(spark: SparkSession, path: str) -> None:
    """Remove a written table that no plan reads any more."""
    sc = spark.sparkContext
    hadoop_path = sc._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(hadoop_path, True)


def id_crc(column: str):
    """crc32 of an id written as decimal text: the folds of the labelled operators."""
    return F.crc32(F.col(column).cast("string").cast("binary"))
