"""Tables written to the folder that driver and executors share, so that a lineage ends and survives lost executors."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``. Where it is unset, a fresh one in local mode; on a
    cluster, whose machines share no temporary folder, an error."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        found = "file://" + tempfile.mkdtemp(prefix="tessera-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Writes df as Parquet to the shared folder and reads it back."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/tessera-{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._tessera_path = path
    return out


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder wherever Spark keeps it."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def discard(df: DataFrame) -> None:
    """Removes a table that materialise() wrote and that nothing reads any more."""
    path = getattr(df, "_tessera_path", None)
    if path:
        remove(df.sparkSession, path)
