"""Tables between the steps of one operator, in the folder that the driver and all executors see."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``. Where it is unset and all runs on one machine, a folder is made and set; on a cluster that
    is an error."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir is unset: name a folder that all executors and the driver share")
        root = "file://" + tempfile.mkdtemp(prefix="lindero-steps-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def _own(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/{spark.sparkContext.applicationId}/steps"


def settled(df: DataFrame, name: str, number: str | None = None) -> DataFrame:
    """``df`` written once and read again: its rows don't change when a task runs anew, and plans behind it start there.
    ``number``: a column to add that differs in each row and grows with the rows of a task."""
    path = f"{_own(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    rows = df.withColumn(number, F.monotonically_increasing_id()) if number else df
    rows.write.parquet(path)
    return df.sparkSession.read.schema(rows.schema).parquet(path)


def clear_steps(spark: SparkSession) -> None:
    """Remove what this application's operators have settled; what was not read or written elsewhere is gone."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_own(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
