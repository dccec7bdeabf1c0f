"""Tables between the steps of eager operators, in the folder that driver and executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

#: Where tables go if a session on one machine (master local) names no shared folder, as in tests.
LOCAL = "file:///tmp/checkpoints"


def folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir; only a session whose driver does all the work may go without."""
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not at:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        at = LOCAL
    return at.rstrip("/")


class Steps:
    """`with Steps(spark) as s`: s.written(df) is df, written as Parquet and read back, so that later steps neither compute it
    again nor depend on the executors that did; what s.keep() was not called for is deleted at the end, or when replaced."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, {}

    def __enter__(self) -> Steps:
        return self

    def written(self, df: DataFrame) -> DataFrame:
        path = f"{folder(self.spark)}/siftstone/step-{uuid.uuid4().hex}"
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(out)] = (path, out)
        return out

    def keep(self, df: DataFrame) -> DataFrame:
        """df, which stays for whoever reads the result."""
        self.paths.pop(id(df), None)
        return df

    def drop(self, df: DataFrame) -> None:
        path, _ = self.paths.pop(id(df), (None, None))
        if path:
            p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(p, True)

    def __exit__(self, *_) -> None:
        for _, df in list(self.paths.values()):
            self.drop(df)
