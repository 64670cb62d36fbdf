"""Scratch tables and files under the shared folder that the cluster names in spark.checkpoint.dir."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


@contextmanager
def tidy(spark: SparkSession) -> Iterator[None]:
    """Writes inside delete their shuffle files as soon as they are done."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    old = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if old is None else spark.conf.set(key, old)


def drop(spark: SparkSession, path: str) -> None:
    """Deletes a folder of the store."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(p, True)


class Scratch:
    def __init__(self, spark: SparkSession):
        root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
        master = spark.sparkContext.master or ""
        if not root and (not master.startswith("local") or "cluster" in master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        self.spark, self.root = spark, f"{(root or '/tmp/checkpoints/provendar').rstrip('/')}/run-{uuid.uuid4().hex}"

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def save(self, df: DataFrame) -> DataFrame:
        """Writes df and reads it back: a lost executor costs no more than this step. Its shuffle files go at once."""
        path = self.path(uuid.uuid4().hex)
        with tidy(self.spark):
            df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def lines(self, name: str, df: DataFrame, head: list[str] = (), foot: list[str] = ()) -> str:
        """Writes one text file: head, the string column of df, foot (small inputs only)."""
        one = lambda x: self.spark.createDataFrame([(v,) for v in x], "value string").coalesce(1)
        body = df.coalesce(1)
        body = one(head).unionAll(body) if head else body
        body = body.unionAll(one(foot)) if foot else body
        body.coalesce(1).write.text(self.path(name))
        return self.path(name)

    def put(self, name: str, content: bytes) -> str:
        """Writes one binary file through the store's own file system."""
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path(name))
        out = path.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()).create(path)
        try:
            out.write(bytearray(content))
        finally:
            out.close()
        return self.path(name)
