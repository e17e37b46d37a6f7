"""Intermediate tables in the shared folder that the cluster names."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tillmark.session import discard_at_exit
from tillmark.sources.paths import remove_path


class Store:
    """Parquet tables of one run under `spark.checkpoint.dir`.

    Written tables survive the executors that wrote them, and every reader fetches only the
    columns it needs. Whoever runs an operator drops the tables that nothing reads any more;
    those behind a returned DataFrame stay until the program ends.
    """

    def __init__(self, spark: SparkSession, purpose: str):
        shared = spark.conf.get("spark.checkpoint.dir", None)
        if not shared:
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        self.spark = spark
        self.root = f"{shared.rstrip('/')}/tillmark/{purpose}-{uuid.uuid4().hex}"
        discard_at_exit(spark, self.root)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def hold(self, df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").parquet(self.path(name))
        return self.read(name, df)

    def add(self, df: DataFrame, name: str) -> None:
        df.write.mode("append").parquet(self.path(name))

    def read(self, name: str, like: DataFrame) -> DataFrame:
        return self.spark.read.schema(like.schema).parquet(self.path(name))

    def drop(self, *names: str) -> None:
        for name in names:
            remove_path(self.spark, self.path(name))
