"""Intermediate tables that cut a long lineage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallylake.sources.paths import delete_at_exit, delete_folder


class Staging:
    """Named Parquet tables in one folder of the shared scratch space.

    A step that is read more than once is written here, so that neither a second reader
    nor a lost executor makes Spark parse the input again.  Writing a name again replaces
    it: a folder used for many batches holds one batch.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def put(self, name: str, df: DataFrame) -> DataFrame:
        path = f"{self.folder}/{name}"
        df.write.mode("overwrite").parquet(path)
        delete_at_exit(self.spark, path)
        return self.spark.read.schema(df.schema).parquet(path)

    def clear(self) -> None:
        """Remove the folder once nothing reads it any more."""
        delete_folder(self.spark, self.folder)
