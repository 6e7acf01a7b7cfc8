"""What is new in a stage's table: its files as a stream, each taken once, into a folder by micro-batch.

A run lists only files that came since the last one; a micro-batch that runs again writes its own folder again. Whoever
takes rows on marks the epoch they are done with, so what a broken run did not finish is there for the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.utils import AnalysisException


class NewRows:
    """New rows of a table, narrowed to some columns: found(after) has those of epochs that are not done with."""

    def __init__(self, spark: SparkSession, table: str, schema: str, columns: list[str], folder: str) -> None:
        self.spark, self.table, self.schema, self.columns = spark, table, schema, columns
        self.rows, self.checkpoint = f"{folder}/rows", f"{folder}/checkpoint"

    def advance(self) -> None:
        """Take in all files that are new."""
        stream = self.spark.readStream.schema(self.schema).parquet(self.table).select(*self.columns)
        stream.writeStream.foreachBatch(self._write).option("checkpointLocation", self.checkpoint).trigger(availableNow=True).start().awaitTermination()

    def _write(self, batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{self.rows}/epoch={epoch}")

    def found(self, after: int = -1) -> DataFrame:
        own = self.spark.createDataFrame([], self.schema).select(*self.columns).schema.add("epoch", "long")
        try:
            return self.spark.read.schema(own).parquet(self.rows).where(f"epoch > {after}")
        except AnalysisException:
            return self.spark.createDataFrame([], own)
