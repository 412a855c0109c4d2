"""Request metrics that are kept up to date from a stream of request log rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def publish_complete(aggregate: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Bring a streaming aggregate up to date and write its full result for this epoch.

    The aggregate is complete in every epoch, so a redelivered one rewrites its own folder.
    """

    def write(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target}/epoch={epoch}")

    query = (
        aggregate.writeStream.outputMode("complete")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(write)
        .start()
    )
    query.awaitTermination()
    return query


def latest(spark: SparkSession, target: str) -> DataFrame:
    """The result of the last epoch."""
    epochs = spark.read.parquet(target)
    last = epochs.agg(F.max("epoch")).first()[0]
    return epochs.filter(F.col("epoch") == last).drop("epoch")
