"""The per-user rollup as a stream over the transactions table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallylake.plans import rollups
from tallylake.schema import AMOUNT
from tallylake.sources import tables
from tallylake.sources.paths import literal_path


def stream_user_30min(spark: SparkSession, root: str, checkpoint: str | None = None) -> None:
    """Fold all batches loaded since the last call into the streamed rollup.

    With a watermark of zero a window stays open until the newest event reaches its end,
    so of late rows those in the newest window still count and older ones do not: the
    rule of the batch rollup.  It is applied per micro-batch, one per call.  A failed
    load has to be repeated before the stream goes on.
    """
    source = tables.transactions(root)
    target = tables.user_30min_stream(root)
    if tables.unfinished(spark, source):
        # Its files would count now and again under new names after the retry.
        raise RuntimeError(f"a load into {source.path} has failed; repeat it first")
    facts = (
        spark.readStream.schema(source.schema)
        .option("maxFileAge", "36500d")
        .parquet(f"{literal_path(source.path)}/delta")
    )
    counts = (
        facts.withWatermark("transaction_time", "0 minutes")
        .groupBy(F.window("transaction_time", "30 minutes"), "site_id", "username")
        .agg(
            F.count("*").alias("txn_count"),
            F.sum("transfer_amount").cast(AMOUNT).alias("total_amount"),
        )
        .withColumn("window_start", F.col("window.start"))
    )

    def commit(batch: DataFrame, batch_id: int) -> None:
        # Each batch holds the new totals of the groups it touched.  One action only:
        # a second one would run the stateful plan again.
        mark = rollups.high_water(batch.sparkSession, target, "window_start", before_run=batch_id)
        rollups.commit_run(batch, target, rollups.USER_KEYS, batch_id, mark)

    query = (
        counts.writeStream.outputMode("update")
        .foreachBatch(commit)
        .option("checkpointLocation", checkpoint or f"{root}/_checkpoints/user_30min")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
