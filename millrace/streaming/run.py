"""Start streaming jobs that stop when they have read everything."""

from __future__ import annotations

from pyspark.sql import DataFrame

from millrace.streaming.batches import Sink


def drain(
    stream: DataFrame, each: Sink, checkpoint: str, mode: str, partitions: int | None = None
) -> None:
    """Process everything available through ``each(batch, batch_id)``, then stop.

    ``partitions`` sets the number of state partitions, which is fixed when a
    job first starts; without it that is the session's shuffle partitions.
    """
    conf = stream.sparkSession.conf
    before = conf.get("spark.sql.shuffle.partitions")
    if partitions is not None:
        conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        job = (
            stream.writeStream.outputMode(mode)
            .foreachBatch(each)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
    finally:
        conf.set("spark.sql.shuffle.partitions", before)
    job.awaitTermination()
