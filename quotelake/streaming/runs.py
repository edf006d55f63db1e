"""Running streaming queries whose operators keep state by key."""

from __future__ import annotations

from pyspark.sql import DataFrame

#: Fixed value: Spark's store for typed state and timers; it is saved in the query's
#: checkpoint, so any executor can go on with it.
STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def run_available(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Process everything that is there, into Parquet files, and stop.

    Run again with the same ``checkpoint``, it goes on with the state and the
    watermark of the run before.
    """
    conf = stream.sparkSession.conf
    before = conf.get(STORE, None)
    conf.set(STORE, ROCKS)
    try:
        (
            stream.writeStream.format("parquet")
            .option("path", path)
            .option("checkpointLocation", checkpoint)
            .outputMode("append")
            .trigger(availableNow=True)
            .start()
            .awaitTermination()
        )
    finally:
        conf.unset(STORE) if before is None else conf.set(STORE, before)
