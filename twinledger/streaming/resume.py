"""Process only new list files, and survive a restart."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from twinledger.plans.replaying import Sender, replay
from twinledger.sources import KEY_HEADERS, locate_lines, parse_list


def replay_new_files(
    spark: SparkSession,
    input_dir: str,
    docs: DataFrame,
    path: str,
    checkpoint: str,
    sender: Sender,
    **options,
) -> StreamingQuery:
    """Replay the keys of every file not seen before, then stop.

    The stream's checkpoint remembers files; the outcome table remembers keys.
    Outcomes are written under the stream's id. A repeated micro-batch skips the
    keys that its earlier try has recorded and does the rest.
    """

    def handle(lines: DataFrame, batch_id: int) -> None:
        keys = parse_list(lines, "key", KEY_HEADERS)
        # The id is kept in the checkpoint, so it is the same after a restart.
        stream_id = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        replay(keys, docs, path, sender, feed=f"stream-{stream_id}", **options)

    return (
        locate_lines(spark.readStream.text(input_dir))
        .writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
