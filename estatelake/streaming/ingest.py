"""Incremental ingest of nightly listing drops with Structured Streaming.

The source pipeline is a nightly batch; the streaming form processes every
new drop exactly once: a Parquet file source (schema given, never
inferred), ``trigger(availableNow=True)`` to drain what has arrived and
stop, and ``foreachBatch`` running the nightly upsert. The checkpoint (in
the shared folder) records which files each epoch consumed; a replayed
epoch re-runs an idempotent upsert (newest row per URL; the epoch's own
history partitions, named by stream and epoch), so exactly-once results
survive driver or executor loss and do not depend on how files are dealt to
epochs.

Keep-latest needs no streaming state: the current table *is* the state,
and each epoch's batch is first reduced to its latest row per URL. Epochs only
add their value counts and mark the summary's partitions as due; the drain writes
these once at its end, whatever the number of epochs. A drain that broke off leaves
them due: readers make them from the counts, and the next drain writes them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ..plans.nightly import refresh_summaries, upsert_nightly
from ..session import shared_path
from ..sources.tables import Lake


def ingest_drops(spark: SparkSession, drops_dir: str, schema: StructType, lake: Lake,
                 checkpoint: str | None = None, history_partition: str = "snapshot_date",
                 max_files_per_trigger: int | None = None):
    """Drain every drop under ``drops_dir`` into ``lake``; returns the
    finished streaming query."""
    reader = spark.readStream.schema(schema).format("parquet")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.load(drops_dir)
    checkpoint = checkpoint or shared_path(spark, "stream-ckpt")
    stream_id = checkpoint.rstrip("/").rsplit("/", 1)[-1]

    def each(batch: DataFrame, epoch_id: int) -> None:
        if not batch.isEmpty():
            upsert_nightly(lake, batch, history_partition, f"{stream_id}-{epoch_id}", summarise=False)

    q = (stream.writeStream.foreachBatch(each)
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    refresh_summaries(lake)
    return q
