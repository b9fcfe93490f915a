"""Incremental folder load: CSV files arriving in a folder, upserted into a
keyed table with Structured Streaming.

The file source tracks which files were processed in the checkpoint (on the
shared folder), so each file is taken once. Every micro-batch goes through
the keyed store's upsert. ``foreachBatch`` gives at-least-once delivery, and
an upsert of the same rows is a no-op, so a batch replayed after a failure
leaves the same table: the sink is effectively exactly-once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from keyferry.operators.conform import conform
from keyferry.operators.keys import dedupe
from keyferry.sinks.keyed import KeyedStore
from keyferry.sources.csv_folder import TEXT_OPTIONS
from keyferry.spec import TableMapping


FILE_TIME = "__kf_file_time"


def folder_stream(
    spark: SparkSession, folder: str, schema: T.StructType | str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """A streaming frame over the CSV files of ``folder`` (declared schema:
    streaming sources cannot infer one), with each row's file modification
    time in ``FILE_TIME``. Texts are read in the dialect of ``csv_folder``."""
    r = spark.readStream.schema(schema).options(header="true", **TEXT_OPTIONS)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.csv(folder).select("*", F.col("_metadata.file_modification_time").alias(FILE_TIME))


def feed_keyed_table(
    spark: SparkSession,
    folder: str,
    schema: T.StructType | str,
    store: KeyedStore,
    mapping: TableMapping,
    buckets: int = 1,
    profile: str = "reference",
    checkpoint: str | None = None,
    available_now: bool = True,
    processing_time: str | None = None,
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Start the feed. ``available_now`` processes what is there and stops
    (a scheduled job); otherwise it runs every ``processing_time``.

    The checkpoint defaults to a fixed folder under the store root, so
    scheduled runs continue where the last one stopped. Within a micro-batch
    a row from a later file wins over the same key from an earlier file
    (then ``mapping.order_by``, then the other columns decide).
    """

    def upsert_batch(batch: DataFrame, batch_id: int) -> None:
        # The store reads an upsert's batch twice (keys, then rows) and takes a
        # copy first, since a stream's batch is not a plain file scan; the copy
        # goes when the write ends. ``max_files_per_trigger`` caps batch size
        # when that matters.
        latest = dedupe(batch, mapping.key, (FILE_TIME,) + tuple(mapping.order_by)).drop(FILE_TIME)
        store.write(
            conform(latest, profile),
            mapping.target,
            mapping.partition_key,
            mapping.clustering_keys,
            mode="append",
            buckets=mapping.buckets or buckets,
            order_by=mapping.order_by,
            unique=True,
        )

    w = (
        folder_stream(spark, folder, schema, max_files_per_trigger)
        .writeStream.foreachBatch(upsert_batch)
        .option("checkpointLocation", checkpoint or f"{store.root}/_checkpoints/{mapping.target}")
    )
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time or "1 minute")
    return w.start()
