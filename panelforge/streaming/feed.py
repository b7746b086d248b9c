"""Change feed: record files since the last run, reconciled batch by batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from panelforge.plans.mirror import mirror
from panelforge.runtime import freeze, scratch_scope
from panelforge.schemas import columns
from panelforge.sources.state import StateStore

# Fields of a change record.
CHANGE = columns("fileId string, removed boolean, time string")

# Spark forgets files this much older than the newest one; back-filled files may be years old.
ANY_AGE = "36500d"

# A record that comes again within this time of its first arrival is known.
REPLAY_WINDOW = "30 days"
_TIDY_BATCHES = "spark.sql.streaming.noDataMicroBatches.enabled"


def change_records(spark: SparkSession, feed_folder: str, replay_window: str | None = REPLAY_WINDOW) -> DataFrame:
    """The change records of a folder as a stream, each once.

    Records that agree in all fields are one, in one batch or in several. What was seen is kept as keyed state,
    spread over the shuffle partitions, for ``replay_window`` after the batch of its first arrival. The watermark runs on
    arrival, so no record is late, however old its own time is; one that comes again after the window counts anew.
    None keeps no state, as do checkpoints made without it.
    """
    records = spark.readStream.schema(CHANGE).option("maxFileAge", ANY_AGE).json(feed_folder)
    if replay_window is None:
        return records
    return (
        records.withColumn("_arrived", F.current_timestamp())
        .withWatermark("_arrived", replay_window)
        .dropDuplicatesWithinWatermark(CHANGE.names)
        .drop("_arrived")
    )


def feed_stream(
    spark: SparkSession,
    feed_folder: str,
    store: StateStore,
    root_id: str,
    prefix: str,
    listing: Callable[[], DataFrame],
    apply: Callable[[DataFrame], None],
    checkpoint: str,
    replay_window: str | None = REPLAY_WINDOW,
) -> StreamingQuery:
    """Mirror the tree for every new set of change records and stop.

    The cursor is the identity of the checkpoint with the batch number. A batch whose state
    was already committed before the stream could note it as done is recognised by that and
    skipped; with a new checkpoint all records are read again and acted on. Record files
    count however old they are; a record delivered again acts once (see ``change_records``).
    """
    records = change_records(spark, feed_folder, replay_window)

    def reconcile(batch: DataFrame, batch_id: int) -> None:
        # Spark writes this file with the checkpoint, before the first batch.
        stream = spark.read.schema("id string").json(f"{checkpoint.rstrip('/')}/metadata").first()
        token = f"{stream['id']}:{batch_id}"
        state = store.read()
        with scratch_scope(spark):
            # Written whole and once, also for a batch that is skipped: the state of the stream is kept by what reads it.
            batch = freeze(batch)
            if state is None or state.page_token != token:
                mirror(store, root_id, prefix, listing, batch, lambda: token, apply)

    # Without batches that only tidy up the stream's state: each batch stands for files, and moves the cursor. A
    # stream keeps the settings that it was started under.
    before = spark.conf.get(_TIDY_BATCHES, None)
    spark.conf.set(_TIDY_BATCHES, "false")
    try:
        return (
            records.writeStream.foreachBatch(reconcile)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
    finally:
        if before is None:
            spark.conf.unset(_TIDY_BATCHES)
        else:
            spark.conf.set(_TIDY_BATCHES, before)
