"""Rebuild the scored profile whenever new presence files arrive.

A file-source stream over the presence folder is only a trigger: each
micro-batch (``foreachBatch``) re-runs the batch build over the *whole*
presence table, because every presence feature (streaks, last-n records,
weekday variance) depends on an entity's full history. Progress is kept in a
checkpoint under the shared ``spark.checkpoint.dir`` so a restarted job does
not rebuild for files it has already seen.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from vigilo.session import ensure_checkpoint_dir
from vigilo.sources.readers import PRESENCE_SCHEMA


def start_profile_refresh(spark: SparkSession, presence_dir: str, rebuild: Callable[[DataFrame], None],
                          fmt: str = "parquet", name: str = "profile-refresh",
                          available_now: bool = True) -> StreamingQuery:
    """Start the refresh stream; ``rebuild(full_presence)`` writes the new profile.

    ``available_now`` processes what is there and stops (batch-style
    scheduling); otherwise the query keeps watching the folder.
    """
    ckpt = f"{ensure_checkpoint_dir(spark).rstrip('/')}/streams/{name}"
    reader = spark.readStream.schema(PRESENCE_SCHEMA).format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True)
    arrivals = reader.load(presence_dir)

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        full = spark.read.schema(PRESENCE_SCHEMA).format(fmt)
        if fmt == "csv":
            full = full.option("header", True)
        rebuild(full.load(presence_dir))

    writer = arrivals.writeStream.queryName(name).option("checkpointLocation", ckpt).foreachBatch(on_batch)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
