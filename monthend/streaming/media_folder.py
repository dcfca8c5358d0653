"""Incremental media load: a folder of monthly mention files as a stream.

The reference is run by hand each month on one file. Here new files dropped
into a folder are picked up by a Structured Streaming file source, which
hands over their names; every micro-batch of files goes through the batch
reader and logic (header discovery, counts, report month, glossary ids) and
is upserted into the fact store. Files without the required columns go into
a reject table, a folder per micro-batch, before progress is committed, so
none is dropped unseen. Progress
(which files were processed) lives in a checkpoint under the shared
checkpoint folder, so a restarted or failed run resumes where it stopped;
the upsert is idempotent, so replaying a micro-batch after a failure does
not change the result.

``trigger="available_now"`` processes what is there and stops, like the
monthly run; a processing-time trigger keeps watching the folder.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from monthend.plans.media_load import mention_updates, upsert_in_order
from monthend.session import checkpoint_dir
from monthend.sources.files import read_mention_files
from monthend.sources.store import FactStore

FILES_PER_BATCH = 1000  # most file names a micro-batch hands to the driver


def reject_path(store: FactStore) -> str:
    """Folder of the files that could not be loaded: (file, reason), by micro-batch."""
    return f"{store.root}_rejected"


def process_batch(batch: DataFrame, epoch: int, store: FactStore, glossary: DataFrame,
                  multiline: bool = True) -> None:
    """One micro-batch of new file names -> upsert; files lacking columns are recorded."""
    spark = batch.sparkSession
    paths = [r.path for r in batch.select("path").collect()]
    if not paths:
        return
    rows, invalid = read_mention_files(spark, paths, multiline)
    bad = invalid.select("file", F.lit("no 'Calificación'/'Fecha' header").alias("reason"))
    if not bad.isEmpty():
        # a replayed micro-batch writes the same folder again
        bad.write.mode("overwrite").parquet(f"{reject_path(store)}/batch={epoch}")
    upsert_in_order(store, mention_updates(rows, glossary))


def start_media_folder_load(spark: SparkSession, folder: str, store: FactStore, glossary: DataFrame,
                            checkpoint: str | None = None, trigger: str = "available_now",
                            interval: str = "1 hour", multiline: bool = True,
                            max_files_per_batch: int = FILES_PER_BATCH) -> StreamingQuery:
    # the stream reads names only; the content column is pruned away
    stream = (spark.readStream.format("binaryFile").option("maxFilesPerTrigger", max_files_per_batch)
              .schema("path string, modificationTime timestamp, length bigint, content binary")
              .load(folder).select("path", "modificationTime"))
    # one progress folder per inbox, so two watched folders never share one
    inbox_key = hashlib.sha1(folder.rstrip("/").encode()).hexdigest()[:16]
    ckpt = checkpoint or f"{checkpoint_dir(spark)}/media-folder-load-{inbox_key}"
    w = (stream.writeStream
         .foreachBatch(lambda df, epoch: process_batch(df, epoch, store, glossary, multiline))
         .option("checkpointLocation", ckpt))
    w = w.trigger(availableNow=True) if trigger == "available_now" else w.trigger(processingTime=interval)
    return w.start()
