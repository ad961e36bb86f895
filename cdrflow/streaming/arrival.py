"""Arrival-driven processing with Structured Streaming.

New data files under the landing root are picked up by a file stream (at
most ``max_files`` per micro-batch); each micro-batch runs the batch steps
through ``foreachBatch`` with a batch id made of the stream's own id and the
epoch, so two streams never share one. The stream's checkpoint records which files were processed, so a failed batch
is retried with the same files and id, and a later run reads only files
it has not seen. Dictionary updates are idempotent per batch (known keys
are never renumbered), so a replayed batch adds nothing twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..plans.batch import process_stream_batch
from ..sources.landing import is_data
from ..sources.tables import Warehouse

MAX_FILES_PER_BATCH = 10


def arrival_lines(spark: SparkSession, landing_root: str,
                  max_files: int = MAX_FILES_PER_BATCH, archive: str | None = None) -> DataFrame:
    """Streaming (line, source_file) of data files arriving under ``landing_root``.

    With ``archive``, a folder outside the landing, files are moved there once the
    micro-batch behind theirs begins, so a run lists what is new and the last
    micro-batch, not all that ever came. All files of the landing's two
    levels are moved, so descriptors must live elsewhere, and files at
    another depth aren't taken.
    """
    reader = spark.readStream.format("text").option("maxFilesPerTrigger", max_files)
    if archive:
        stream = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive).load(f"{landing_root}/*/*")
    else:
        stream = reader.option("recursiveFileLookup", "true").load(landing_root)
    return (stream.select(F.col("value").alias("line"), F.col("_metadata.file_path").alias("source_file"))
            .where(is_data(F.col("source_file"))))


def batch_key(stream_id: str, epoch_id: int) -> int:
    """A batch id owned by one stream: the first 30 bits of the id that Spark keeps
    with the checkpoint, then the epoch."""
    return ((int(stream_id.replace("-", "")[:8], 16) >> 2) << 32) | epoch_id


def start(spark: SparkSession, landing_root: str, warehouse: str, checkpoint: str,
          available_now: bool = True, processing_time: str | None = None,
          max_files: int = MAX_FILES_PER_BATCH, descriptor_root: str | None = None,
          archive: str | None = None) -> StreamingQuery:
    """Start processing arriving files; returns the running query.

    ``available_now`` processes what is there and stops; otherwise a
    ``processing_time`` trigger keeps polling. ``checkpoint`` names the
    stream: another one sees all files again, and takes those that nobody has.
    ``archive`` needs a ``descriptor_root`` outside the landing (see
    :func:`arrival_lines`).
    """
    if archive and not descriptor_root:
        raise ValueError("an archived landing needs a descriptor_root of its own")
    wh = Warehouse(warehouse)

    def each(batch: DataFrame, epoch_id: int) -> None:
        stream_id = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        process_stream_batch(batch.sparkSession, batch, wh, batch_key(stream_id, epoch_id), landing_root, descriptor_root)

    writer = (arrival_lines(spark, landing_root, max_files, archive).writeStream
              .foreachBatch(each)
              .option("checkpointLocation", checkpoint))
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()


def run_available(spark: SparkSession, landing_root: str, warehouse: str, checkpoint: str,
                  descriptor_root: str | None = None, archive: str | None = None) -> None:
    """Process every file not yet seen by ``checkpoint``, then return."""
    q = start(spark, landing_root, warehouse, checkpoint, available_now=True, descriptor_root=descriptor_root, archive=archive)
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
