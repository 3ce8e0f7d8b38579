"""Follow a growing log directory with Structured Streaming.

The same column functions as the batch path are applied to a streaming text
source, so a stream and a batch over the same files agree.  Running level
counts are an unbounded-key aggregate over all time (no event-time windows
exist in the log model), so the state holds one row per level and the query
runs in complete mode; no watermark is needed because keys never expire.
Checkpoints go under the shared ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallyframe.operators.logs import parse_lines
from tallyframe.session import checkpoint_dir
from tallyframe.sources.ledger_store import latest_version


def follow(spark: SparkSession, directory: str, level: str | None = None,
           max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming parsed log records (``ts, level, msg, malformed``), optionally one level."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    parsed = parse_lines(reader.load(directory))
    return parsed if level is None else parsed.where(F.col("level") == F.lit(level))


def running_level_counts(stream: DataFrame) -> DataFrame:
    """Count per level over everything seen so far."""
    return stream.where(~F.col("malformed")).groupBy("level").agg(F.count(F.lit(1)).alias("n"))


def _checkpoint(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/streams/{name}-{uuid.uuid4().hex[:8]}"


def start_level_counts(spark: SparkSession, directory: str, query_name: str,
                       available_now: bool = True, checkpoint: str | None = None,
                       sink_path: str | None = None, source: DataFrame | None = None) -> StreamingQuery:
    """Run the running count per level.

    With ``sink_path`` every micro-batch writes the complete counts to a version
    folder of its own (``foreachBatch``; a replayed batch writes the same one
    again), which readers take once it is complete: ``latest_counts``;
    without it the counts go to an in-memory table named ``query_name`` (for
    interactive use).  ``available_now`` processes everything present and
    stops; otherwise the query keeps following new files.  ``source`` may be
    any streaming DataFrame of parsed log records.
    """
    stream = source if source is not None else follow(spark, directory)
    w = (running_level_counts(stream).writeStream.outputMode("complete").queryName(query_name)
         .option("checkpointLocation", checkpoint or _checkpoint(spark, query_name)))
    if sink_path:
        w = w.foreachBatch(lambda batch, epoch: batch.write.mode("overwrite").parquet(f"{sink_path.rstrip('/')}/v{epoch:06d}"))
    else:
        w = w.format("memory")
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="5 seconds")
    return w.start()


def latest_counts(spark: SparkSession, sink_path: str) -> DataFrame:
    """The counts of the last complete micro-batch."""
    folder = latest_version(spark, sink_path)
    return spark.read.parquet(folder) if folder else spark.createDataFrame([], "level string, n bigint")


def start_follow(spark: SparkSession, directory: str, level: str, sink_path: str,
                 checkpoint: str | None = None, available_now: bool = True) -> StreamingQuery:
    """Append matching records to a parquet folder (exactly-once file sink)."""
    q = (follow(spark, directory, level).writeStream.outputMode("append").format("parquet")
         .option("path", sink_path)
         .option("checkpointLocation", checkpoint or _checkpoint(spark, "follow")))
    q = q.trigger(availableNow=True) if available_now else q.trigger(processingTime="5 seconds")
    return q.start()
