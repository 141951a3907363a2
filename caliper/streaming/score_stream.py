"""Score a message stream with a fitted pipeline.

``readStream`` -> ``PipelineModel.transform`` -> ``writeStream``.  The
pipeline is stateless, so there is no watermark or state store; the file
sink plus a checkpoint under ``spark.checkpoint.dir`` gives exactly-once
output, and a restarted query resumes from the last committed batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caliper.operators.score import score_messages
from caliper.session import scratch_path
from caliper.sources.io import is_file


def message_stream(spark: SparkSession, source_dir: str, schema: T.StructType, fmt: str = "parquet",
                   file_glob: str | None = None, max_files_per_trigger: int | None = None) -> DataFrame:
    """A file-source stream (new files in ``source_dir`` are new messages).

    A table that is a single file is streamed from the folder it lies in, by its name.
    """
    if not file_glob and is_file(spark, source_dir):
        source_dir, file_glob = source_dir.rstrip("/").rsplit("/", 1)
    r = spark.readStream.schema(schema).format(fmt)
    if file_glob:
        r = r.option("pathGlobFilter", file_glob)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(source_dir)


def start_scoring(model, stream: DataFrame, key: str, out_path: str, checkpoint: str | None = None,
                  text_col: str = "text", available_now: bool = False, processing_time: str | None = None):
    """Start the scoring query; returns the ``StreamingQuery``."""
    spark = stream.sparkSession
    scored = score_messages(model, stream, key, text_col)
    w = (scored.writeStream.format("parquet").option("path", out_path)
         .option("checkpointLocation", checkpoint or scratch_path(spark, "score-stream-ckpt"))
         .outputMode("append"))
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start()


def score_available(model, spark: SparkSession, source_dir: str, schema: T.StructType, key_expr,
                    key: str = "msg_id", file_glob: str | None = None, text_col: str = "text") -> DataFrame:
    """Run the stream over everything available now, wait, and return the scored rows."""
    stream = message_stream(spark, source_dir, schema, file_glob=file_glob)
    stream = stream.select(key_expr.alias(key), F.col(text_col))
    out = scratch_path(spark, "score-stream-out")
    q = start_scoring(model, stream, key, out, available_now=True, text_col=text_col)
    q.awaitTermination()
    return spark.read.parquet(out)
