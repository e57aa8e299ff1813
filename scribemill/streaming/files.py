"""Files as they arrive: subtitles read and silence-filled as a stream, each file once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from scribemill.operators.sequence import fill_silence, fuse


def arriving(spark: SparkSession, path: str, schema: str, most_files: int = 1000) -> DataFrame:
    """A stream of the subtitle tables (Parquet) that appear in a folder."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", most_files).parquet(path)


def process_new(stream: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Fuse and silence-fill what has arrived since the last run and stop. The checkpoint remembers the files; a batch
    that is run again overwrites its own folder. All rows of a file_id must arrive together, as files do."""

    def of_batch(rows: DataFrame, number: int) -> None:
        fill_silence(fuse(rows)).write.mode("overwrite").parquet(f"{out}/batch={number}")

    return stream.writeStream.foreachBatch(of_batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def event_counts(events: DataFrame, every: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Events by type in tumbling windows, with a watermark; for a batch or a stream."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", every).alias("w"), "event_type").agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), "event_type", "n")
