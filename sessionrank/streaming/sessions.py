"""Sessions and popularity of a stream of events, by event time.

Events are (user_id, item_id, timestamp), timestamps in whole microseconds. A stream is any streaming DataFrame of such
rows; `event_files` reads files as they land. State lives in the checkpoint folder, so a restarted query goes on where it ended, and the
file sink keeps a log of what each batch wrote, so no row is written twice.
"""

from pyspark.sql import functions as F

from sessionrank import schemas

MICROS = 1_000_000


def event_files(spark, folder, schema, files_per_batch=None):
    """The rows of Parquet files that land in a folder, as a stream."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def _timed(events, delay):
    """The events with `time`; those more than `delay` microseconds (in whole milliseconds) behind the latest may be left out."""
    return events.withColumn("time", F.timestamp_micros("timestamp")).withWatermark("time", f"{-(-delay // 1000)} milliseconds")


def stream_sessions(events, gap=schemas.GAP_SECONDS * MICROS, min_length=schemas.MIN_LENGTH, delay=0):
    """Rows (user_id, started, ended, n_items) of each session once it is over, in microseconds; short ones are left out.

    A session is over when no event within `gap` of its last one can still come: when the latest event is more than
    `gap` + `delay` later. A gap of exactly `gap` does not end it.
    """
    timed = _timed(events, delay)
    # Spark joins an event at the very end of a window to it, so a gap of exactly `gap` does not end a session.
    window = F.session_window("time", f"{gap} microseconds")
    found = timed.groupBy("user_id", window.alias("span")).agg(
        F.min("timestamp").alias("started"), F.max("timestamp").alias("ended"), F.count(F.lit(1)).alias("n_items")
    )
    return found.filter(F.col("n_items") >= min_length).select("user_id", "started", "ended", "n_items")


def stream_popularity(events, width, delay=0):
    """Rows (window_start, item_id, n): how often each item occurs in each stretch of `width` microseconds, once it is over."""
    counts = _timed(events, delay).groupBy(F.window("time", f"{width} microseconds").alias("span"), "item_id").agg(F.count(F.lit(1)).alias("n"))
    return counts.select(F.unix_micros("span.start").alias("window_start"), "item_id", "n")


def run_available(stream, sink, checkpoint):
    """Processes all that has landed since the last run, writes to the sink (Parquet files) and returns when done."""
    query = (
        stream.writeStream.format("parquet").option("path", sink).option("checkpointLocation", checkpoint)
        .outputMode("append").trigger(availableNow=True).start()
    )
    query.awaitTermination()
