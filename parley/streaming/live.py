"""Turn KPIs per time window over arriving CSV files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from parley.functions.casts import cast_columns
from parley.operators import kpis
from parley.operators.clean import clean_chatbot
from parley.sources.csv_files import CSV_OPTIONS
from parley.sources.readers import with_event_time
from parley.sources.schemas import CHATBOT


def read_turns(spark: SparkSession, folder: str, files_per_trigger: int = 100) -> DataFrame:
    """Cleaned turns from CSV files as they arrive, with their ``event_time``.

    Watermarks exist only for timestamps with a zone, so the time is read in the session's.

    A stream cannot look at headers up front: files must hold the contract's columns in order, and
    one whose header differs is refused rather than misread.
    """
    as_text = T.StructType([T.StructField(name, T.StringType()) for name in CHATBOT.names])
    raw = (
        spark.readStream.schema(as_text)
        .options(**CSV_OPTIONS)
        .option("enforceSchema", False)
        .option("maxFilesPerTrigger", files_per_trigger)
        .csv(folder)
    )
    timed = with_event_time(clean_chatbot(cast_columns(raw, CHATBOT)), "chatbot_interactions")
    return timed.withColumn("event_time", F.col("event_time").cast("timestamp"))


def windowed_kpis(
    turns: DataFrame, window: str = "1 day", lateness: str = "1 hour", *groups: str
) -> DataFrame:
    """Turn and feedback KPIs per window and group; a window closes ``lateness`` after its end."""
    timed = turns.filter(F.col("event_time").isNotNull()).withWatermark("event_time", lateness)
    sums = kpis.turn_sums(timed, F.window("event_time", window).alias("window"), *groups)
    figures = kpis.figures(kpis.TURN_KPIS + kpis.FEEDBACK_KPIS)
    return sums.select(F.col("window.start").alias("window_start"), *groups, *figures)


def write_windows(results: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Write closed windows until the input is drained.

    Each micro-batch has a folder of its own, which a repeated batch replaces. A window closes when a
    later turn moves the watermark past its end, so the last windows of the input are not written by
    this run: they stay in the checkpoint and come out of a later run, once there are newer turns. For
    a complete answer over what has arrived, run the same measures as a batch.
    """

    def save(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    return (
        results.writeStream.outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(save)
        .start()
    )
