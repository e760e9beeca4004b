"""Pages as a stream of files: sentences, labels, and each event once (an addition to the batch operators)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from mortarline.functions.classify import classify, explode_sentences
from mortarline.operators.model import event_id

PAGES = "doc_id string, source_id string, page_number int, chunk_text string, arrived timestamp"


def page_stream(spark: SparkSession, folder: str, schema: str = PAGES, files_per_trigger: int = 100) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)


def event_stream(pages: DataFrame, late: str = "14 days") -> DataFrame:
    """Events of the sentences that are worth keeping, each id once within the time rows may be late."""
    rows = explode_sentences(pages, "chunk_text").withColumn("has_entity", F.lit(False))
    rows = classify(rows).where("keep = 1")
    rows = rows.withColumn("event_id", event_id(F.col("source_id"), F.col("doc_id"), F.col("page_number"), F.col("event_type"), F.col("sentence")))
    return rows.withWatermark("arrived", late).dropDuplicatesWithinWatermark(["event_id"])


def write_events(events: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """All files there are, once; call again for new ones.  The checkpoint folder keeps what was read."""
    return events.drop("tags").writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()


def windowed_counts(events: DataFrame, late: str = "1 day", width: str = "1 day") -> DataFrame:
    """Events per type and window of arrival."""
    return events.withWatermark("arrived", late).groupBy(F.window("arrived", width), "event_type").agg(F.count("*").alias("n"))
