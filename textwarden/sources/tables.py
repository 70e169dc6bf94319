"""Reading tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def request_log(spark: SparkSession, folder: str) -> DataFrame:
    """Requests made of the tables at hand: each event sends a whole document.

    Columns: id, user_id, ts, event_type, text.
    """
    events = read_table(spark, folder, "events")
    documents = read_table(spark, folder, "documents").select("doc_id", "text")
    n = documents.count()
    return events.join(documents, F.col("event_id") % n == F.col("doc_id")).select(
        F.col("event_id").alias("id"), "user_id", "ts", "event_type", "text"
    )
