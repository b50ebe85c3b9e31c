"""New files as a stream: each content is let through once, and what a batch finds is appended."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def new_documents(spark: SparkSession, root: str, schema: str, text_col: str = "text", at: str | None = None, late: str = "1 hour") -> DataFrame:
    """Documents of a growing folder of Parquet files, the first of each text.

    With an event time, state older than `late` is let go, so it stays bounded; a copy later than that passes again.
    """
    docs = spark.readStream.schema(schema).parquet(root).withColumn("hash", F.md5(text_col))
    if at:
        return docs.withWatermark(at, late).dropDuplicatesWithinWatermark(["hash"])
    return docs.dropDuplicates(["hash"])


def append_to(docs: DataFrame, out: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    writer = docs.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).outputMode("append")
    return (writer.trigger(availableNow=True) if once else writer).start()
