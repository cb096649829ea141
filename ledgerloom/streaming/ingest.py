"""New files to long facts as they arrive; late filings are restatements, kept and resolved on read."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..sources.documents import FACT_SCHEMA, instance_facts, parsed


def arriving(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """Files of a folder as a stream of path and content."""
    schema = "path string, modificationTime timestamp, length bigint, content binary"
    return spark.readStream.format("binaryFile").schema(schema).option("pathGlobFilter", pattern).load(path)


def ingest(spark: SparkSession, source: str, table: str, checkpoint: str, parse: Callable = instance_facts, schema: str = FACT_SCHEMA, pattern: str = "*") -> StreamingQuery:
    """Parse what is new into a parquet table, with the file it came from and when, and stop. A
    file that fails is a row with its message."""
    rows = parsed(arriving(spark, source, pattern), parse, schema, errors=True)
    out = rows.withColumn("ingested", F.current_timestamp())
    return out.writeStream.format("parquet").option("path", table).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed(events: DataFrame, time: str, key: list[str], value: str, every: str = "1 hour", late: str = "1 day") -> DataFrame:
    """Count and sum per key and window; rows later than the watermark are left out."""
    return events.withWatermark(time, late).groupBy(F.window(time, every), *key).agg(F.count("*").alias("n"), F.sum(value).alias("total"))
