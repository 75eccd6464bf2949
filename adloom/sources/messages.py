"""Message sources and the envelope around every report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adloom.functions.aliases import canonicalise
from adloom.schemas import ENVELOPE, payload_schema


def kafka_options(servers: str, topic: str, max_offsets: int | None = 5_000_000) -> dict[str, str]:
    """Reader options: the whole topic from its start, micro-batches of bounded size."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "earliest",
        "failOnDataLoss": "false",
    }
    if max_offsets:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    return options


def kafka_stream(spark: SparkSession, servers: str, topic: str, max_offsets: int | None = 5_000_000) -> DataFrame:
    """Raw messages of a topic (needs the ``spark-sql-kafka`` package on the class path)."""
    return spark.readStream.format("kafka").options(**kafka_options(servers, topic, max_offsets)).load()


def parquet_stream(spark: SparkSession, path: str, schema: T.StructType, max_files: int = 1_000) -> DataFrame:
    """Parquet files as a stream of micro-batches of bounded size; ``path`` may name a folder or a single file."""
    # A pattern is needed for a single file; the class at its end matches just this name.
    path = path.rstrip("/")
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(f"{path[:-1]}[{path[-1]}]")


def wrap(
    data: Column, platform: Column, report_type: Column, ingested_at: Column, crawling_type: str = "daily"
) -> Column:
    """Message text of one report record: metadata plus the record as an object."""
    metadata = F.struct(
        platform.alias("platform"),
        report_type.alias("report_type"),
        ingested_at.alias("ingested_at"),
        F.lit(crawling_type).alias("crawling_type"),
    )
    return F.to_json(F.struct(metadata.alias("metadata"), data.alias("data")))


def unwrap(messages: DataFrame, value: str = "value") -> DataFrame:
    """Decode envelopes: platform, report_type, ingested_at, raw_data (all NULL if not JSON)."""
    payload = F.from_json(F.col(value).cast("string"), ENVELOPE)
    return messages.select(payload.alias("payload")).select(
        F.col("payload.metadata.platform").alias("platform"),
        F.col("payload.metadata.report_type").alias("report_type"),
        F.col("payload.metadata.ingested_at").alias("ingested_at"),
        F.col("payload.data").alias("raw_data"),
    )


def parse_payload(routed: DataFrame, report_type: str) -> DataFrame:
    """Records of one report type, under canonical names, with the envelope's ingest time."""
    parsed = routed.select(
        "ingested_at", F.from_json("raw_data", payload_schema(report_type)).alias("d")
    ).select("ingested_at", "d.*")
    return canonicalise(parsed)
