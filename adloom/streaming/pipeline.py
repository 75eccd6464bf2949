"""Structured Streaming: archive every message, route reports into the star schema."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from adloom.functions import clean
from adloom.plans import star
from adloom.sinks import warehouse
from adloom.sources.messages import parse_payload

Tables = dict[str, DataFrame]

#: (platform, report type) → tables built from that report.
ROUTES: dict[tuple[str, str], Callable[[DataFrame], Tables]] = {
    ("facebook", "ad_daily"): star.ad_daily_tables,
    ("facebook", "ad_creative"): star.creative_tables,
    ("facebook", "age_gender"): star.demographic_tables,
}


def route(messages: DataFrame, platform: str, report_type: str) -> DataFrame:
    """The decoded messages of one report type."""
    return messages.filter((F.col("platform") == platform) & (F.col("report_type") == report_type))


def routed_report(messages: DataFrame, platform: str, report_type: str) -> DataFrame:
    """The cleaned report of one type; the envelope's ingest time is the version of its rows.

    A later restatement of a key therefore wins, whatever the order in which batches arrive.
    """
    rows = parse_payload(route(messages, platform, report_type), report_type)
    return star.normalise(rows.withColumn("updated_at", F.try_to_timestamp("ingested_at")))


def build_tables(messages: DataFrame) -> Tables:
    """Every warehouse table fed by a frame of decoded messages; the same for batch and stream."""
    tables: Tables = {}
    for (platform, report_type), build in ROUTES.items():
        tables.update(build(routed_report(messages, platform, report_type)))
    return tables


def write_batch(warehouse_root: str) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that writes one micro-batch to all its tables.

    The source is read once and each payload parsed once: the decoded batch and the report
    in hand stay cached while their tables are written; their size is bounded by the source's
    limit per trigger. The load id is the epoch, so a batch replayed after a failure
    overwrites its own rows. An error stops the query, and the checkpoint does not advance
    past an unwritten batch.
    """

    def write(batch: DataFrame, epoch: int) -> None:
        load_id = f"epoch-{epoch:012d}"
        batch.persist()
        try:
            for (platform, report_type), build in ROUTES.items():
                report = routed_report(batch, platform, report_type).persist()
                try:
                    if report.isEmpty():
                        continue
                    for table, frame in build(report).items():
                        warehouse.append(frame, warehouse_root, table, load_id)
                finally:
                    report.unpersist()
        finally:
            batch.unpersist()

    return write


def timed(messages: DataFrame, delay: str) -> DataFrame:
    """Decoded messages with ``event_time`` (the envelope's ingest time) and a watermark of ``delay``.

    Messages without a readable time have no place in event time and are left out; any stand-in
    would be late itself or make others late. The raw archive keeps them (``undated``).
    """
    dated = messages.withColumn("event_time", F.try_to_timestamp("ingested_at")).where("event_time IS NOT NULL")
    return dated.withWatermark("event_time", delay)


def undated(messages: DataFrame) -> DataFrame:
    """Decoded messages without a readable ingest time."""
    return messages.where(F.try_to_timestamp("ingested_at").isNull())


def distinct_messages(messages: DataFrame, delay: str = "2 days") -> DataFrame:
    """A stream without redelivered messages: of equal envelopes only the first passes, in whatever micro-batch it comes.

    State holds a digest per message for ``delay`` beyond its event time, then lets it go, so it is
    bounded by the traffic of that time and survives restarts with the checkpoint. A repeat later
    than that is late by the watermark and dropped as such.
    """
    parts = [F.coalesce(F.col(c), F.lit("\0")) for c in ("platform", "report_type", "ingested_at", "raw_data")]
    digest = F.sha2(F.concat_ws("\1", *parts), 256)
    kept = timed(messages, delay).withColumn("__digest", digest).dropDuplicatesWithinWatermark(["__digest"])
    return kept.drop("__digest", "event_time")


def windowed_sums(messages: DataFrame, width: str = "1 day", delay: str = "2 days") -> DataFrame:
    """Sums per event-time window and route: (window_start, window_end, platform, report_type, records, spend, clicks).

    In append mode a window is given once, when the watermark has passed its end; state holds
    the open windows only. Rows later than that are dropped and counted (``late_rows``).
    """
    fields = F.from_json("raw_data", "spend string, clicks string")
    rows = timed(messages, delay).select(
        "event_time", "platform", "report_type", clean.to_money(fields["spend"]).alias("spend"), clean.to_int(fields["clicks"], target="bigint").alias("clicks")
    )
    grouped = rows.groupBy(F.window("event_time", width), "platform", "report_type")
    sums = grouped.agg(F.count(F.lit(1)).alias("records"), F.sum("spend").alias("spend"), F.sum("clicks").alias("clicks"))
    return sums.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *sums.columns[1:])


def late_rows(query: StreamingQuery) -> int:
    """Rows a query has dropped behind its watermark, over the progress reports it still holds."""
    return sum(op["numRowsDroppedByWatermark"] for progress in query.recentProgress for op in progress["stateOperators"])


def start_files(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append a stream to parquet files until caught up; a restart with the same checkpoint goes on where it stopped."""
    writer = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    return writer.outputMode("append").trigger(availableNow=True).start()


def start_archive(messages: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append decoded messages to the raw zone, by platform and report type, until caught up."""
    return (
        messages.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .partitionBy("platform", "report_type")
        .trigger(availableNow=True)
        .start()
    )


def start_router(messages: DataFrame, warehouse_root: str, checkpoint: str) -> StreamingQuery:
    """Route decoded messages into the warehouse until caught up."""
    return (
        messages.writeStream.foreachBatch(write_batch(warehouse_root))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def run_stream(messages: DataFrame, raw_zone: str, warehouse_root: str, checkpoints: str) -> None:
    """Run the archive and the router side by side and wait for both; the first error is raised."""
    queries = [
        start_archive(messages, raw_zone, f"{checkpoints.rstrip('/')}/raw_zone"),
        start_router(messages, warehouse_root, f"{checkpoints.rstrip('/')}/warehouse"),
    ]
    for query in queries:
        query.awaitTermination()
