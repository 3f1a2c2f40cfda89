"""Event stream to landing files, partitioned by entity and hour."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

# Batch cap and trigger of the event ingest.
MAX_EVENTS_PER_TRIGGER = 10_000
TRIGGER_INTERVAL = "30 seconds"

MESSAGE_SCHEMA = "body binary, enqueuedTime timestamp, partitionKey string"
# Folders of landed messages, and columns of a message.
PARTITIONS = ("entity", "year", "month", "day", "hour")


def read_file_events(spark: SparkSession, path: str, *, fmt: str = "parquet", schema: str = MESSAGE_SCHEMA,
                     max_files_per_trigger: int = 100) -> DataFrame:
    """Messages dropped as files; each file is taken exactly once per checkpoint."""
    return (
        spark.readStream.format(fmt).schema(schema)
        .option("maxFilesPerTrigger", max_files_per_trigger).load(path)
    )


def read_kafka_events(spark: SparkSession, servers: str, topic: str, *,
                      max_events_per_trigger: int = MAX_EVENTS_PER_TRIGGER, **options: str) -> DataFrame:
    """Messages from a Kafka-compatible event hub, from the earliest offset on."""
    raw = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers).option("subscribe", topic)
        .option("startingOffsets", "earliest").option("maxOffsetsPerTrigger", max_events_per_trigger)
        .options(**options).load()
    )
    return raw.select(
        F.col("value").alias("body"), F.col("timestamp").alias("enqueuedTime"),
        F.col("key").cast("string").alias("partitionKey"),
    )


def entity_of(partition_key: Column, json_body: Column) -> Column:
    """Routing key: the partition key, else the ``_entity`` field of the message."""
    return F.coalesce(partition_key, F.get_json_object(json_body, "$._entity"))


def time_parts(moment: Column) -> dict[str, Column]:
    patterns = {"year": "yyyy", "month": "MM", "day": "dd", "hour": "HH"}
    return {name: F.date_format(moment, p) for name, p in patterns.items()}


def route(messages: DataFrame) -> DataFrame:
    """Decode, route and date the messages. Works on a stream and on a batch frame."""
    decoded = messages.select(
        F.col("body").cast("string").alias("json_body"),
        F.col("enqueuedTime").alias("enqueued_time"),
        "partitionKey",
    )
    return decoded.withColumn("entity", entity_of(F.col("partitionKey"), F.col("json_body"))).drop(
        "partitionKey"
    ).withColumns(time_parts(F.col("enqueued_time")))


def start_landing(messages: DataFrame, path: str, checkpoint: str, *, available_now: bool = False,
                  trigger: str = TRIGGER_INTERVAL, name: str | None = None) -> StreamingQuery:
    """Append routed messages as partitioned JSON files."""
    writer = (
        route(messages).writeStream.format("json").outputMode("append")
        .partitionBy(*PARTITIONS).option("path", path).option("checkpointLocation", checkpoint)
    )
    if name:
        writer = writer.queryName(name)
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=trigger)).start()


def landed_messages(spark: SparkSession, path: str, entity: str, message_schema: str) -> DataFrame:
    """Messages of one entity from the landing files, parsed by a schema."""
    landed = spark.read.schema(
        "json_body string, enqueued_time timestamp, entity string, year string, month string, day string, hour string"
    ).json(path)
    return landed.filter(F.col("entity") == entity).select(
        F.from_json("json_body", message_schema).alias("m"), "enqueued_time"
    ).select("m.*", "enqueued_time")
