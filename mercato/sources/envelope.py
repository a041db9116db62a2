"""Message envelopes: reading them as a stream, packing records in, parsing records out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato import schemas


def kafka_options(
    topics: list[str] | tuple[str, ...] | str,
    servers: str,
    starting: str = "latest",
    max_per_trigger: int | None = None,
) -> dict[str, str]:
    """Reader options for one topic or several; offsets then live in the checkpoint.

    ``max_per_trigger`` limits the messages of a batch; without it a batch takes all there are.
    """
    names = [topics] if isinstance(topics, str) else list(topics)
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": ",".join(names),
        "startingOffsets": starting,
        "failOnDataLoss": "false",
    }
    if max_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_per_trigger)
    return options


def read_kafka(spark: SparkSession, topics, servers: str, **settings) -> DataFrame:
    """Streaming envelope rows from a broker (needs the Kafka connector on the class path)."""
    return spark.readStream.format("kafka").options(**kafka_options(topics, servers, **settings)).load()


def read_envelope_files(
    spark: SparkSession, folder: str, max_files: int | None = None, topic: str | None = None
) -> DataFrame:
    """The same rows from envelope files that land in a folder, rate-limited by file."""
    reader = spark.readStream.schema(schemas.ENVELOPE)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    rows = reader.parquet(folder)
    return rows if topic is None else rows.filter(F.col("topic") == topic)


def to_envelope(
    records: DataFrame,
    topic: str,
    key: str,
    body: list[str],
    partition: Column | None = None,
    offset: Column | None = None,
    at: Column | None = None,
) -> DataFrame:
    """Pack the ``body`` columns of each record as one JSON message keyed by its id.

    A broker fills in partition, offset and time itself; files need them given.
    """
    return records.select(
        F.col(key).cast("binary").alias("key"),
        F.to_json(F.struct(*body)).cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
        (F.lit(None) if partition is None else partition).cast("int").alias("partition"),
        (F.lit(None) if offset is None else offset).cast("bigint").alias("offset"),
        (F.current_timestamp() if at is None else at).cast("timestamp").alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )


def write_kafka(records: DataFrame, servers: str, topic: str, checkpoint: str):
    """Publish a streaming envelope to a broker."""
    return (
        records.select("key", "value")
        .writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
        .start()
    )


def parse_envelope(envelope: DataFrame, record_ddl: str, keep_source: bool = True, once: bool = False) -> DataFrame:
    """Typed records plus delivery metadata.

    A body that is not valid JSON gives an all-null record; ``json_str`` keeps its text so
    the raw layer loses nothing. Spark moves filters on fields below the parsing and parses again for
    each field they name; for callers that filter, ``once`` parses every message once, as filters are
    not moved below a generator.
    """
    text = F.col("value").cast("string")
    record = F.from_json(text, record_ddl)
    parsed = envelope.select(
        F.inline(F.array(record)) if once else record.alias("record"),
        F.col("topic").alias("kafka_topic"),
        F.col("partition").alias("kafka_partition"),
        F.col("offset").alias("kafka_offset"),
        F.col("timestamp").alias("kafka_timestamp"),
        text.alias("json_str"),
    )
    metadata = ["kafka_topic", "kafka_partition", "kafka_offset", "kafka_timestamp"]
    fields = [c for c in parsed.columns if c not in (*metadata, "json_str")] if once else ["record.*"]
    return parsed.select(*fields, *metadata, *(["json_str"] if keep_source else []))
