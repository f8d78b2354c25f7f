"""Messages: turning feed documents into messages, reading topics and parsing message text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SENTINEL = "Invalid data provided."  # fixed value: what the feed sends in place of a document


def read_topic(spark: SparkSession, servers: str, topic: str, max_offsets: int = 1_000_000) -> DataFrame:
    """Message text of a Kafka topic as a stream; a micro-batch takes at most ``max_offsets``.

    Needs the Kafka connector on the class path.
    """
    stream = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("maxOffsetsPerTrigger", max_offsets)
        .load()
    )
    return stream.select(F.col("value").cast("string").alias("value"))


def read_message_files(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Message text of landed files, one message per line, as a stream."""
    reader = spark.readStream.format("text")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def read_table_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """A Parquet table as a stream, with the schema that its files declare.

    The path is given as a pattern that only matches itself, which file streams accept for a
    folder and for a single file alike.
    """
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(f"{path[:-1]}[{path[-1]}]")


def event_messages(documents: DataFrame, document: str = "document") -> DataFrame:
    """One message per event of nested event documents, the match id added to each event."""
    return (
        documents.select(F.explode(F.col(f"{document}.matches")).alias("matchId", "__match"))
        .select("matchId", F.explode(F.map_values("__match.events")).alias("__event"))
        .select(F.to_json(F.struct("__event.*", "matchId")).alias("value"))
    )


def as_messages(text: Column, schema: T.DataType) -> Column:
    """Array of messages from a document that is one message or a list of them."""
    is_list = F.trim(text).startswith("[")
    many = F.from_json(text, T.ArrayType(schema))
    one = F.array(F.from_json(text, schema))
    return F.transform(F.when(is_list, many).otherwise(one), lambda m: F.to_json(m))


def split_messages(messages: DataFrame, schema: T.StructType, value: str = "value") -> DataFrame:
    """Add the parsed ``message`` and whether the text is one JSON object, as it has to be.

    Kept apart so that the filter on the second reads the text once and the rows that pass it
    are parsed once.
    """
    return messages.withColumns(
        {
            "is_object": F.json_object_keys(F.col(value)).isNotNull(),
            "message": F.from_json(F.col(value), schema),
        }
    )


def accepted(parsed: DataFrame) -> DataFrame:
    return parsed.filter("is_object").drop("is_object")


def unreadable(value: str = "value") -> Column:
    """Why a message is no JSON object."""
    return F.when(F.col(value).contains(SENTINEL), "no data").otherwise("not a JSON object")


def rejected(parsed: DataFrame, value: str = "value") -> DataFrame:
    """Messages that are no JSON object, for a dead-letter table; the sentinel is among them."""
    return parsed.filter(~F.col("is_object")).select(value, unreadable(value).alias("reason"))
