"""Kafka sources. They need the connector on the class path, for example
``--packages org.apache.spark:spark-sql-kafka-0-10_2.13:4.1.2``."""

from pyspark.sql import functions as F


def _given(**options):
    return {name: str(value) for name, value in options.items() if value}


def stream_options(settings, topic, starting="latest", max_offsets=None, min_partitions=None,
                   group_id=None):
    """``starting`` counts for the first start only; later the checkpoint decides.
    ``max_offsets`` bounds a batch, ``min_partitions`` splits wide topic partitions."""
    return (settings.consumer_options()
            | {"subscribe": topic, "startingOffsets": starting}
            | _given(maxOffsetsPerTrigger=max_offsets, minPartitions=min_partitions)
            | _given(**{"kafka.group.id": group_id}))


def batch_options(settings, topic, min_partitions=None, group_id=None):
    return (settings.consumer_options()
            | {"subscribe": topic, "startingOffsets": "earliest", "endingOffsets": "latest"}
            | _given(minPartitions=min_partitions)
            | _given(**{"kafka.group.id": group_id}))


def stream_topic(spark, settings, topic, **limits):
    return spark.readStream.format("kafka").options(
        **stream_options(settings, topic, **limits)).load()


def read_topic(spark, settings, topic, **limits):
    """Everything the topic holds now, decoded."""
    rows = spark.read.format("kafka").options(
        **batch_options(settings, topic, **limits)).load()
    return decode_rows(rows)


def decode_rows(rows):
    """Key and value as text. A null key stays null."""
    return rows.withColumns({c: F.col(c).cast("string") for c in ("key", "value")})
