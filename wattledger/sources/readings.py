"""The reading stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wattledger.schemas import ENVELOPE
from wattledger.settings import Settings


def source_readings_stream(
    spark: SparkSession,
    location: str,
    settings: Settings,
    fmt: str = "parquet",
    options: dict[str, str] | None = None,
) -> DataFrame:
    """Unbounded messages (value, partition, offset).

    For Kafka `location` is the topic and `options` carries `kafka.bootstrap.servers`; a new query
    starts at the earliest offset and a restarted one at its checkpoint. Other formats read
    message files from a folder; `maxFilesPerTrigger` limits a micro-batch there.
    """
    reader = spark.readStream.format(fmt)
    if fmt == "kafka":
        reader = reader.options(
            subscribe=location,
            startingOffsets="earliest",
            failOnDataLoss="false",
            maxOffsetsPerTrigger=str(settings.max_offsets_per_trigger),
        )
        stream = reader.options(**(options or {})).load()
    else:
        stream = reader.schema(ENVELOPE).options(**(options or {})).load(location)
    return stream.select("value", "partition", "offset")
