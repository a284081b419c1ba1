"""Kafka source and sink options and frames (the connector package is the cluster's)."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass, fields

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter

from assetlake.streaming import messages
from assetlake.streaming.sinks import keyed_json


@dataclass(frozen=True)
class KafkaSettings:
    bootstrap_servers: Sequence[str] = ("localhost:9092",)
    topic_name: str = "sensor-data"
    consumer_group_id: str = "predictive-maintenance-group"
    auto_offset_reset: str = "earliest"
    security_protocol: str | None = None
    sasl_mechanism: str | None = None
    sasl_username: str | None = None
    sasl_password: str | None = None

    @classmethod
    def from_json(cls, text: str) -> KafkaSettings:
        known = {f.name for f in fields(cls)}
        return cls(**{k: v for k, v in json.loads(text).items() if k in known})

    def _common(self) -> dict[str, str]:
        options = {"kafka.bootstrap.servers": ",".join(self.bootstrap_servers)}
        if self.security_protocol:
            login = "org.apache.kafka.common.security.plain.PlainLoginModule"
            options["kafka.security.protocol"] = self.security_protocol
            options["kafka.sasl.mechanism"] = self.sasl_mechanism or "PLAIN"
            options["kafka.sasl.jaas.config"] = (
                f'{login} required username="{self.sasl_username}" password="{self.sasl_password}";'
            )
        return options

    def source_options(self, max_offsets: int | None = None) -> dict[str, str]:
        """Offsets live in the query's checkpoint, so nothing is committed before its batch is written."""
        options = {
            **self._common(),
            "subscribe": self.topic_name,
            "startingOffsets": self.auto_offset_reset,
            "groupIdPrefix": self.consumer_group_id,
            "failOnDataLoss": "true",
        }
        if max_offsets:
            options["maxOffsetsPerTrigger"] = str(max_offsets)
        return options

    def sink_options(self, topic: str | None = None) -> dict[str, str]:
        return {**self._common(), "topic": topic or self.topic_name}


def read_messages(spark: SparkSession, settings: KafkaSettings, max_offsets: int | None = None) -> DataFrame:
    stream = spark.readStream.format("kafka").options(**settings.source_options(max_offsets)).load()
    return messages.parse(stream)


def write_messages(df: DataFrame, settings: KafkaSettings, checkpoint: str, topic: str | None = None) -> DataStreamWriter:
    """Writer of keyed JSON messages; the caller starts it."""
    writer = keyed_json(df).writeStream.format("kafka").options(**settings.sink_options(topic))
    return writer.option("checkpointLocation", checkpoint)
