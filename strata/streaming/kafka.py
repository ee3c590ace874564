"""Kafka-protocol source options (SRC-2, SRC-3, STR-7).

The connector jar is not part of this image, so the source is built only when it is present;
tests exercise the option helpers as plain dictionaries and run the same decode pipeline on a
file stream.
"""

from __future__ import annotations

from urllib.parse import urlparse

from pyspark.sql import DataFrame, SparkSession

# The SASL endpoint port of a connection-string broker, and the PLAIN login module
# of the Kafka client that open-source Spark's connector ships (runtimes that relocate the client
# pass their own class name).
KAFKA_SASL_PORT = 9093
PLAIN_LOGIN_MODULE = "org.apache.kafka.common.security.plain.PlainLoginModule"


def namespace_host(connection_string: str) -> str:
    """The broker host named by the ``Endpoint`` entry of a ``key=value;...`` connection string (SRC-3)."""
    fields = dict(part.split("=", 1) for part in connection_string.split(";") if "=" in part)
    endpoint = fields.get("Endpoint")
    if not endpoint:
        raise ValueError("connection string has no Endpoint")
    return urlparse(endpoint).hostname or endpoint


def kafka_options(
    connection_string: str,
    topic: str,
    starting_offsets: str = "earliest",
    fail_on_data_loss: bool = False,
    max_offsets_per_trigger: int | None = None,
    login_module: str = PLAIN_LOGIN_MODULE,
) -> dict[str, str]:
    """SASL_SSL / PLAIN options for a connection-string authenticated broker (SRC-2, STR-7).

    ``max_offsets_per_trigger`` bounds each micro-batch; ``availableNow`` still drains the whole
    backlog, in several bounded batches instead of one (a first run over a day of retention).
    """
    host = namespace_host(connection_string)
    jaas = f'{login_module} required username="$ConnectionString" password="{connection_string}";'
    opts = {
        "kafka.bootstrap.servers": f"{host}:{KAFKA_SASL_PORT}",
        "kafka.sasl.mechanism": "PLAIN",
        "kafka.security.protocol": "SASL_SSL",
        "kafka.sasl.jaas.config": jaas,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
        "failOnDataLoss": str(bool(fail_on_data_loss)).lower(),
    }
    if max_offsets_per_trigger:
        opts["maxOffsetsPerTrigger"] = str(int(max_offsets_per_trigger))
    return opts


def kafka_stream(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """``readStream.format("kafka")`` with the given options (needs the connector on the classpath)."""
    return spark.readStream.format("kafka").options(**options).load()
