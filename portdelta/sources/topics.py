"""Message topics. The connector is a format name plus options; its jar is the cluster's matter."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def pulsar_options(
    service_url: str,
    topic: str,
    subscription: str | None = None,
    starting_offsets: str = "latest",
    tls: dict[str, str] | None = None,
) -> dict[str, str]:
    """Reader options of the topic connector. ``tls`` holds ``cert``, ``key`` and ``trust`` paths."""
    out = {"service.url": service_url, "topic": topic, "startingOffsets": starting_offsets}
    if subscription:
        out["predefinedSubscription"] = subscription
    if tls:
        out["pulsar.client.authPluginClassName"] = "org.apache.pulsar.client.impl.auth.AuthenticationTls"
        out["pulsar.client.authParams"] = f"tlsCertFile:{tls['cert']},tlsKeyFile:{tls['key']}"
        out["pulsar.client.tlsTrustCertsFilePath"] = tls["trust"]
        out["pulsar.client.tlsAllowInsecureConnection"] = "false"
    return out


def kafka_options(
    servers: str,
    topic: str,
    starting_offsets: str = "latest",
    protocol: str = "PLAINTEXT",
    sasl_mechanism: str | None = None,
    jaas: str | None = None,
    endpoint_identification: str | None = None,
    fail_on_data_loss: bool = False,
    write: bool = False,
) -> dict[str, str]:
    """Options of the broker connector, for reading or (``write``) for writing."""
    out = {"kafka.bootstrap.servers": servers, "kafka.security.protocol": protocol.upper()}
    if write:
        out["topic"] = topic
    else:
        out["subscribe"] = topic
        out["startingOffsets"] = starting_offsets
        out["failOnDataLoss"] = str(fail_on_data_loss).lower()
    if sasl_mechanism:
        out["kafka.sasl.mechanism"] = sasl_mechanism
    if jaas:
        out["kafka.sasl.jaas.config"] = jaas
    if endpoint_identification is not None:
        out["kafka.ssl.endpoint.identification.algorithm"] = endpoint_identification
    return out


def read_topic(
    spark: SparkSession, fmt: str, options: dict[str, str], schema: T.StructType | None = None
) -> DataFrame:
    """Streaming source of any format; file formats need ``schema`` and an option ``path``.

    Offsets belong to the query's checkpoint, so a message counts as used only after its
    micro-batch has been written.
    """
    reader = spark.readStream.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load()
