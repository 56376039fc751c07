"""Records: rows of (topic, part, off, ts, value), from tables and from streams."""

from __future__ import annotations

from typing import TYPE_CHECKING

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftvault.sources.push import push_stream
from driftvault.sources.stores import Store

if TYPE_CHECKING:
    from driftvault.plans.config import Config

#: A view of the events table as records, in expressions that Spark and ANSI engines read alike. Payloads of all
#: kinds come up: text that is no JSON, organisations that are null, blank, absent, an object, in need of encoding,
#: numbers, booleans, and nesting one level too deep.
EVENT_RECORDS = {
    "event_id": "event_id",
    "topic": "CASE event_id % 11 WHEN 0 THEN 'web_land' WHEN 1 THEN 'web_load' WHEN 2 THEN '' ELSE 'events' END",
    "part": "CAST(event_id % 4 AS INT)",
    "off": "CAST(floor(event_id / 4) AS BIGINT)",
    "ts": "ts",
    "value": """CASE event_id % 50
        WHEN 7 THEN concat('event ', event_id)
        WHEN 8 THEN concat('{"_org_id":null,"id":', event_id, '}')
        WHEN 9 THEN concat('{"_org_id":"  ","id":', event_id, '}')
        WHEN 10 THEN concat('{"_org_id":{"name":"acme"},"id":', event_id, '}')
        WHEN 11 THEN concat('{"id":', event_id, ',"event_type":"', event_type, '"}')
        WHEN 12 THEN concat('{"_org_id":"a/b","id":', event_id, ',"tags":{"category":"sec"}}')
        WHEN 13 THEN concat('{"_org_id":"..","id":', event_id, '}')
        WHEN 14 THEN concat('{"_org_id":42,"id":', event_id, '}')
        WHEN 15 THEN concat('{"_org_id":true,"id":', event_id, '}')
        WHEN 16 THEN concat('{"_org_id":"deep","x":', repeat('[', 64), repeat(']', 64), '}')
        ELSE concat('{"_org_id":"org-', user_id % 7, '","event_type":"', event_type, '","id":', event_id,
                    ',"tags":{"category":"c', event_id % 3, '"},"props":', props, '}') END""",
}


def event_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet").selectExpr(*[f"{e} AS {c}" for c, e in EVENT_RECORDS.items()])


def kafka_options(config: Config) -> dict[str, str]:
    """The options of Spark's Kafka source for a configuration: named topics, or all of them, whose list is read anew
    every topic_refresh_secs; which of those are wanted is the pipeline's choice."""
    k = config.kafka
    options = {
        "kafka.bootstrap.servers": ",".join(k.brokers), "maxOffsetsPerTrigger": str(k.batch_size), "kafka.group.id": k.group_id,
        "kafka.security.protocol": k.security_protocol, "kafka.metadata.max.age.ms": str(1000 * k.topic_refresh_secs),
    }
    options |= {"subscribe": ",".join(k.topics)} if k.topics else {"subscribePattern": ".*"}
    if k.ssl_ca_location:
        options |= {"kafka.ssl.truststore.type": "PEM", "kafka.ssl.truststore.location": k.ssl_ca_location}
    if k.sasl_mechanism:
        module = "scram.ScramLoginModule" if k.sasl_mechanism.startswith("SCRAM") else "plain.PlainLoginModule"
        options["kafka.sasl.mechanism"] = k.sasl_mechanism
        options["kafka.sasl.jaas.config"] = f'org.apache.kafka.common.security.{module} required username="{k.sasl_username}" password="{k.sasl_password}";'
    return options


def stream_of(spark: SparkSession, config: Config, folder: str | None = None, log: Store | str | None = None) -> DataFrame:
    """The stream of records that a configuration names: brokers' topics, which needs Spark's Kafka connector on the
    class path, or, for the direct transport, what producers append to a log or put in a landing folder."""
    if config.is_direct():
        if log is not None:
            return push_stream(spark, log)
        if folder is None:
            raise ValueError("the direct transport reads a log or a landing folder")
        return landing_stream(spark, folder)
    return as_records(spark.readStream.format("kafka").options(**kafka_options(config)).load())


def as_records(df: DataFrame) -> DataFrame:
    """Columns of Kafka's source as records."""
    return df.select("topic", F.col("partition").alias("part"), F.col("offset").alias("off"), F.col("timestamp").alias("ts"), "value")


def landing_stream(spark: SparkSession, folder: str, max_files: int = 100) -> DataFrame:
    """A stream of records from Parquet files that producers put in a folder: the push way in."""
    schema = "topic string, part int, off long, ts timestamp, value string"
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(folder)
