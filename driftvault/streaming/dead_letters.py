"""Where dead letters go: newline-delimited JSON in folders by period, a topic, or both."""

from __future__ import annotations

import datetime as dt
import logging

from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftvault.plans.config import Config
from driftvault.sources.stores import Store

log = logging.getLogger(__name__)
#: How the name of a period is built from a time.
PERIODS = {"hourly": "yyyy-MM-dd'T'HH", "daily": "yyyy-MM-dd"}


def folder(config: Config) -> str:
    return config.dlq.file.path or config.tables("_meta/dead_letters")


def write_files(entries: DataFrame, config: Config, batch: int) -> None:
    """One line of JSON for each entry (payloads as delivery.dead_letters encodes them), below period=.../batch=...; a period is the hour or day of the records' own
    time, so a batch that is run again replaces exactly what it wrote before."""
    rows = entries.withColumns({
        "period": F.date_format(F.coalesce("ts", F.lit(dt.datetime(1970, 1, 1))), PERIODS[config.dlq.file.rotation]), "batch": F.lit(batch),
    })
    out = rows.drop("ts").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("period", "batch").options(**config.hadoop_options())
    out.option("compression", "gzip" if config.dlq.file.compress_rotated else "none").json(folder(config))


def write_topic(entries: DataFrame, config: Config) -> None:
    """A message for each entry, on the common topic or on one named after its destination. Needs Spark's Kafka connector."""
    topic = F.lit(config.dlq.kafka.common_topic)
    if config.dlq.kafka.routing == "per_table":
        topic = F.concat("destination", F.lit(config.dlq.kafka.topic_suffix))
    rows = entries.select(topic.alias("topic"), F.to_json(F.struct(*[c for c in entries.columns if c != "ts"])).alias("value"))
    rows.write.format("kafka").option("kafka.bootstrap.servers", ",".join(config.kafka.brokers)).save()


def write(entries: DataFrame, config: Config, batch: int) -> str:
    """Writes a batch's entries as the mode asks, before the batch is committed, and returns who took them: `cascade`
    tries the topic and falls back to files, `fan_out` needs one of the two to take all. A mode whose outputs all
    fail raises the last failure."""
    mode, d = config.dlq.mode, config.dlq
    outputs = {"topic": lambda: write_topic(entries, config), "files": lambda: write_files(entries, config, batch)}
    wanted = [n for n, on in (("topic", d.kafka.enabled and mode != "file_only"), ("files", d.file.enabled and mode != "kafka_only")) if on]
    took, failure = [], None
    for name in wanted:
        try:
            outputs[name]()
            took.append(name)
            if mode == "cascade":
                break
        except Exception as e:  # noqa: BLE001 - the next output is there for whatever this one fails with
            failure = e
            log.warning("the dead-letter output %s failed: %s", name, str(e)[:200])
    if not took and failure is not None:
        raise failure
    return ",".join(took)


def expire(config: Config, now: dt.datetime | None = None) -> list[str]:
    """Deletes the periods whose last file was written more than max_age_days ago, and returns their names."""
    files = (Store(config.dlq.file.path) if config.dlq.file.path else config.store().below("_meta/dead_letters")).open()
    oldest = (now or dt.datetime.now(dt.UTC)) - dt.timedelta(days=config.dlq.file.max_age_days)
    gone = []
    for info in files.store.get_file_info(fs.FileSelector(files.top, allow_not_found=True)):
        if not info.base_name.startswith("period="):
            continue
        below = files.store.get_file_info(fs.FileSelector(info.path, recursive=True))
        if all(i.mtime is not None and i.mtime < oldest for i in below if i.type == fs.FileType.File):
            files.store.delete_dir(info.path)
            gone.append(info.base_name.removeprefix("period="))
    return gone
