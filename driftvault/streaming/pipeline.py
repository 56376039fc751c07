"""The archiving pipeline on Structured Streaming.

One micro-batch is one roll window: every file that it opens is whole before the batch is committed. Offsets are the
checkpoint's; a batch that is run again writes files of the same names and replaces its own part of the tables, so
nothing is lost and nothing is found twice.
"""

from __future__ import annotations

import datetime as dt
import logging
import time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from driftvault.functions.templates import expand_template
from driftvault.operators import archive, delivery, topics
from driftvault.operators.batching import roll_window
from driftvault.operators.routing import route
from driftvault.plans.config import Config
from driftvault.streaming import dead_letters, hold

log = logging.getLogger(__name__)


def chosen(records: DataFrame, config: Config, known: DataFrame | None = None) -> DataFrame:
    """The records whose topic is wanted; of `<name>_land` and `<name>_load` only the first, where both come up or are
    among the topics known from earlier batches."""
    kafka = config.kafka
    exclude = topics.INTERNAL_TOPICS if kafka.topic_exclude is None else tuple(kafka.topic_exclude)
    if kafka.topics:
        return records.filter(F.col("topic").isin(kafka.topics))
    if config.is_direct():
        return records
    wanted = topics.select_topics(records, tuple(kafka.topic_include), exclude)
    return topics.prefer_landing(wanted, known=known)


def catalogue(records: DataFrame, config: Config, batch: int) -> DataFrame | None:
    """The landing topics of this batch and of those before it. A batch adds what is new in it, as a whole, so a batch
    that is run again finds what it found before; later batches do not count."""
    if config.kafka.topics or config.is_direct():
        return None
    spark, options, folder = records.sparkSession, config.hadoop_options(), config.tables("_meta/topics")
    wanted = topics.select_topics(records, tuple(config.kafka.topic_include), topics.INTERNAL_TOPICS if config.kafka.topic_exclude is None else tuple(config.kafka.topic_exclude))
    landing = wanted.select("topic").filter(F.col("topic").endswith("_land")).distinct()
    read = lambda: spark.read.options(**options).schema("topic string, batch long").parquet(folder).filter(F.col("batch") <= batch)
    if config.store().open().exists("_meta/topics"):
        landing = landing.join(read().filter(F.col("batch") < batch), "topic", "left_anti")
    landing.coalesce(1).write.mode("overwrite").options(**options).parquet(f"{folder}/batch={batch}")
    return read()


def batch_time(config: Config, run: str, batch: int) -> dt.datetime:
    """When a batch was run first: records without a time have this one, so that they keep their window and file when
    the batch is run again."""
    files, path = config.store().open(), f"_meta/times/{run}/{batch}"
    if not files.exists(path):
        out = files.create(path)
        out.write(dt.datetime.now(dt.UTC).isoformat().encode())
        try:
            out.close()
        except FileExistsError:
            log.info("another attempt at batch %s has kept its time", batch)
    with files.read(path) as kept:
        return dt.datetime.fromisoformat(kept.read().decode())


def prepare(records: DataFrame, config: Config, drop: Column | None = None, reject: Column | None = None, now: dt.datetime | None = None) -> DataFrame:
    """records routed, with their roll window and their file's key as far as the store's limits go. drop, reject:
    conditions of an inbound filter; what they hold for is not archived (`inbound`: `drop` or `reject`). now: the time of
    records that have none."""
    inbound = F.lit(None).cast("string")
    if reject is not None:
        inbound = F.when(F.coalesce(reject, F.lit(False)), "reject").otherwise(inbound)
    if drop is not None:
        inbound = F.when(F.coalesce(drop, F.lit(False)), "drop").otherwise(inbound)
    routed = route(records.withColumn("inbound", inbound), config.routing.mode, config.effective_fields(), config.routing.default_segment, config.transport)
    at = F.coalesce("ts", F.lit(now) if now is not None else F.current_timestamp())
    routed = routed.withColumns({"ts": at, "window": roll_window(at, config.roll_interval_secs())})
    folder = expand_template(config.archive.path_template.replace("{seq}", "0000"), F.col("window"))
    # number, token and extensions take less than 48 bytes more
    return routed.withColumn("key", F.concat("destination", F.lit("/"), folder, F.lit("-" + "0" * 47)))


def archive_batch(records: DataFrame, config: Config, run: str, batch: int, drop: Column | None = None, reject: Column | None = None) -> None:
    """Archives one batch: files and their manifest, then dead letters and outcomes, each replaced as a whole."""
    spark, options = records.sparkSession, config.hadoop_options()
    at = f"batch={batch}"
    prepared = prepare(chosen(records, config, catalogue(records, config, batch)), config, drop, reject, batch_time(config, run, batch))
    ledger = delivery.outcomes(prepared, config.dead_letters_kept(), config.dead_letter_limit()).persist()
    try:
        done = archive.write_archive(
            ledger.filter("status = 'delivered'"), config.store().below("data"), f"{run}/{batch}", config.layout(), config.limits(), config.buffer.writer_tasks,
            manifest=config.store().below(f"_meta/manifest/{at}"), read_from=config.tables(f"_meta/manifest/{at}"), options=options,
        )
        ledger = delivery.with_refusals(ledger, done, config.dead_letters_kept(), config.dead_letter_limit())
        if config.dead_letters_kept():
            dead_letters.write(delivery.dead_letters(ledger, max_payload_bytes=config.dlq.max_payload_bytes), config, batch)
        ledger.select("topic", "part", "off", "destination", "fallback_fields", "routing_error", "status", "reason").write.mode("overwrite").options(**options).parquet(
            config.tables(f"_meta/outcomes/{at}")
        )
    finally:
        ledger.unpersist()


def _run_name(spark: SparkSession, run: str) -> str:
    """The run's name with the streaming query's own id, which a checkpoint keeps: two runs never share a file name."""
    return f"{run}/{spark.sparkContext.getLocalProperty('sql.streaming.queryId') or ''}"


def start(
    records: DataFrame, config: Config, checkpoint: str, run: str = "archive", available_now: bool = False, drop: Column | None = None, reject: Column | None = None
) -> StreamingQuery:
    """Archives a stream of records (topic, part, off, ts, value) until it is stopped. Without acknowledgements a
    batch counts as read when it is received: a sink that fails costs its records, and the stream goes on. With
    buffer.hold a batch comes every flush_age_secs, and records are held over batches until their file's time has come;
    what is held when the stream stops is archived when it goes on."""
    config.validate()
    if reason := config.idle_reason():
        raise ValueError(reason)
    if config.buffer.hold and available_now:
        raise ValueError("buffer.hold keeps records for a time to come, so a run that ends cannot archive all of them")
    if problem := config.store().probe():
        log.warning("the destination cannot be listed: %s", problem)
    if seconds := config.long_held_roll_interval():
        log.warning("offsets wait %s seconds for their files to close", seconds)

    def one(df: DataFrame, batch: int) -> None:
        try:
            archive_batch(df, config, _run_name(df.sparkSession, run), batch, drop, reject)
            if config.dead_letters_kept() and config.dlq.file.enabled:
                dead_letters.expire(config)
        except Exception:
            if config.is_acknowledged():
                raise
            log.exception("batch %s is lost: acknowledgements are off", batch)

    held = hold.hold(records, config) if config.buffer.hold else records
    writer = held.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint)
    seconds = min(config.buffer.flush_age_secs, config.roll_interval_secs()) if config.buffer.hold else config.roll_interval_secs()
    trigger = {"availableNow": True} if available_now else {"processingTime": f"{seconds} seconds"}
    return writer.trigger(**trigger).start()


def reload(query: StreamingQuery, records: DataFrame, old: Config, new: Config, checkpoint: str, **options) -> StreamingQuery:
    """The query under a new configuration: it goes on as it is where nothing changed, else it is stopped and begun again
    from its checkpoint, for a new kafka.batch_size after the batch at hand. records: the stream as `new` reads it."""
    sections = old.restart_required(new)
    if not sections and old.kafka.batch_size == new.kafka.batch_size:
        return query
    log.info("restarting for changes of %s", ", ".join(sections) or "kafka.batch_size")
    if not sections and query.isActive:
        _await_batch(query)
    query.stop()
    return start(records, new, checkpoint, **options)


def _await_batch(query: StreamingQuery, seconds: float = 600.0) -> None:
    """Returns when no batch is being worked on."""
    until = time.monotonic() + seconds
    while query.isActive and query.status["isTriggerActive"] and time.monotonic() < until:
        time.sleep(0.05)


def manifest(spark: SparkSession, config: Config) -> DataFrame:
    return archive.read_manifest(spark, config.tables("_meta/manifest"), config.hadoop_options())


def restored(spark: SparkSession, config: Config) -> DataFrame:
    """Every archived record."""
    return archive.restore(manifest(spark, config).filter("path IS NOT NULL"), config.store().below("data"), config.codec())


def audit(spark: SparkSession, config: Config) -> DataFrame:
    """The archive's files held against its manifest, as archive.compare_with_files gives them."""
    return archive.compare_with_files(manifest(spark, config).filter("path IS NOT NULL"), config.store().below("data").list(spark))
