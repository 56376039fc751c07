import datetime as dt

import pytest

from pyspark.sql import functions as F

from driftvault.plans.config import Config, ConfigError
from driftvault.sources.records import kafka_options, landing_stream, stream_of
from driftvault.sources.stores import UnknownScheme, parse_destination
from driftvault.streaming import dead_letters, pipeline


def batch(spark, folder, start, n):
    rows = [("events", i % 2, i, dt.datetime(2024, 1, 1) + dt.timedelta(seconds=i), '{"_org_id":"o%d","n":%d}' % (i % 3, i) if i % 10 else "bad") for i in range(start, start + n)]
    rows.append(("events", 0, start + n, dt.datetime(2024, 1, 1), '{"x":' + "[" * 70 + "]" * 70 + "}"))
    spark.createDataFrame(rows, "topic string, part int, off long, ts timestamp, value string").coalesce(1).write.mode("append").parquet(folder)


def test_stream_archives_everything_once(spark, tmp_path):
    source, config = f"file://{tmp_path}/in", Config.load({"archive": {"destination": f"file://{tmp_path}/out"}, "buffer": {"flush_records": 7}}, {})
    for start in (0, 1000):
        batch(spark, source, start, 100)
        query = pipeline.start(landing_stream(spark, source), config, f"file://{tmp_path}/checkpoint", available_now=True)
        query.awaitTermination()
    got = pipeline.restored(spark, config)
    assert got.count() == 200 and got.select("value").distinct().count() == 200 - 20 + 1
    meta = f"file://{tmp_path}/out/_meta"
    letters = spark.read.json(f"{meta}/dead_letters")
    assert {(r.period, r.reason, r.reason_text, r.destination) for r in letters.collect()} == {("2024-01-01T00", "too_deep", "payload nesting exceeds the maximum parse depth of 64", "events")}
    assert letters.count() == 2 and {tuple(r) for r in spark.read.parquet(f"{meta}/outcomes").groupBy("status").count().collect()} == {("delivered", 200), ("rejected", 2)}
    assert {r.state for r in pipeline.audit(spark, config).collect()} == {"whole"}
    # a batch that is run again, as after a crash before the commit, changes nothing
    run = f"archive/{query.id}"
    records = spark.read.parquet(source).filter("off < 500")
    pipeline.archive_batch(records, config, run, 0)
    assert pipeline.restored(spark, config).count() == 200 and spark.read.json(f"{meta}/dead_letters").count() == 2
    assert {r.state for r in pipeline.audit(spark, config).collect()} == {"whole"}
    days = lambda n: dt.datetime.now(dt.UTC) + dt.timedelta(days=n)
    assert dead_letters.expire(config, days(29)) == [] and dead_letters.expire(config, days(31)) == ["2024-01-01T00"]


def archived(spark, tmp_path, rows, given=None, **filters):
    config = Config.load({"archive": {"destination": f"{tmp_path}/out", "path_template": "{year}/{seq}"}, **(given or {})}, {})
    records = spark.createDataFrame(rows, "topic string, part int, off long, ts timestamp, value string")
    pipeline.archive_batch(records, config, "r", 0, **filters)
    return config, {r.status: r.n for r in spark.read.parquet(config.tables("_meta/outcomes")).groupBy("status").agg(F.count("*").alias("n")).collect()}


AT = dt.datetime(2024, 5, 6, 7)


def test_topics_are_chosen_in_the_pipeline(spark, tmp_path):
    rows = [(t, 0, i, AT, "{}") for i, t in enumerate(["a_land", "a_load", "b_load", "__internal", "c_dlq", "c", "other"])]
    config, _ = archived(spark, tmp_path, rows, {"kafka": {"topic_include": ["^[abc]", "^__"]}})
    assert {r.destination for r in pipeline.restored(spark, config).select("destination").distinct().collect()} == {f"{t}/default" for t in ("a_land", "b_load", "c")}


def test_inbound_filters_leave_a_trace(spark, tmp_path):
    rows = [("t", 0, i, AT, v) for i, v in enumerate(["{}", "drop me", "reject me", None])]
    config, status = archived(spark, tmp_path, rows, drop=F.col("value").contains("drop"), reject=F.col("value").contains("reject"))
    assert status == {"delivered": 2, "filtered": 1, "rejected": 1}
    assert [(r.reason, r.payload) for r in spark.read.json(config.tables("_meta/dead_letters")).collect()] == [("filtered", "reject me")]


def test_direct_transport_has_no_dead_letters(spark, tmp_path):
    deep = '{"x":' + "[" * 70 + "]" * 70 + "}"
    config, status = archived(spark, tmp_path, [("t", 0, 0, None, deep), ("t", 0, 1, None, "{}")], {"transport": "grpc"})
    assert status == {"delivered": 1, "dropped": 1} and not (tmp_path / "out/_meta/dead_letters").exists()


@pytest.mark.parametrize(("mode", "took"), [("cascade", "files"), ("fan_out", "files"), ("file_only", "files"), ("kafka_only", None)])
def test_dead_letter_modes(spark, tmp_path, mode, took):
    """There is no connector here, so the topic always fails: files take over where the mode has them."""
    config = Config.load({"archive": {"destination": f"{tmp_path}/out"}, "dlq": {"mode": mode, "file": {"rotation": "daily", "path": f"file://{tmp_path}/dead"}}}, {})
    entries = spark.createDataFrame([("s", "refused", "x", AT)], "service string, reason string, payload string, ts timestamp")
    if took is None:
        with pytest.raises(Exception):  # noqa: B017
            dead_letters.write(entries, config, 3)
        return
    assert dead_letters.write(entries, config, 3) == took
    assert [(str(r.period), r.batch, r.payload) for r in spark.read.json(f"file://{tmp_path}/dead").collect()] == [("2024-05-06", 3, "x")]


def test_lost_batches_without_acknowledgements(spark, tmp_path):
    batch(spark, f"file://{tmp_path}/in", 0, 10)
    (tmp_path / "blocked").write_bytes(b"a file where the archive's folder should be")
    for acks in (False, True):
        config = Config.load({"archive": {"destination": f"{tmp_path}/blocked"}, "kafka": {"acknowledgements": acks}}, {})
        query = pipeline.start(landing_stream(spark, f"file://{tmp_path}/in"), config, f"file://{tmp_path}/checkpoint-{acks}", available_now=True)
        if acks:
            with pytest.raises(Exception):  # noqa: B017
                query.awaitTermination()
        else:
            query.awaitTermination()


def test_reload_restarts_only_where_needed(spark, tmp_path):
    batch(spark, f"file://{tmp_path}/in", 0, 5)
    archive = {"destination": f"{tmp_path}/out", "roll_interval_secs": 1}
    old = Config.load({"archive": archive}, {})
    records, checkpoint = landing_stream(spark, f"file://{tmp_path}/in"), f"file://{tmp_path}/checkpoint"
    query = pipeline.start(records, old, checkpoint)
    query.processAllAvailable()
    same = pipeline.reload(query, records, old, old, checkpoint)
    other = pipeline.reload(query, records, old, Config.load({"archive": archive, "buffer": {"flush_records": 2}}, {}), checkpoint)
    assert same is query and other.isActive and not query.isActive
    other.stop()
    assert pipeline.restored(spark, old).count() == 5


def test_config_rules():
    good = {"archive": {"destination": "file:///tmp/x"}}
    Config.load(good, {}).validate()
    for bad in (
        {"transport": "mqtt"}, {"kafka": {"brokers": []}}, {"buffer": {"flush_bytes": 0}}, {"archive": {"path_template": "{topic}"}}, {"archive": {"multipart_chunk_size": 1024}},
        {"compression": {"codec": "gz"}}, {"routing": {"mode": "hash"}}, {"routing": {"expression_fields": []}}, {"kafka": {"sasl_mechanism": "PLAIN"}}, {"transport": "grpc", "grpc": {"listen": " "}},
        {"dlq": {"mode": "both"}}, {"archive": {"destination": "ftp://x/y"}}, {"dlq": {"file": {"rotation": "weekly"}}}, {"dlq": {"kafka": {"routing": "per_table"}}}, {"archive": {"service_account_key": "/path/key.json"}},
    ):
        with pytest.raises(ConfigError):
            Config.load(bad, {}).validate()


def test_config_values():
    config = Config.load({"kafka": {"sasl_username": "u", "sasl_password": "p"}, "buffer": {"flush_bytes": 5}}, {"DRIFTVAULT_BUFFER_FLUSH_BYTES": "7", "DRIFTVAULT_KAFKA_TOPICS": "a, b", "DRIFTVAULT_ROUTING_MODE": ""})
    assert (config.buffer.flush_bytes, config.kafka.topics, config.routing.mode, config.kafka.sasl_mechanism) == (7, ["a", "b"], "expression", "PLAIN")
    assert config.idle_reason() and config.guarantee() == ("at_least_once", None) and config.roll_interval_secs() == 300
    assert Config.load({"transport": "grpc"}, {}).guarantee() == ("best_effort", "sink_cannot_confirm") and Config.load({"transport": "grpc"}, {}).effective_fields() == ("_source", "_org_id")
    assert Config.load({"kafka": {"acknowledgements": False}}, {}).roll_interval_secs() == 3600
    assert parse_destination("gcs://b/x/y/") == ("gs", "b", "x/y") and parse_destination("/x") == ("file", None, "/x")
    hot, cold = Config.load({"kafka": {"batch_size": 5}}, {}), Config.load({"archive": {"roll_interval_secs": 1000}}, {})
    assert Config.load({}, {}).restart_required(hot) == [] and hot.restart_required(cold) == ["archive"] and cold.long_held_roll_interval() == 1000
    with pytest.raises(UnknownScheme):
        parse_destination("ftp://x/y")


def test_config_files(tmp_path):
    (tmp_path / "c.json").write_text('{"archive": {"destination": "s3://b/p", "bucket": "own", "endpoint": "http://m:9000"}, "dlq": {"file": {"max_age_days": 5}}, "buffer": null}')
    (tmp_path / ".env").write_text("# settings\nexport DRIFTVAULT_BUFFER_FLUSH_RECORDS='9'\nDRIFTVAULT_DLQ_FILE_ROTATION=daily\nDRIFTVAULT_ARCHIVE_REGION=one\n")
    config = Config.from_files(f"{tmp_path}/c.json", f"{tmp_path}/.env", {"DRIFTVAULT_ARCHIVE_REGION": "two", "DRIFTVAULT_DLQ_FILE_ROTATION": ""})
    assert (config.buffer.flush_records, config.buffer.flush_bytes, config.archive.region) == (9, 1 << 20, "two")
    assert (config.dlq.file.rotation, config.dlq.file.max_age_days, config.dlq.kafka.common_topic) == ("daily", 5, "driftvault_dlq")
    assert config.bucket() == "own" and config.store().uri == "s3://own/p" and config.store().settings == {"region": "two", "endpoint": "http://m:9000", "chunk": 8 << 20}
    assert config.tables("_meta/x") == "s3a://own/p/_meta/x" and config.hadoop_options()["fs.s3a.path.style.access"] == "true" and config.backend() == "s3"
    azure = Config.load({"archive": {"destination": "azure://c/p", "account": "acc", "secret_key": "k"}}, {})
    assert azure.tables("t") == "abfss://c@acc.dfs.core.windows.net/p/t" and list(azure.hadoop_options().values()) == ["k"] and azure.backend() == "azure"


def test_kafka_options(spark, tmp_path):
    options = kafka_options(Config.load({"kafka": {"brokers": ["a:1", "b:2"], "topic_include": ["^x_", "y$"], "sasl_username": "u", "sasl_password": "p", "batch_size": 7}}, {}))
    assert options["kafka.bootstrap.servers"] == "a:1,b:2" and options["maxOffsetsPerTrigger"] == "7" and options["kafka.metadata.max.age.ms"] == "60000"
    assert options["kafka.sasl.mechanism"] == "PLAIN" and 'username="u"' in options["kafka.sasl.jaas.config"] and options["subscribePattern"] == ".*"
    assert kafka_options(Config.load({"kafka": {"topics": ["one", "two"]}}, {}))["subscribe"] == "one,two"
    with pytest.raises(Exception, match="kafka"):  # there is no connector here
        stream_of(spark, Config.load({}, {}))
    direct = Config.load({"transport": "grpc"}, {})
    (tmp_path / "in").mkdir()
    assert stream_of(spark, direct, f"file://{tmp_path}/in").isStreaming
    with pytest.raises(ValueError):
        stream_of(spark, direct)
