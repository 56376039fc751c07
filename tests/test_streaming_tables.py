"""What a pipeline keeps beside its archive: positions, topics, times of batches, dead letters, histograms."""

import datetime as dt
import json
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from driftvault.operators import coverage, delivery, metrics
from driftvault.plans.config import Config
from driftvault.sources.records import kafka_options, landing_stream
from driftvault.streaming import pipeline, progress

RECORDS = "topic string, part int, off long, ts timestamp, value string"
AT = dt.datetime(2024, 5, 6, 7)


def config_at(tmp_path, **given):
    return Config.load({"archive": {"destination": f"{tmp_path}/out"}, **given}, {})


def test_landing_topics_are_known_in_later_batches(spark, tmp_path):
    """`_load` stays out when `_land` is silent for a batch; a batch run again is as it was."""
    config = config_at(tmp_path)
    batches = [["b_load", "c"], ["a_land", "a_load"], ["a_load", "b_load"], ["a_load", "b_land"], ["b_load", "d"]]
    make = lambda names: spark.createDataFrame([(t, 0, i, AT, "{}") for i, t in enumerate(names)], RECORDS)
    read = lambda: {(r.batch, r.topic) for r in spark.read.parquet(config.tables("_meta/outcomes")).collect()}
    for k, names in enumerate(batches):
        pipeline.archive_batch(make(names), config, "r", k)
    want = {(0, "b_load"), (0, "c"), (1, "a_land"), (2, "b_load"), (3, "b_land"), (4, "d")}
    assert read() == want
    for k in (2, 4):
        pipeline.archive_batch(make(batches[k]), config, "r", k)
    assert read() == want and {r.state for r in pipeline.audit(spark, config).collect()} == {"whole"}


def test_a_batch_keeps_its_time(spark, tmp_path):
    """Records without a time are archived under the same names when their batch is run again."""
    config = config_at(tmp_path, archive={"destination": f"{tmp_path}/out", "path_template": "{year}/{timestamp}", "roll_interval_secs": 1})
    records = spark.createDataFrame([("t", 0, i, None, "{}") for i in range(3)], RECORDS)
    paths = lambda: {r.path for r in pipeline.manifest(spark, config).collect()}
    pipeline.archive_batch(records, config, "r", 0)
    first = paths()
    time_of = pipeline.batch_time(config, "r", 0)
    import time

    time.sleep(1.1)
    pipeline.archive_batch(records, config, "r", 0)
    assert paths() == first and len(first) == 1 and pipeline.restored(spark, config).count() == 3
    assert pipeline.batch_time(config, "r", 0) == time_of < pipeline.batch_time(config, "r", 1)


def test_a_new_batch_size_is_taken_over(spark, tmp_path):
    folder = f"file://{tmp_path}/in"
    spark.createDataFrame([("t", 0, i, AT, "{}") for i in range(4)], RECORDS).coalesce(1).write.mode("append").parquet(folder)
    archive = {"destination": f"{tmp_path}/out", "roll_interval_secs": 1}
    old, checkpoint = config_at(tmp_path, archive=archive), f"file://{tmp_path}/checkpoint"
    query = pipeline.start(landing_stream(spark, folder), old, checkpoint)
    query.processAllAvailable()
    new = config_at(tmp_path, archive=archive, kafka={"batch_size": 7})
    assert pipeline.reload(query, landing_stream(spark, folder), old, config_at(tmp_path, archive=archive), checkpoint) is query
    other = pipeline.reload(query, landing_stream(spark, folder, 7), old, new, checkpoint)
    assert other is not query and other.isActive and not query.isActive
    spark.createDataFrame([("t", 0, 9, AT, "{}")], RECORDS).coalesce(1).write.mode("append").parquet(folder)
    other.processAllAvailable()
    other.stop()
    assert pipeline.restored(spark, old).count() == 5 and other.id == query.id


def test_positions_of_a_broker():
    report = {
        "id": "q", "batchId": 4, "timestamp": "2024-01-01T00:00:00Z",
        "sources": [{"endOffset": '{"a":{"0":5,"1":7},"b":{"0":1}}', "latestOffset": '{"a":{"0":9,"1":6},"b":{"0":1}}', "numInputRows": 3}, {"endOffset": "17", "latestOffset": None}, {"endOffset": None}, {"endOffset": "no json"}],
    }
    assert {(r["source"], r["topic"], r["part"], r["position"], r["latest"]) for r in progress.positions(report)} == {(0, "a", "0", 5, 9), (0, "a", "1", 7, 6), (0, "b", "0", 1, 1), (1, "", "offset", 17, 17)}


def test_lag_of_a_live_stream(spark, tmp_path):
    """A source that tells how far it could have read: positions come from the query's own reports."""
    config = config_at(tmp_path)
    assert progress.positions_table(spark, config).collect() == []
    listener = progress.listen(spark, config)
    try:
        rows = spark.readStream.format("rate-micro-batch").option("rowsPerBatch", 10).option("numPartitions", 2).load()
        query = rows.writeStream.format("noop").option("checkpointLocation", f"file://{tmp_path}/c").trigger(processingTime="200 milliseconds").start()
        import time

        until = time.monotonic() + 60
        while time.monotonic() < until and not (query.lastProgress and query.lastProgress["batchId"] >= 2 and progress.positions_table(spark, config).count() > 2):
            time.sleep(0.2)
        query.stop()
        table = progress.positions_table(spark, config)
        assert listener.failures == 0 and {r.query for r in table.select("query").distinct().collect()} == {str(query.id)}
        offsets = {r.batch: r.position for r in table.filter("part = '' AND topic = 'offset' OR part = 'offset'").collect()}
        assert offsets and all(offsets[b] == 10 * (b + 1) for b in offsets)
        assert all(r.lag >= 0 for r in progress.current_lag(spark, config).collect())
    finally:
        spark.streams.removeListener(listener)


def entries(spark, values, most):
    df = spark.createDataFrame([("t", 0, i, None if v is None else bytearray(v), "d", "rejected", "refused", "x") for i, v in enumerate(values)], "topic string, part int, off long, value binary, destination string, status string, reason string, reason_text string")
    return {r.src_offset: r for r in delivery.dead_letters(df, max_payload_bytes=most).collect()}


@pytest.mark.parametrize("most", [0, 1, 2, 3, 4, 5, 7, 11, 100, None])
def test_dead_letters_keep_their_bytes(spark, most):
    import base64

    values = [b"", b"plain text", "ü🙂日本".encode(), b"\xff\xfe\x00A", b"ok then \xff", b"\xf0\x9f\x99", None, "🙂🙂".encode(), b"\x80" * 30]
    got = entries(spark, values, most)
    for i, v in enumerate(values):
        r = got[i]
        if v is None:
            assert (r.payload, r.truncated, r.payload_bytes) == (None, False, None)
            continue
        try:
            text = v.decode()
        except UnicodeDecodeError:
            want, encoding = base64.b64encode(v[:most]).decode(), "base64"
        else:
            encoding, want = "utf8", text
            while most is not None and len(want.encode()) > most:
                want = want[:-1]
        assert (r.payload.replace("\r\n", ""), r.encoding, r.truncated, r.payload_bytes) == (want, encoding, most is not None and len(v) > most, len(v)), v


def test_long_payloads_are_cut_in_the_pipeline_not_dropped(spark, tmp_path):
    deep = '{"x":' + "[" * 70 + "]" * 70 + ',"y":"' + "é" * 500 + '"}'
    rows = [("t", 0, 0, AT, deep), ("t", 0, 1, AT, "{}")]
    for most, status in ((100, {"delivered": 1, "rejected": 1}), (None, {"delivered": 1, "dropped": 1})):
        config = Config.load({"archive": {"destination": f"{tmp_path}/{most}"}, "dlq": {"max_bytes": 300, "max_payload_bytes": most}}, {})
        pipeline.archive_batch(spark.createDataFrame(rows, RECORDS), config, "r", 0)
        assert {r.status: r["count"] for r in spark.read.parquet(config.tables("_meta/outcomes")).groupBy("status").count().collect()} == status
    letters = spark.read.json(f"{tmp_path}/100/_meta/dead_letters").collect()
    assert [(r.truncated, r.payload_bytes, r.payload) for r in letters] == [(True, len(deep.encode()), deep[:100])]


def test_quantiles_within_a_hundredth(spark):
    dice = random.Random(3)
    values = [0, 1, 2, 3, 63, 64, 65, 2**40, 2**62, 2**63 - 1] + [int(dice.lognormvariate(8, 3)) for _ in range(5000)]
    df = spark.createDataFrame([(v, "ab"[k % 2]) for k, v in enumerate(values)], "v long, name string")
    shares = (0.01, 0.25, 0.5, 0.9, 0.99, 1.0)
    whole = metrics.histogram(df, F.col("v"), "name")
    parts = metrics.merged(metrics.histogram(df.filter("v % 3 = 0"), F.col("v"), "name"), metrics.histogram(df.filter("v % 3 <> 0"), F.col("v"), "name"))
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, parts.collect()))
    for r in metrics.quantiles(parts, shares).collect():
        of = sorted(v for k, v in enumerate(values) if "ab"[k % 2] == r.name)
        exact = of[-(-int(round(r.share * len(of) * 1e6)) // 10**6) - 1]
        assert r.n == len(of) and r.value <= exact and exact - r.value <= exact / 64
    starts = spark.range(1).select(*[metrics.bucket_start(metrics.bucket(F.lit(v).cast("long"))).alias(str(v)) for v in (0, 1, 5, 64, 127, 128, 129, 1000)]).first()
    assert list(starts) == [0, 1, 5, 64, 127, 128, 128, 1000]


def test_durations_are_measured(spark, tmp_path):
    config = config_at(tmp_path, buffer={"flush_records": 5})
    pipeline.archive_batch(spark.createDataFrame([("t", 0, i, AT, json.dumps({"n": i})) for i in range(50)], RECORDS), config, "r", 0)
    found = Counter()
    for r in metrics.archive_histograms(pipeline.manifest(spark, config)).collect():
        found[r.metric] += r.n
    assert found == {"batch_size_bytes": 10, "compression_duration_micros": 10, "flush_duration_micros": 10, "archive_file_size_bytes": 1, "file_close_micros": 1}


def plain_ranges(ends):
    seen = {}
    for part, off, end in ends:
        if off is not None:
            seen.setdefault(part, {}).setdefault(off, []).append(end)
    out = []
    for part, of in seen.items():
        for off in range(min(of), max(of) + 1):
            end = "missing" if off not in of else of[off][0] if len(of[off]) == 1 else "twice"
            n = len(of.get(off, []))
            if out and out[-1][0] == part and out[-1][3] == end and out[-1][2] == off - 1:
                out[-1] = (part, out[-1][1], off, end, out[-1][4] + n)
            else:
                out.append((part, off, off, end, n))
    return sorted(out)


@pytest.mark.parametrize("seed", range(4))
def test_offset_ranges_against_brute_force(spark, seed):
    dice, ends = random.Random(seed), [(9, 5, "archive"), (9, None, "archive")]
    for part in range(3):
        off = dice.randrange(50)
        for _ in range(60):
            off += dice.choice([0, 1, 1, 1, 40])
            end = dice.choice(["archive", "archive", "filtered", "lost"])
            for _ in range(dice.choice([1, 1, 20, 70])):
                ends += [(part, off, end)] * dice.choice([1] * 30 + [2])
                off += 1
    got = coverage.offset_ranges(spark.createDataFrame(ends, "part int, off long, end string"), ("part",), span=16)
    assert sorted((r.part, r.first_off, r.last_off, r.end, r.n_records) for r in got.collect()) == plain_ranges(ends)
    floors = {r.part: r.commit_to for r in coverage.commit_floor(got, ("part",)).collect()}
    for part, floor in floors.items():
        bad = [a for p, a, _, end, _ in plain_ranges(ends) if p == part and end in ("lost", "missing")]
        assert floor == (min(bad) if bad else max(o for p, o, _ in ends if p == part and o is not None) + 1)


def test_settings_reach_their_clients():
    options = kafka_options(Config.load({"kafka": {"ssl_ca_location": "/ca.pem", "security_protocol": "SSL"}}, {}))
    assert (options["kafka.ssl.truststore.type"], options["kafka.ssl.truststore.location"], options["kafka.security.protocol"]) == ("PEM", "/ca.pem", "SSL")
    gcs = Config.load({"archive": {"destination": "gs://b/p", "service_account_key": '{"k": 1}', "multipart_chunk_size": 6 << 20}}, {})
    assert gcs.store().settings == {"service_account_key": '{"k": 1}', "chunk": 6 << 20} and gcs.store().below("x").settings == gcs.store().settings
    assert Config.load({"archive": {"destination": "/x"}}, {}).store().settings == {}
