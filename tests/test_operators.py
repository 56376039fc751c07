import datetime as dt
import itertools
import json
import random
import uuid
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from driftvault.functions import templates
from driftvault.operators import archive, batching, delivery, errors, metrics, recovery, restore, routing, topics
from driftvault.sources.stores import Store
from tests.test_functions import plain_segment

def plain_route(topic, fields, payload, default):
    """The rules, one record at a time: (destination, fallbacks, error)."""
    try:
        parsed = json.loads(payload or "")
    except ValueError:
        return plain_segment(topic) if topic else default, [], True
    found = []
    for path in fields:
        value = parsed
        for key in path.split("."):
            value = value.get(key) if isinstance(value, dict) else None
        text = None if value is None or isinstance(value, (dict, list)) else {True: "true", False: "false"}[value] if isinstance(value, bool) else str(value)
        found.append(text if text is not None and text.strip() else None)
    parts = ([plain_segment(topic)] if topic else []) + [plain_segment(v) if v is not None else default for v in found]
    return "/".join(parts), [i for i, v in enumerate(found) if v is None], False


@pytest.mark.parametrize("fields", [("tenant",), ("tenant", "kind"), ("meta.zone", "tenant", "meta.zone.deep"), ("absent",)])
def test_routes(spark, fields):
    rng = random.Random(len(fields))
    values = ["north", "", "  ", "a+b", ".", "..", "ß/ü", 0, -17, 9_007_199_254_740_993, True, False, None, [], ["x"], {}, {"deep": "d"}, {"deep": {"er": 1}}]
    payloads = [json.dumps({k: v for k, v in (("tenant", rng.choice(values)), ("kind", rng.choice(values)), ("meta", rng.choice([{"zone": rng.choice(values)}, 5, None]))) if rng.random() < 0.9}) for _ in range(150)]
    payloads += [None, "", "{", "plain words", "[1, 2]", '"text"', "17", "null", '{"tenant": "x"} {"tenant": "y"}']
    rows = [(i, rng.choice(["orders", "", "../up", "two words", "ünï"]), p) for i, p in enumerate(payloads)]
    df = spark.createDataFrame(rows, "i int, topic string, value string")
    for r in routing.route_by_fields(df, fields, "none").collect():
        assert (r.destination, r.fallback_fields, r.routing_error) == plain_route(r.topic, fields, r.value, "none"), r


def test_route_by_topic_and_too_deep(spark):
    df = spark.createDataFrame([("", "x"), ("a b", "x"), (None, None)], "topic string, value string")
    assert [r.destination for r in routing.route(df, "topic").collect()] == ["default", "a=20b", "default"]
    deep = spark.createDataFrame([("t", '{"_org_id":"o","x":' + "[" * 64 + "]" * 64 + "}")], "topic string, value string")
    row = routing.route(deep).first()
    assert row.too_deep and row.destination is None and not row.routing_error
    assert "parse_json" not in routing.route_by_topic(df)._jdf.queryExecution().toString().lower()


@pytest.mark.parametrize("condition", [None, "destination IS NOT NULL", "destination LIKE 'o%' AND NOT routing_error AND size(fallback_fields) = 0"])
@pytest.mark.parametrize("fields", [("a",), ("a", "b.c", "d")])
def test_payloads_are_parsed_twice_whatever_is_filtered(spark, fields, condition):
    df = routing.route_by_fields(spark.createDataFrame([("t", "{}")], "topic string, value string"), fields)
    plan = (df.filter(condition) if condition else df)._jdf.queryExecution().optimizedPlan().toString().lower()
    assert plan.count("parse") == 2


def test_topics(spark):
    df = spark.createDataFrame([(t,) for t in ("a_land", "a_load", "b_load", "__x", "y_dlq", "z")], "topic string")
    assert {r.topic for r in topics.prefer_landing(topics.select_topics(df)).collect()} == {"a_land", "b_load", "z"}
    assert {r.topic for r in topics.select_topics(df, include=("^a",)).collect()} == {"a_land", "a_load"}


START = dt.datetime(2024, 1, 1)
SCHEMA = "destination string, part int, window timestamp, off long, ts timestamp, value string"
NONE = archive.Layout("{year}/{hour}-{seq}", codec="none")


def lane(spark, sizes, gaps=None, name="d"):
    """Records of a lane by their archived sizes, with seconds between them."""
    at, rows = START, []
    for i, size in enumerate(sizes):
        at += dt.timedelta(seconds=(gaps or [1] * len(sizes))[i])
        rows.append((name, 0, START, i, at, "v" * (size - 1)))
    return spark.createDataFrame(rows, SCHEMA)


def written(spark, tmp_path, df, **limits):
    none = {"flush_bytes": 1 << 60, "flush_records": 1 << 30, "flush_secs": 1 << 31, "roll_bytes": 1 << 60, "roll_secs": 1 << 31}
    root = f"file://{tmp_path}/{uuid.uuid4().hex}"
    return archive.write_archive(df, f"{root}/data", "r", NONE, batching.Limits(**(none | limits)), manifest=f"{root}/manifest").orderBy("flush_no"), f"{root}/data"


def plain_flushes(sizes, times, limits):
    """Greedy flushing, one record at a time: (n_records, bytes, trigger)."""
    out, held, n, since = [], 0, 0, times[0]
    for size, at in zip(sizes, times):
        held, n = held + size, n + 1
        trigger = "size" if held >= limits.flush_bytes else "records" if n >= limits.flush_records else "age" if at - since >= limits.flush_secs else None
        if trigger:
            out.append((n, held, trigger))
            held, n, since = 0, 0, at
    return out + [(n, held, None)] * bool(n)


def test_flush_is_greedy(spark, tmp_path):
    got = written(spark, tmp_path, lane(spark, [700, 500, 900, 100, 100]), flush_bytes=1000)[0].collect()
    assert [(r.n_records, r.raw_bytes, r.flush_trigger) for r in got] == [(2, 1200, "size"), (2, 1000, "size"), (1, 100, None)]


def test_flush_by_age_counts_from_the_last_flush(spark, tmp_path):
    got = written(spark, tmp_path, lane(spark, [9] * 5, [0, 10, 100, 1, 59]), flush_secs=60)[0].collect()
    assert [(r.n_records, r.flush_trigger) for r in got] == [(3, "age"), (2, "age")]


@pytest.mark.parametrize("seed", range(4))
def test_flushes_against_brute_force(spark, tmp_path, seed):
    rng = random.Random(seed)
    sizes, gaps = [rng.choice([1, 2, 50, 400, 1500]) for _ in range(400)], [rng.choice([0, 1, 30, 200]) for _ in range(400)]
    limits = batching.Limits(rng.choice([300, 2000, 9999]), rng.choice([3, 9, 500]), rng.choice([50, 400, 9999]), 1 << 60, 1 << 31)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "37")
    try:
        got = written(spark, tmp_path, lane(spark, sizes, gaps), **limits._asdict())[0].collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert [(r.n_records, r.raw_bytes, r.flush_trigger) for r in got] == plain_flushes(sizes, list(itertools.accumulate(gaps)), limits)
    assert [(r.first_off, r.last_off) for r in got][0][0] == 0 and sum(r.last_off + 1 - r.first_off for r in got) == 400


def test_roll_happens_at_the_next_block(spark, tmp_path):
    df = lane(spark, [60, 60, 10, 10, 10], [0, 1, 1, 398, 1])
    manifest, root = written(spark, tmp_path, df, flush_records=1, roll_bytes=100, roll_secs=300)
    assert [r.file_no for r in manifest.collect()] == [0, 0, 1, 2, 2]
    assert [(r.n_blocks, r.roll_trigger) for r in batching.files(manifest).orderBy("file_no").collect()] == [(2, "size"), (1, "age"), (2, "end")]
    # a number in the template is the file's own
    assert [r.path.rsplit("-", 1)[0] for r in manifest.collect()] == ["d/2024/00-0000-0000"] * 2 + ["d/2024/00-0001-0001"] + ["d/2024/00-0002-0002"] * 2
    assert sum(f.n_bytes for f in Store(root).list(spark).collect()) == 150


def test_hot_lanes_are_cut_by_offset(spark, tmp_path):
    df = lane(spark, [10] * 100)
    got = archive.write_archive(df, f"file://{tmp_path}/x", "r", NONE, lane_offsets=30)
    got.write.parquet(f"file://{tmp_path}/m")
    manifest = spark.read.parquet(f"file://{tmp_path}/m")
    assert manifest.select("path").distinct().count() == 4 and manifest.agg(F.sum("n_records")).first()[0] == 100
    assert archive.restore(manifest, f"file://{tmp_path}/x", "none").count() == 100


def test_refused_keys_reach_the_ledger(spark, tmp_path):
    """A store that will not take a name costs those records alone, and they are known by their offsets."""
    df = lane(spark, [10] * 4).unionByName(lane(spark, [10] * 3, name="n" * 300)).withColumns({"topic": F.lit("t"), "key": F.lit("k"), "too_deep": F.lit(False)})
    df = df.withColumn("part", F.when(F.col("destination") == "d", 0).otherwise(1))
    manifest, root = written(spark, tmp_path, df)
    assert {(r.destination[0], r.n_records, r.refusal is None) for r in manifest.collect()} == {("d", 4, True), ("n", 3, False)}
    ledger = delivery.with_refusals(delivery.outcomes(df), manifest)
    assert {tuple(r) for r in ledger.groupBy("destination", "status", "reason").count().collect()} == {("d", "delivered", None, 4), ("n" * 300, "rejected", "refused", 3)}
    assert all(r.reason_text.startswith("storage_write_failed: ") for r in delivery.dead_letters(ledger).collect())


def test_files_of_another_run_stay(tmp_path):
    files = Store(str(tmp_path)).open()
    for data in (b"first", b"first"):  # the same task again
        out = files.create("a/f")
        out.write(data)
        out.close()
    out = files.create("a/f")
    out.write(b"something else")
    with pytest.raises(FileExistsError):
        out.close()
    assert (tmp_path / "a/f").read_bytes() == b"first" and [p.name for p in (tmp_path / "a").iterdir()] == ["f"]
    out = files.create("a/g")
    out.abandon()
    assert files.exists("a/f") and not files.exists("a/g")
    files.delete("a/f")
    assert not files.exists("a/f") and Store(str(tmp_path)).probe() is None and Store(f"{tmp_path}/absent").probe() is None
    (tmp_path / "file").write_bytes(b"")
    assert Store(f"{tmp_path}/file").probe()


def test_files_are_held_against_the_manifest(spark, tmp_path):
    df = lane(spark, [10] * 4, name="a").unionByName(lane(spark, [10] * 4, name="_b")).unionByName(lane(spark, [10] * 4, name=".c")).unionByName(lane(spark, [10] * 4, name="e"))
    manifest, root = written(spark, tmp_path, df)
    at = {r.destination: Path(f"{root[7:]}/{r.path}") for r in manifest.collect()}
    at["a"].unlink()
    at["_b"].write_bytes(b"short")
    at[".c"].write_bytes(b"x" * 99)
    (at["e"].parent / "stray").write_bytes(b"?")
    got = archive.compare_with_files(manifest, Store(root).list(spark)).collect()
    assert Counter(r.state for r in got) == {"missing": 1, "short": 1, "long": 1, "whole": 1, "unknown": 1}
    assert Store(root).list(spark, limit=2).count() == 2


def test_outcomes(spark):
    df = spark.createDataFrame(
        [("t", 0, 1, "v", "d", "d/f", False), ("t", 0, 2, "v", "d", "d/../f", False), ("t", 0, 3, "v" * 50, None, None, True), ("t", 1, 9, "v", None, None, True)],
        "topic string, part int, off long, value string, destination string, key string, too_deep boolean",
    )
    ledger = delivery.outcomes(df, max_dlq_bytes=20)
    assert {(r.part, r.off): (r.status, r.reason) for r in ledger.collect()} == {
        (0, 1): ("delivered", None), (0, 2): ("rejected", "refused"), (0, 3): ("dropped", "dlq_too_large"), (1, 9): ("rejected", "too_deep")}
    assert {r.src_offset for r in delivery.dead_letters(ledger).collect()} == {2, 9}
    assert {r.reason for r in delivery.outcomes(df, dlq=False).filter("status = 'dropped'").collect()} == {"refused", "too_deep"}
    assert {tuple(r) for r in metrics.message_counts(ledger).collect()} == {("delivered", "", 1), ("rejected", "refused", 1), ("dropped", "dlq_too_large", 1), ("rejected", "too_deep", 1)}


@pytest.mark.parametrize("codec", ["zstd", "lz4", "snappy", "gzip", "none"])
def test_archive_gives_back_every_byte(spark, tmp_path, codec):
    values = ["plain", "two\nlines", "", "é\r漢", "x" * 3000, "last\n", None]
    rows = [(d, 0, START, i, None, v) for d in ("a", "_hidden", ".dot") for i, v in enumerate(values * 3)]
    root, layout = f"file://{tmp_path}", archive.Layout(codec=codec)
    archive.write_archive(spark.createDataFrame(rows, SCHEMA), f"{root}/data", "r", layout, batching.Limits(flush_bytes=100, roll_bytes=300)).write.parquet(f"{root}/manifest")
    manifest = spark.read.parquet(f"{root}/manifest")
    back = archive.restore(manifest, f"{root}/data", codec)
    got = {}
    for r in sorted(back.collect(), key=lambda r: (int(r.path.split("-")[-2]), r.block, r.pos)):
        got.setdefault(r.destination, []).append(r.value)
    assert got == {d: [v or "" for v in values * 3] for d in ("a", "_hidden", ".dot")}
    assert not list(tmp_path.rglob("*.part"))
    uris = manifest.select(F.concat(F.lit(f"{root}/data/"), "path").alias("uri")).distinct()
    lines = restore.restore_files(uris, codec).collect()
    want = Counter(x for v in values * 3 for x in ((v or "") + "\n").encode().split(b"\n")[:-1])
    assert Counter(bytes(r.value) for r in lines) == Counter({k: 3 * n for k, n in want.items()})


def test_unreadable_files_are_named(spark, tmp_path):
    import gzip

    (tmp_path / "good").write_bytes(gzip.compress(b"a\nb\n"))
    (tmp_path / "cut").write_bytes(gzip.compress(b"a\n" * 500)[:-9])
    (tmp_path / "part").write_bytes(gzip.compress(b"a\nb"))
    uris = spark.createDataFrame([(f"file://{tmp_path}/{n}",) for n in ("good", "cut", "part", "absent")], "uri string")
    problems = {r.uri.rsplit("/", 1)[1]: r.problem for r in restore.restore_files(uris, "gzip").filter("problem IS NOT NULL").collect()}
    assert set(problems) == {"cut", "part", "absent"} and problems["part"] == "EOFError: the file ends within a line"
    (tmp_path / "other").write_bytes(b"this is no gzip")
    with pytest.raises(Exception, match="gzip"):
        restore.restore_files(uris.limit(0).union(spark.createDataFrame([(f"file://{tmp_path}/other",)], "uri string")), "gzip").collect()


def test_bytes_that_are_no_text_come_back(spark, tmp_path):
    df = spark.createDataFrame([("a", 0, START, i, START, bytearray(v)) for i, v in enumerate([b"\xff\xfe", b"", b"\n\n", bytes(range(256))])], SCHEMA.replace("value string", "value binary"))
    archive.write_archive(df, f"file://{tmp_path}/d", "r").write.parquet(f"file://{tmp_path}/m")
    got = archive.restore(spark.read.parquet(f"file://{tmp_path}/m"), f"file://{tmp_path}/d", as_text=False).orderBy("pos").collect()
    assert [bytes(r.value) for r in got] == [b"\xff\xfe", b"", b"\n\n", bytes(range(256))]


def test_a_repeated_run_writes_the_same_files(spark, tmp_path):
    df = lane(spark, [7] * 50)
    once, again = (sorted(tuple(r) for r in archive.write_archive(df, f"file://{tmp_path}/d", "r", limits=batching.Limits(flush_bytes=60)).select("path", "block", "length").collect()) for _ in range(2))
    assert once == again
    assert archive.write_archive(df.limit(0), f"file://{tmp_path}/e", "r").count() == 0


def test_retry_and_scaling(spark):
    wait = spark.range(1).select(delivery.retry_delay(F.lit(0), 0.5, 60), delivery.retry_delay(F.lit(3), 0.5, 60), delivery.retry_delay(F.lit(40), 0.5, 60)).first()
    assert tuple(wait) == (0.5, 4.0, 60.0)
    df = spark.createDataFrame([(100_000, 10_000, 1.0, False), (50_000, 0, 0.0, False), (1, 1, 1.0, True)], "lag long, buffer_depth long, memory double, circuit_open boolean")
    assert [round(r.pressure, 3) for r in metrics.scaling_pressure(df).collect()] == [1.0, 0.2, 0.0]


def test_keys_are_read_back(spark):
    key = F.lit("a=2Fb/=/caf=C3=A9/2024/01-0012-0123456789abcdef.jsonl.zst")
    row = spark.range(1).select(*[c.alias(n) for n, c in recovery.parse_key(key, 2).items()]).first()
    assert tuple(row) == ("a/b", "", "café", 12, "0123456789abcdef")
    assert spark.range(1).select(templates.expand_template(templates.HIVE, F.timestamp_seconds(F.lit(0)))).first()[0] == "year=1970/month=01/day=01/hour=00"


def test_error_categories():
    wrapped = RuntimeError("upload failed")
    wrapped.__cause__ = OSError("400 KeyTooLongError")
    assert errors.is_refused(wrapped) and errors.category(wrapped) == "data"
    assert errors.category(FileNotFoundError(2, "gone")) == "fatal" and errors.category(TimeoutError()) == "transient" and errors.category(OSError(28, "full")) == "transient"
    assert errors.is_unreadable(EOFError()) and errors.is_unreadable(IsADirectoryError(21, "dir")) and not errors.is_unreadable(OSError(5, "io"))


def test_waits_and_tries():
    for attempt in (0, 3, 40):
        most = min(0.5 * 2**attempt, 60.0)
        assert all(most / 2 <= errors.wait_before(attempt) <= most for _ in range(50))
    waits, left = [], [OSError(5, "io"), TimeoutError()]

    def action():
        if left:
            raise left.pop()
        return "done"

    assert errors.retried(action, sleep=waits.append) == "done" and len(waits) == 2
    for failure, tries in ((PermissionError(13, "no"), 1), (OSError(5, "io"), 3)):
        seen = []

        def fails(failure=failure, seen=seen):
            seen.append(1)
            raise failure

        with pytest.raises(OSError):
            errors.retried(fails, tries=3, sleep=lambda s: None)
        assert len(seen) == tries
