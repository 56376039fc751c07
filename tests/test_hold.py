"""Records held over micro-batches: one file a roll interval, also over a restart."""

import datetime as dt
import time
from collections import Counter

import pytest

from driftvault.plans.config import Config
from driftvault.sources.records import landing_stream
from driftvault.streaming import hold, pipeline

AT = dt.datetime(2024, 5, 6, 7)
PROVIDER = "spark.sql.streaming.stateStore.providerClass"


@pytest.fixture
def rocks(spark):
    before = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, hold._PROVIDER)
    yield spark
    spark.conf.set(PROVIDER, before)


def push(spark, tmp_path, first, n):
    rows = [("t" if i % 2 else "u", None if i % 5 == 0 else 0, i, AT, None if i % 7 == 0 else f'{{"n":{i}}}') for i in range(first, first + n)]
    spark.createDataFrame(rows, "topic string, part int, off long, ts timestamp, value string").coalesce(1).write.mode("append").parquet(f"file://{tmp_path}/in")
    return rows


def wait_for(what, seconds=90):
    until = time.monotonic() + seconds
    while time.monotonic() < until and not what():
        time.sleep(0.3)
    assert what()


def archived(spark, config):
    try:
        return spark.read.parquet(config.tables("_meta/outcomes")).count()
    except Exception:  # noqa: BLE001 - nothing is there yet
        return 0


def test_one_file_a_roll_interval_over_batches_and_a_restart(rocks, tmp_path):
    given = {"archive": {"destination": f"{tmp_path}/out", "roll_interval_secs": 12}, "buffer": {"hold": True, "flush_age_secs": 1}, "routing": {"mode": "topic"}}
    config, rows = Config.load(given, {}), [r for k in range(6) for r in push(rocks, tmp_path, 4 * k, 4)]
    start = lambda: pipeline.start(landing_stream(rocks, f"file://{tmp_path}/in", max_files=1), config, f"file://{tmp_path}/checkpoint")
    query = start()
    read = lambda: sum(p["numInputRows"] for p in query.recentProgress)
    wait_for(lambda: read() >= 12)
    query.stop()
    before = archived(rocks, config)
    query = start()
    wait_for(lambda: archived(rocks, config) == 24)
    query.stop()
    # a file for each batch's keys, were none held; how many rounds there are depends on the machine's speed
    files, unheld = pipeline.manifest(rocks, config).select("path", "destination", "part").distinct(), len({(o // 4, t, p) for t, p, o, _, _ in rows})
    assert before < 24 and files.count() < unheld and files.select("destination", "part").distinct().count() == 4
    got = rocks.read.parquet(config.tables("_meta/outcomes")).collect()
    assert Counter((r.topic, r.part, r.off) for r in got) == Counter((t, p, o) for t, p, o, _, _ in rows)
    assert Counter(r.value for r in pipeline.restored(rocks, config).collect()) == Counter(v or "" for *_, v in rows)


class Handle:
    """State and timers of one key, in memory."""

    def __init__(self):
        self.states, self.timers = {}, []

    def getListState(self, name, schema):
        return State(self.states, name)

    getValueState = getListState

    def registerTimer(self, at):
        self.timers.append(at)

    def listTimers(self):
        return iter(self.timers)

    def deleteTimer(self, at):
        self.timers.remove(at)


class State:
    def __init__(self, states, name):
        self.states, self.name = states, name

    def exists(self):
        return bool(self.states.get(self.name))

    def get(self):
        found = self.states[self.name]
        return iter(found) if isinstance(found, list) else found

    def appendValue(self, value):
        self.states.setdefault(self.name, []).append(value)

    def update(self, value):
        self.states[self.name] = value

    def clear(self):
        self.states.pop(self.name, None)


class Clock:
    def __init__(self, now):
        self.now = now

    def getCurrentProcessingTimeInMs(self):
        return self.now


def test_records_wait_for_the_interval_since_the_first(monkeypatch):
    """One key through batches: nothing comes out before its timer, then everything in order; the next record begins a
    new interval. A new process has what the state has."""
    monkeypatch.setattr(hold, "BLOCK_RECORDS", 3)
    handle, rows = Handle(), [{"topic": None, "part": None, "off": i, "ts": AT, "value": b"x" * i} for i in range(12)]
    for k, batch in enumerate((rows[:5], rows[5:6], rows[6:10])):
        holder = hold.Holder(60, 1 << 20)  # as after a restart
        holder.init(handle)
        assert list(holder.handleInputRows(("d",), iter(batch), Clock(1000 * k))) == [] and handle.timers == [60_000]
    assert [r.asDict() for r in holder.handleExpiredTimer(("d",), Clock(60_000), None)] == rows[:10] and handle.states == {} and handle.timers == []
    assert list(holder.handleInputRows(("d",), iter(rows[10:]), Clock(99_000))) == [] and handle.timers == [159_000]
    small = hold.Holder(60, 20)
    small.init(Handle())
    out = [r.off for r in small.handleInputRows(("d",), iter(rows), Clock(0))]
    assert out == list(range(12))[: len(out)] and 6 <= len(out) <= 12 and len(small.handle.timers) == (len(out) < 12)


def test_many_bytes_are_not_held(rocks, tmp_path):
    given = {"archive": {"destination": f"{tmp_path}/out", "roll_interval_secs": 3600}, "buffer": {"hold": True, "hold_bytes": 50, "flush_age_secs": 1}, "routing": {"mode": "topic"}}
    config = Config.load(given, {})
    push(rocks, tmp_path, 0, 200)
    with pytest.raises(ValueError, match="time to come"):
        pipeline.start(landing_stream(rocks, f"file://{tmp_path}/in"), config, f"file://{tmp_path}/checkpoint", available_now=True)
    query = pipeline.start(landing_stream(rocks, f"file://{tmp_path}/in"), config, f"file://{tmp_path}/checkpoint")
    wait_for(lambda: archived(rocks, config) > 150)
    query.stop()
    assert archived(rocks, config) < 200  # the last ones of each key wait for more, or for their time


def test_the_state_store_is_asked_for(spark, tmp_path):
    config = Config.load({"archive": {"destination": f"{tmp_path}/out"}, "buffer": {"hold": True}}, {})
    (tmp_path / "in").mkdir()
    with pytest.raises(ValueError, match="providerClass"):
        pipeline.start(landing_stream(spark, f"file://{tmp_path}/in"), config, f"file://{tmp_path}/checkpoint")
