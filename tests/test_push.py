"""The push source: what was pushed is archived once, through crashes of producer and reader."""

import datetime as dt
from collections import Counter

import pytest

from driftvault.plans.config import Config
from driftvault.sources.push import PushLog, PushReader, push_stream, segments
from driftvault.sources.stores import Store
from driftvault.streaming import pipeline

AT = dt.datetime(2024, 5, 6, 7, tzinfo=dt.UTC)


def some(first, n):
    return [("t" if i % 2 else None, AT if i % 3 else None, b'{"_org_id":"o","n":%d}' % i) for i in range(first, first + n)]


def run(spark, tmp_path, config):
    query = pipeline.start(push_stream(spark, f"file://{tmp_path}/log"), config, f"file://{tmp_path}/checkpoint", available_now=True)
    query.awaitTermination()


def test_push_crash_resume(spark, tmp_path, monkeypatch):
    config = Config.load({"transport": "grpc", "archive": {"destination": f"{tmp_path}/out"}}, {})
    store = Store(f"file://{tmp_path}/log")
    one, two = PushLog(store, 0), PushLog(store, 7)
    assert (list(one.append(some(0, 4))), list(one.append(some(4, 3))), list(two.append(some(100, 2))), list(one.append([]))) == ([0, 1, 2, 3], [4, 5, 6], [0, 1], [])
    run(spark, tmp_path, config)
    assert pipeline.restored(spark, config).count() == 9
    # a producer dies within a segment: nothing of it is seen, and its successor goes on after the last whole one
    dying = PushLog(store, 0).files.create("00000/00000000000000000007-0000000099.arrow")
    dying.write(b"half a segment")
    again = PushLog(store, 0)
    assert again.next == 7 and list(again.append(some(7, 5))) == [7, 8, 9, 10, 11]
    # the reader's batch fails, as when its driver dies, and is run again from the checkpoint
    with monkeypatch.context() as m:
        m.setattr(pipeline, "archive_batch", lambda *a, **k: 1 / 0)
        with pytest.raises(Exception):  # noqa: B017
            run(spark, tmp_path, config)
    two.append(some(102, 1))
    run(spark, tmp_path, config)
    run(spark, tmp_path, config)
    got = spark.read.parquet(config.tables("_meta/outcomes"))
    assert Counter((r.part, r.off) for r in got.collect()) == Counter([(0, i) for i in range(12)] + [(7, i) for i in range(3)])
    assert sorted(r.value for r in pipeline.restored(spark, config).collect()) == sorted(v.decode() for v in [x[2] for x in some(0, 12) + some(100, 3)])


def test_offsets_and_retention(tmp_path):
    store = Store(f"file://{tmp_path}/log")
    log, reader = PushLog(store, 3), PushReader(store)
    assert reader.latestOffset() == {} and reader.partitions({}, {}) == []
    for first in (0, 5, 10):
        log.append(some(first, 5))
    assert reader.latestOffset() == {"3": 15}
    rows = [r for p in reader.partitions({"3": 3}, {"3": 12}) for b in reader.read(p) for r in b.to_pylist()]
    assert [(r["part"], r["off"], r["value"]) for r in rows] == [(3, i, some(i, 1)[0][2]) for i in range(3, 12)] and rows[0]["topic"] == "t"
    reader.commit({"3": 12})
    assert [(first, n) for first, n, _ in segments(store.open(), 3)] == [(10, 5)]
    with pytest.raises(OSError, match="no longer"):
        reader.partitions({"3": 3}, {"3": 12})
    reader.commit({"3": 15})
    assert segments(store.open(), 3) == [] and reader.latestOffset() == {"3": 15} and PushLog(store, 3).next == 15
    assert list(PushLog(store, 3).append(some(0, 2))) == [15, 16] and [b.num_rows for p in reader.partitions({"3": 15}, {"3": 17}) for b in reader.read(p)] == [2]
