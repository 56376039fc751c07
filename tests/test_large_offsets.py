"""Larger tables: event ids beyond one lane's range of offsets (LANE_OFFSETS), against SQL, and many small blocks."""

import tempfile

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from driftvault.functions.codecs import decompress
from driftvault.operators import archive, batching
from driftvault.operators.batching import LANE_OFFSETS
from driftvault.plans import queries
from driftvault.sources import stores
from driftvault.sources.stores import Store
from tests.test_queries import rows


@pytest.fixture(scope="module")
def events_twice(tmp_path_factory):
    """Each event a second time, whose id is larger by more than a lane's range: both are in the same lanes of a day."""
    folder = tmp_path_factory.mktemp("far")
    duckdb.sql(f"""COPY (SELECT e.event_id + k * {LANE_OFFSETS + 5696} AS event_id, e.* EXCLUDE (event_id)
        FROM range(2) r(k), '/root/testdata/sf0.001/events.parquet' e) TO '{folder}/events.parquet' (FORMAT parquet)""")
    return str(folder)


OF_LANES = [
    "archive_totals", "file_keys", "file_ledger", "file_size_histogram", "flush_by_age", "flush_by_records", "flush_by_size", "flush_combined",
    "flushes_by_trigger", "read_block", "recovery_classify", "restore_large_file", "rolls_by_trigger", "scaling_pressure", "size_quantiles",
]


@pytest.mark.parametrize("name", OF_LANES)
def test_lanes_of_a_day_are_not_cut(spark, events_twice, name):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW events AS SELECT * FROM '{events_twice}/events.parquet'")
    assert rows(queries.QUERIES[name](spark, events_twice).toPandas()) == rows(con.sql(queries.ORACLE_SQL[name]).df())


def test_small_blocks_cost_little(monkeypatch):
    """Payloads are joined for many blocks at once and folders made once: where each record is a block of its own, a
    block asks for no Arrow call, and a file for none of its folders' that a file before has made."""
    n, calls, made = 4000, [], []
    kept, mkdirs = archive.pc.binary_join, stores.os.makedirs
    monkeypatch.setattr(archive.pc, "binary_join", lambda *a: calls.append(1) or kept(*a))
    monkeypatch.setattr(stores.os, "makedirs", lambda at, **k: made.append(at) or mkdirs(at, **k))
    hour = pa.array([k // 10 * 3_600_000_000 for k in range(n)], pa.timestamp("us", tz="UTC"))
    zero, values = pa.array([0] * n, pa.int64()), pa.array([b"v%d" % k for k in range(n)], pa.binary())
    batch = pa.RecordBatch.from_arrays([pa.repeat("d", n), pa.array([0] * n, pa.int32()), hour, zero, zero, hour, values, pa.array(range(n), pa.int64())], names=archive._ROWS)
    with tempfile.TemporaryDirectory() as folder:
        files = Store(folder).open().begin("job")
        blocks = list(archive._written_rows(files, archive.Layout("{year}/{month}", codec="zstd"), batching.Limits(flush_records=1), "r", [batch.slice(0, 1501), batch.slice(1501)]))
        got = b"".join(decompress("zstd", files.read(b["path"]).read()) for b in blocks if b["block"] == 0)
        files.sync()
    assert [b["n_records"] for b in blocks] == [1] * n and got == b"".join(b"v%d\n" % k for k in range(n))
    assert len(calls) == 2 and len(made) < 10


def test_long_and_short_runs_have_the_same_blocks(tmp_path, monkeypatch):
    """Lists for short runs of a lane, arrays for long ones: the same flushes, whatever the batches and pieces."""
    rng, n = np.random.default_rng(5), 3000
    times = pa.array(np.cumsum(rng.integers(-3, 6, n)) * 1_000_000, pa.timestamp("us", tz="UTC"))
    values, zero = pa.array([b"x" * int(k) for k in rng.integers(0, 40, n)], pa.binary()), pa.array([0] * n, pa.int64())
    offs = pa.array([archive.NO_OFFSET if k < 20 else k for k in range(n)], pa.int64())
    batch = pa.RecordBatch.from_arrays([pa.repeat("d", n), pa.array([0] * n, pa.int32()), times.take(pa.array([0] * n)), zero, zero, times, values, offs], names=archive._ROWS)
    seen = []
    for run, (size, short, piece) in enumerate([(n, 0, 8 << 20), (7, 256, 8 << 20), (500, 1 << 20, 100), (n, 256, 1)]):
        monkeypatch.setattr(archive, "SHORT_RUN", short)
        monkeypatch.setattr(archive, "PIECE_BYTES", piece)
        files = Store(str(tmp_path / str(run))).open().begin("job")
        limits = batching.Limits(flush_bytes=300, flush_records=14, flush_secs=20, roll_bytes=2000, roll_secs=500)
        blocks = archive._written_rows(files, archive.Layout(codec="none"), limits, "r", [batch.slice(at, size) for at in range(0, n, size)])
        seen.append([{k: list(v) if k == "lengths" else v for k, v in b.items() if not k.endswith("_micros")} for b in blocks])
    assert seen[0] == seen[1] == seen[2] == seen[3] and {b["flush_trigger"] for b in seen[0]} >= {"size", "records", "age"}
