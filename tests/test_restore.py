"""Files cut between tasks, and an archive's folder as a source."""

import datetime as dt
import gzip
import os
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from driftvault.functions import codecs, frames
from driftvault.operators import archive, batching, restore

START = dt.datetime(2024, 1, 1)
SCHEMA = "destination string, part int, window timestamp, off long, ts timestamp, value string"


def blocks(seed, n=60):
    """Blocks of lines, some of them random bytes that hold line ends and beginnings of frames, and a line over blocks."""
    dice = random.Random(seed)
    for k in range(n):
        kind = k % 4
        if kind == 0:
            yield b"".join(b"%d %s\n" % (i, b"v" * dice.randrange(40)) for i in range(dice.randrange(1, 400)))
        elif kind == 1:
            yield dice.randbytes(dice.randrange(1, 30_000)) + dice.choice(list(frames.MAGIC.values())) + b"\n"
        elif kind == 2:
            yield b"a part of a line " * dice.randrange(1, 2000)
        else:
            yield b"\n" if dice.random() < 0.5 else b" and its end\n"
    yield b"end\n"


@pytest.mark.parametrize("codec", ["zstd", "lz4", "snappy", "gzip"])
def test_frames_are_found(codec, tmp_path):
    packed = [codecs.compress(codec, b) for b in blocks(1)]
    starts = [sum(map(len, packed[:k])) for k in range(len(packed))]
    (tmp_path / "f").write_bytes(data := b"".join(packed))
    with open(tmp_path / "f", "rb") as raw:
        for at in range(0, len(data), max(1, len(data) // 400)):
            assert frames.first_frame(raw, codec, at, len(data), len(data)) == next((s for s in starts if s >= at), None)
        if codec != "gzip":
            assert frames.whole_until(raw, codec, starts[5], starts[9]) == starts[9] and frames.whole_until(raw, codec, 0, starts[9] + 3) == starts[9]


@pytest.mark.parametrize("codec", ["zstd", "lz4", "snappy", "gzip", "none"])
def test_a_large_file_is_many_tasks(spark, tmp_path, codec):
    """200 frames, lines over cuts, and lines numbered through, as one task reads them."""
    data = b"".join(blocks(2, 200))
    (tmp_path / "_f").write_bytes(b"".join(codecs.compress(codec, b) for b in blocks(2, 200)))
    (tmp_path / "one").write_bytes(codecs.compress(codec, data))
    (tmp_path / "empty").write_bytes(b"")
    size = (tmp_path / "_f").stat().st_size
    uris = spark.createDataFrame([(f"file://{tmp_path}/{n}",) for n in ("_f", "one", "one", "empty")] + [(None,)], "uri string")
    ranges = restore._ranges(uris, codec, size // 20, None)
    assert ranges.filter("uri LIKE '%_f'").count() >= 10
    got = restore.restore_files(uris, codec, range_bytes=size // 20).withColumn("task", F.spark_partition_id()).collect()
    want = Counter(enumerate(data.split(b"\n")[:-1]))
    for name in ("_f", "one"):
        assert Counter((r.line, bytes(r.value)) for r in got if r.uri.endswith(f"/{name}")) == want
    assert not any(r.problem for r in got) and len({r.task for r in got if r.uri.endswith("_f")}) > 1


@pytest.mark.parametrize(("codec", "end"), [("zstd", -5), ("lz4", -5), ("gzip", -5), ("none", -2)])
def test_a_large_file_that_is_cut_short(spark, tmp_path, codec, end):
    """All lines up to the damage, then its problem, as for small files."""
    packed = [codecs.compress(codec, b"".join(b"%d:%d\n" % (k, i) for i in range(500))) for k in range(40)]
    data = b"".join(packed)[:end]
    (tmp_path / "f").write_bytes(data)
    uris = spark.createDataFrame([(f"file://{tmp_path}/f",)], "uri string")
    for size in (len(data) // 8, 1 << 30):
        got = restore.restore_files(uris, codec, range_bytes=size).collect()
        lines = {r.line: bytes(r.value) for r in got if r.problem is None}
        assert [r.problem.partition(":")[0] for r in got if r.problem] == ["EOFError"]
        # of a gzip file as far as its reader comes, else all whole frames
        least = 0 if codec == "gzip" and size == 1 << 30 else 30 * 500 if codec == "gzip" else 39 * 500
        assert len(lines) == sum(r.problem is None for r in got) >= least and all(lines[n] == b"%d:%d" % divmod(n, 500) for n in lines) and sorted(lines) == list(range(len(lines)))


def archived(spark, tmp_path, codec="zstd"):
    rows = [(d, 0, START, i, START + dt.timedelta(hours=h, minutes=i), f"{d} {h} {i}") for d in ("events/a", "events/b", "other", "_hidden") for h in (0, 1, 5, 30) for i in range(40)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("window", batching.roll_window(F.col("ts"), 3600))
    archive.write_archive(df, f"file://{tmp_path}/x", "r", archive.Layout(codec=codec), batching.Limits(flush_records=7, roll_bytes=60))
    return rows


@pytest.mark.parametrize("codec", ["zstd", "none", "gzip"])
def test_an_archive_is_a_source(spark, tmp_path, codec):
    rows = archived(spark, tmp_path, codec)
    (tmp_path / "x/stray").write_bytes(b"no archive file")
    read = restore.read_archive(spark, f"file://{tmp_path}/x", codec=codec, range_bytes=50)
    assert Counter(bytes(r.value).decode() for r in read.collect()) == Counter(r[5] for r in rows)
    hour = lambda h: START + dt.timedelta(hours=h)
    some = read.filter((F.col("destination") == "events/a") & (F.col("hour") >= hour(1)) & (F.col("hour") < hour(6)))
    assert Counter(bytes(r.value).decode() for r in some.collect()) == Counter(r[5] for r in rows if r[0] == "events/a" and hour(1) <= r[4].replace(minute=0) < hour(6))
    assert restore.read_archive(spark, f"file://{tmp_path}/absent").count() == 0
    assert read.filter("destination IN ('other', 'absent')").count() == 160 and read.filter("destination = 'events'").count() == 0


def test_filters_keep_files_closed(spark, tmp_path):
    """What is neither wanted by destination nor by hour is not opened, and its folders are not even listed."""
    from pyspark.sql.datasource import EqualTo, GreaterThanOrEqual, LessThan

    archived(spark, tmp_path)
    spec = {"store": [f"file://{tmp_path}/x", {}], "template": "{year}/{month}/{day}/{hour}", "extension": "jsonl", "codec": "zstd", "range_bytes": 1 << 20, "cores": 4}
    every = restore.ArchiveReader(spec)
    n, folders = len({r.path for p in every.partitions() for r in p.ranges}), every.listed
    one = restore.ArchiveReader(spec)
    left = list(one.pushFilters([EqualTo(("destination",), "events/a"), GreaterThanOrEqual(("hour",), START), LessThan(("hour",), START + dt.timedelta(hours=1))]))
    paths = {r.path for p in one.partitions() for r in p.ranges}
    assert len(left) == 2 and paths and all(p.startswith("events/a/2024/01/01/0") and p.split("/")[5][:2] in ("00", "01") for p in paths)
    assert len(paths) < n / 4 and one.listed <= 4 < folders
    opened = {r.path for r in restore.read_archive(spark, f"file://{tmp_path}/x").filter("destination = 'events/a'").select("path").distinct().collect()}
    assert all(p.startswith("events/a/") for p in opened)
    plan = restore.read_archive(spark, f"file://{tmp_path}/x").filter("destination = 'events/a'")._jdf.queryExecution().executedPlan().toString()
    assert "Filter (" not in plan  # the source has answered it


def test_a_line_over_frames_is_not_a_record(spark, tmp_path):
    folder = tmp_path / "d/2024/01/01"
    folder.mkdir(parents=True)
    (folder / f"00-0000-{'0' * 16}.jsonl.gz").write_bytes(gzip.compress(b"half a li") + os.urandom(0))
    with pytest.raises(Exception, match="ends within a line"):
        restore.read_archive(spark, f"file://{tmp_path}", codec="gzip").collect()
