"""The sink: nothing is lost or left over when files are there already, tasks are killed, or a store refuses."""

import datetime as dt
import json
import os
import random
import signal
from pathlib import Path

import pytest
from pyarrow import fs
from pyspark.sql import functions as F

from driftvault.operators import archive, batching, delivery
from driftvault.sources import stores
from driftvault.sources.stores import Store

START = dt.datetime(2024, 1, 1)
SCHEMA = "destination string, part int, window timestamp, off long, ts timestamp, value string"
NONE = archive.Layout("{year}/{hour}-{seq}", codec="none")


def files_below(folder) -> list[str]:
    return sorted(str(p.relative_to(folder)) for p in Path(folder).rglob("*") if p.is_file())


def test_files_with_other_contents_of_one_length_are_an_error(spark, tmp_path):
    make = lambda v: spark.createDataFrame([("d", 0, START, 0, START, v)], SCHEMA)
    first = archive.write_archive(make("aaa"), f"file://{tmp_path}/x", "r", NONE)
    again = archive.write_archive(make("aaa"), f"file://{tmp_path}/x", "r", NONE)
    assert first.drop("compress_micros", "write_micros", "close_micros").collect() == again.drop("compress_micros", "write_micros", "close_micros").collect()
    with pytest.raises(Exception, match="other contents"):
        archive.write_archive(make("bbb"), f"file://{tmp_path}/x", "r", NONE)
    assert [r.value for r in archive.restore(first, f"file://{tmp_path}/x", "none").collect()] == ["aaa"]
    assert len(files_below(tmp_path / "x")) == 1


def test_nulls_are_lanes_and_places_of_their_own(spark, tmp_path):
    rows = [("d", p, w, o, t, f"{p} {w} {o} {t}") for p in (0, None) for w in (START, None) for o in (3, 1, None) for t in (START, None)]
    manifest = archive.write_archive(spark.createDataFrame(rows, SCHEMA).coalesce(1), f"file://{tmp_path}/x", "r", NONE)
    got = archive.restore(manifest, f"file://{tmp_path}/x", "none")
    assert {(r.part, r.value) for r in got.collect()} == {(p, v) for _, p, *_, v in rows} and got.count() == 24
    assert {(r.part, r.window, r.n_records) for r in manifest.groupBy("part", "window").agg(F.sum("n_records").alias("n_records")).collect()} == {(p, w, 6) for p in (0, None) for w in (START, None)}
    assert tuple(manifest.filter("split >= 0").agg(F.min("first_off"), F.max("last_off")).first()) == (1, 3)
    assert {(r.first_off, r.last_off) for r in manifest.filter("split < 0").collect()} == {(None, None)}


def test_ties_have_one_order(spark, tmp_path):
    rows = [("d", 0, START, k % 3, START, f"{k:02d}") for k in range(60)]
    random.Random(1).shuffle(rows)
    for name in ("one", "two"):
        archive.write_archive(spark.createDataFrame(rows, SCHEMA).repartition(7), f"file://{tmp_path}/{name}", "r", NONE)
        rows.reverse()
    one, two = (tmp_path / n for n in ("one", "two"))
    assert files_below(one) == files_below(two) and all((one / f).read_bytes() == (two / f).read_bytes() for f in files_below(one))


def sent_with(monkeypatch, sink):
    """Tasks run in other processes: what they are to do differently goes to them in a sink of the test's own."""

    class Source(archive._ArchiveSink):
        def writer(self, schema, overwrite):
            return sink(json.loads(self.options["spec_secret"]))

    monkeypatch.setattr(archive, "_ArchiveSink", Source)


@pytest.mark.parametrize("how", ["raise", "kill"])
def test_a_failed_job_leaves_no_file(spark, tmp_path, monkeypatch, how):
    """Some tasks have written their files when another dies in the midst of its own; one file was there before."""
    rows = [(f"d{k}", 0, START, i, START, f"{k} {i}") for k in range(12) for i in range(50)]
    df = spark.createDataFrame(rows, SCHEMA)
    store = f"file://{tmp_path}/x"
    before = archive.write_archive(df.filter("destination = 'd3'"), store, "r", NONE).count()
    old = files_below(tmp_path / "x")

    def deadly(batches):
        for batch in batches:
            yield batch
            if "d7" in batch.column(0).to_pylist():
                while not any("d1/" in f for f in files_below(tmp_path / "x")):
                    pass
                if how == "kill":
                    os.kill(os.getpid(), signal.SIGKILL)
                raise RuntimeError("the task dies")

    class Sink(archive._Sink):
        def write(self, iterator):
            return super().write(deadly(iterator))

    with monkeypatch.context() as m:
        sent_with(m, Sink)
        with pytest.raises(Exception):  # noqa: B017
            archive.write_archive(df, store, "r", NONE, batching.Limits(flush_records=5), parts=6, manifest=f"file://{tmp_path}/m")
    assert before == 1 and files_below(tmp_path / "x") == old and files_below(tmp_path / "m") == []
    good = archive.write_archive(df.filter("destination <> 'd3'"), store, "r", NONE, manifest=f"file://{tmp_path}/m")
    assert archive.restore(good, store, "none").count() == 550


class Picky(stores._Staged):
    """A store that takes no file with the word `poison`, or of over `most` bytes; it says so when the file is closed."""

    most = 1 << 40

    def close(self):
        self.out.flush()
        data = Path(self.staged).read_bytes()
        if b"poison" in data or len(data) > self.most:
            raise OSError("400 EntityTooLarge")
        super().close()


def picky(monkeypatch, most=1 << 40):
    class Sink(archive._Sink):
        def write(self, iterator):
            Picky.most, kept = most, stores._Staged
            stores._Staged = lambda files, path: (kept if path.endswith(".parquet") else Picky)(files, path)
            try:
                return super().write(iterator)
            finally:
                stores._Staged = kept

    sent_with(monkeypatch, Sink)


def test_refusals_at_close_are_settled_by_bisection(spark, tmp_path, monkeypatch):
    """Of all records only those that the store refuses reach the dead letters, whatever shares their files; ties and
    null offsets among them."""
    picky(monkeypatch)
    bad = {17, 18, 63, 200}
    rows = [("t", f"d{k % 2}", 0, START, None if k in (18, 19) else k // 5, START, "poison" if k in bad else f"v{k}", "k", False) for k in range(300)]
    df = spark.createDataFrame(rows, "topic string, destination string, part int, window timestamp, off long, ts timestamp, value string, key string, too_deep boolean").coalesce(1)
    ledger = delivery.outcomes(df)
    manifest = archive.write_archive(ledger.filter("status = 'delivered'"), f"file://{tmp_path}/x", "r", NONE, batching.Limits(flush_records=20, roll_bytes=100), manifest=f"file://{tmp_path}/m")
    assert sorted(r.value for r in archive.restore(manifest.filter("path IS NOT NULL"), f"file://{tmp_path}/x", "none").collect()) == sorted(r[6] for r in rows if r[6] != "poison")
    assert [r.n_records for r in manifest.filter("refusal IS NOT NULL").collect()] == [1] * 4
    told = delivery.with_refusals(ledger, manifest)
    assert told.count() == 300 and {(r.value, r.reason) for r in told.filter("status = 'rejected'").collect()} == {("poison", "refused")}
    letters = delivery.dead_letters(told).collect()
    assert len(letters) == 4 and all(r.reason_text == "storage_write_failed: 400 EntityTooLarge" for r in letters)
    assert {tuple(r) for r in told.groupBy("status").count().collect()} == {("delivered", 296), ("rejected", 4)}
    # the batch again, as after a crash: the same files and rows
    rows_before = manifest.count()
    again = archive.write_archive(ledger.filter("status = 'delivered'"), f"file://{tmp_path}/x", "r", NONE, batching.Limits(flush_records=20, roll_bytes=100), manifest=f"file://{tmp_path}/m")
    assert again.count() == rows_before and again.filter("refusal IS NOT NULL").count() == 4


def test_files_that_are_too_large_become_smaller_ones(spark, tmp_path, monkeypatch):
    picky(monkeypatch, most=500)
    df = spark.createDataFrame([("d", 0, START, i, START, "x" * 49) for i in range(100)] + [("d", 0, START, 100, START, "y" * 600)], SCHEMA)
    manifest = archive.write_archive(df, f"file://{tmp_path}/x", "r", NONE)
    assert archive.restore(manifest.filter("path IS NOT NULL"), f"file://{tmp_path}/x", "none").count() == 100
    assert [(r.n_records, r.first_off) for r in manifest.filter("path IS NULL").collect()] == [(1, 100)]


def test_objects_are_compared_and_taken_back(tmp_path):
    """An object store's files, over a local file system in its place."""

    def made(job="j"):
        return stores.Files(fs.SubTreeFileSystem(str(tmp_path), fs.LocalFileSystem()), "b", False).begin(job)

    files = made()
    files.store.create_dir("b/a", recursive=True)
    files.store.create_dir(f"b/{files.attempt}", recursive=True)
    for data, ok in ((b"aaa", True), (b"aaa", True), (b"bbb", False)):
        out = files.create("a/f")
        out.write(data)
        if ok:
            out.close()
        else:
            with pytest.raises(FileExistsError):
                out.close()
    assert made().undo("j") == 1 and not files.exists("a/f") and not (tmp_path / "b/_staging/j").exists()
    files.store.create_dir(f"b/{files.attempt}", recursive=True)
    out = files.create("a/g")
    out.write(b"x")
    out.abandon()
    assert not files.exists("a/g")


def test_google_keys_reach_the_client():
    stores._use_google_key('{"type": "service_account"}')
    assert Path(os.environ.pop("GOOGLE_APPLICATION_CREDENTIALS")).read_text() == '{"type": "service_account"}'


def test_folders_are_listed_level_by_level(spark, tmp_path):
    for k in range(40):
        (tmp_path / f"x/hot/{k % 7}/{k % 3}").mkdir(parents=True, exist_ok=True)
        (tmp_path / f"x/hot/{k % 7}/{k % 3}/f{k}").write_bytes(b"." * k)
    (tmp_path / "x/top").write_bytes(b"..")
    (tmp_path / "x/empty").mkdir()
    store = Store(f"file://{tmp_path}/x")
    assert {(r.path, r.n_bytes) for r in store.list(spark).collect()} == {(f"hot/{k % 7}/{k % 3}/f{k}", k) for k in range(40)} | {("top", 2)}
    assert store.list(spark, "hot/1").count() == sum(k % 7 == 1 for k in range(40)) and store.list(spark, "absent").count() == 0
    assert store.list(spark, limit=3).count() == 3
