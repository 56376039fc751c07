"""Writing records to archives of compressed lines, and reading them back.

A block is one flush: its payloads, a line end after each, in one compressed frame. A file is a row of blocks. What
was written is a DataFrame, the manifest: one row for each block, with its place in the file and each record's length.

Files are written through Spark's own protocol for sinks: each task tells the driver which part of the manifest it
wrote, and only when all have is the archive committed; a job that fails takes back every file that it made.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import io
import json
import time
import uuid
from dataclasses import dataclass
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from driftvault.functions.codecs import EXTENSION_OF, codec_name, compress, decompress
from driftvault.functions.templates import expanded
from driftvault.operators.batching import LANE, LANE_OFFSETS, MICROSECONDS, Limits, flush_end
from driftvault.operators.errors import is_refused, retried
from driftvault.sources.shared import shared_folder
from driftvault.sources.stores import Store

#: path .. roll_trigger: a block's place and history. split, first_pos: which records it has, by their places in the
#: lane. *_micros: how long compressing it, writing it and closing its file took. refused_at: `open` where the store
#: takes no file of that name, `write` where it did not take this one.
MANIFEST = (
    "path string, destination string, part int, window timestamp, file_no int, seq int, block int, flush_no int, start long, length long, raw_bytes long, "
    "n_records long, lengths array<int>, flushed_at timestamp, flush_trigger string, opened_at timestamp, "
    "first_off long, last_off long, refusal string, split long, first_pos long, compress_micros long, write_micros long, refused_at string, roll_trigger string, close_micros long"
)
_ARROW_TYPES = {"string": pa.string(), "int": pa.int32(), "long": pa.int64(), "timestamp": pa.timestamp("us", tz="UTC"), "array<int>": pa.list_(pa.int32())}
_ARROW = pa.schema([(n, _ARROW_TYPES[t]) for n, t in (c.split() for c in MANIFEST.split(", "))])
#: Stands for a null offset, which comes before all others.
NO_OFFSET = -(2**63)
#: Rows of a manifest that a task holds before it writes them.
MANIFEST_ROWS = 1000
#: Payload bytes that are made lines at once; so many records of a lane or fewer are gone through as plain lists.
PIECE_BYTES, SHORT_RUN = 8 << 20, 256
#: Neighbouring blocks of a file that one read brings back.
READ_BLOCKS = 64


class Layout(NamedTuple):
    """Where a lane's files go: <destination>/<template at the file's opening>-<seq>-<token>.<extension>[.<codec's>]."""

    template: str = "{year}/{month}/{day}/{hour}"
    extension: str = "jsonl"
    codec: str = "zstd"
    level: int = 3


class _Lane:
    """A lane's buffer and its open file. A file becomes visible as a whole; its name depends on the run and the lane
    alone, so a repeated task writes the same files. Methods give manifest rows."""

    def __init__(self, store, key: tuple, layout: Layout, limits: Limits, run: str):
        self.store, self.key, self.layout, self.limits = store, key, layout, limits
        self.token = hashlib.sha1(f"{run}/{key}".encode()).hexdigest()[:16]
        known = EXTENSION_OF[layout.codec]
        self.end = f".{layout.extension}" + (f".{known}" if known else "")
        self.parts, self.lengths, self.held, self.n_held, self.latest, self.since, self.first_off, self.last_off = [], [], 0, 0, None, None, None, None
        self.flush_no, self.file_no, self.seq_of, self.out, self.blocks = 0, -1, {}, None, []
        self.pos = key[4]

    def add(self, lines: memoryview, ends: np.ndarray, lengths: np.ndarray, times: np.ndarray, offs: np.ndarray):
        """lines: the records' payloads, a line end after each; ends: where each one's ends in them."""
        n_all, at = len(ends), 0
        if n_all <= SHORT_RUN:
            ends, times, offs = ends.tolist(), times.tolist(), offs.tolist()
        self.since = int(times[0]) if self.since is None else self.since
        while at < n_all:
            last, trigger = flush_end(ends, times, at, self.held, self.n_held, self.since, self.limits)
            n, begin, end, some = last + 1 - at, int(ends[at - 1]) if at else 0, int(ends[last]), times[at : last + 1]
            self.parts.append(lines[begin:end])
            self.lengths.append(lengths[at : last + 1])
            self.held += end - begin
            self.n_held += n
            if offs[last] != NO_OFFSET:
                self.last_off = int(offs[last])
                if self.first_off is None:
                    self.first_off = next(int(o) for o in offs[at : last + 1] if o != NO_OFFSET)
            latest = max(some) if n_all <= SHORT_RUN else int(some.max())
            self.latest = latest if self.latest is None else max(self.latest, latest)
            if trigger:
                yield from self.flush(trigger)
                self.since = int(times[last])
            at = last + 1

    def flush(self, trigger: str | None):
        if not self.n_held:
            return
        at, limits = self.latest, self.limits
        if self.out is not None:
            if self.written >= limits.roll_bytes:
                yield from self.finish("size")
            elif (at - self.opened_at) // MICROSECONDS >= limits.roll_secs:
                yield from self.finish("age")
        if self.out is None:
            try:
                self._open(at)
            except Exception as e:
                if not is_refused(e):
                    raise
                yield self._refused(self._block(at, trigger, None, None, 0, 0), e, "open")
                self._emptied()
                return
        began = time.perf_counter()
        lines = b"".join(self.parts)
        frame = compress(self.layout.codec, lines, self.layout.level)
        packed = time.perf_counter()
        try:
            self.out.write(frame)
        except Exception as e:
            if not is_refused(e):
                raise
            self.blocks.append(self._block(at, trigger, len(frame), len(lines), 0, 0))
            yield from self._refused_file(e)
        else:
            self.blocks.append(self._block(at, trigger, len(frame), len(lines), packed - began, time.perf_counter() - packed))
            self.written += len(frame)
        self._emptied()

    def _block(self, at: int, trigger: str | None, length: int | None, raw_bytes: int | None, packing: float, writing: float) -> dict:
        destination, part, window, split, _ = self.key
        is_open = self.out is not None
        return {
            "path": self.name if is_open else None, "destination": destination, "part": part, "window": window, "file_no": self.file_no if is_open else None,
            "seq": self.seq if is_open else None, "block": len(self.blocks) if is_open else None, "flush_no": self.flush_no, "start": self.written if is_open else None,
            "length": length, "raw_bytes": raw_bytes, "n_records": self.n_held, "lengths": (self.lengths[0] if len(self.lengths) == 1 else np.concatenate(self.lengths)) if is_open else None, "flushed_at": at, "flush_trigger": trigger,
            "opened_at": self.opened_at if is_open else None, "first_off": self.first_off, "last_off": self.last_off, "split": split, "first_pos": self.pos,
            "compress_micros": round(packing * 1e6), "write_micros": round(writing * 1e6),
        }

    def _refused(self, block: dict, error: Exception, where: str) -> dict:
        keep = ("destination", "part", "window", "flush_no", "n_records", "flushed_at", "flush_trigger", "first_off", "last_off", "split", "first_pos")
        return {k: block[k] for k in keep} | {"refusal": str(error), "refused_at": where}

    def _refused_file(self, error: Exception):
        """The store does not take the open file: none of its blocks is archived."""
        self.out.abandon()
        self.out = None
        for b in self.blocks:
            yield self._refused(b, error, "write")
        self.blocks = []

    def _emptied(self) -> None:
        self.pos += self.n_held
        self.parts, self.lengths, self.held, self.n_held, self.latest, self.first_off, self.flush_no = [], [], 0, 0, None, None, self.flush_no + 1

    def _open(self, at: int) -> None:
        when = dt.datetime.fromtimestamp(0, dt.UTC) + dt.timedelta(microseconds=at)
        stem = f"{self.key[0]}/{expanded(self.layout.template, when)}"
        self.seq = self.seq_of.get(stem, 0)
        self.seq_of[stem] = self.seq + 1
        self.name = f"{stem.replace('{seq}', f'{self.seq:04d}')}-{self.seq:04d}-{self.token}{self.end}"
        self.out = retried(lambda: self.store.create(self.name))
        self.opened_at, self.written, self.blocks, self.file_no = at, 0, [], self.file_no + 1

    def finish(self, trigger: str):
        began = time.perf_counter()
        try:
            self.out.close()
        except Exception as e:
            if not is_refused(e):
                raise
            yield from self._refused_file(e)
            return
        self.out, took = None, round((time.perf_counter() - began) * 1e6)
        for b in self.blocks:
            yield b | {"roll_trigger": trigger, "close_micros": took}

    def close(self):
        yield from self.flush(None)
        if self.out is not None:
            yield from self.finish("end")

    def abandon(self) -> None:
        if self.out is not None:
            self.out.abandon()


def _differs(column: pa.Array) -> np.ndarray:
    """Where a value is not the one before it; nulls are equal to each other."""
    n = len(column)
    unequal = pc.fill_null(pc.not_equal(column.slice(1), column.slice(0, n - 1)), True).to_numpy(zero_copy_only=False)
    if not column.null_count:
        return unequal
    null = column.is_null().to_numpy(zero_copy_only=False)
    return np.where(null[1:] & null[:-1], False, unequal)


def _pieces(batches):
    """The batches' rows in order, with some megabytes of payloads at a time, and these as lines, with their lengths."""
    for batch in batches:
        values, at = batch.column(6), 0
        starts = np.frombuffer(values.buffers()[1], np.int32)[values.offset : values.offset + len(values) + 1] if len(values) else ()
        while at < len(values):
            stop = max(at + 1, int(np.searchsorted(starts, int(starts[at]) + PIECE_BYTES, "right")) - 1)
            some = pa.ListArray.from_arrays(pa.array([0, stop - at], pa.int32()), values.slice(at, stop - at))
            yield batch.slice(at, stop - at), memoryview(pc.binary_join(some, b"\n")[0].as_py() + b"\n"), np.diff(starts[at : stop + 1])
            at = stop


def _written_rows(files, layout: Layout, limits: Limits, run: str, batches):
    """Writes rows that come sorted by lane and place, one open file at a time; gives manifest rows."""
    key, lane = None, None
    try:
        for batch, lines, lengths in _pieces(batches):
            of = [batch.column(c) for c in range(5)]
            new = np.ones(batch.num_rows, bool)
            if batch.num_rows > 1:
                new[1:] = np.logical_or.reduce([_differs(c) for c in of])
            times = batch.column(5).cast(pa.int64()).to_numpy(zero_copy_only=False)
            offs = batch.column(7).to_numpy(zero_copy_only=False)
            starts, window, ends = np.flatnonzero(new).tolist(), of[2].cast(pa.int64()), np.cumsum(lengths.astype(np.int64) + 1)
            for a, b in zip(starts, [*starts[1:], batch.num_rows]):
                now = (of[0][a].as_py(), of[1][a].as_py(), window[a].as_py(), of[3][a].as_py(), of[4][a].as_py())
                if now != key:
                    if lane:
                        yield from lane.close()
                    key, lane = now, _Lane(files, now, layout, limits, run)
                begin = int(ends[a - 1]) if a else 0
                yield from lane.add(lines[begin : int(ends[b - 1])], ends[a:b] - begin, lengths[a:b], times[a:b], offs[a:b])
        if lane:
            yield from lane.close()
    except BaseException:
        if lane:
            lane.abandon()
        raise


@dataclass
class _Written(WriterCommitMessage):
    """What a task tells the driver: its part of the manifest, if it wrote any."""

    part: str | None


class _Through(io.RawIOBase):
    """A new file as a stream that others write to and count in; closing the stream does not close the file."""

    def __init__(self, out):
        self.out, self.written = out, 0

    def writable(self) -> bool:
        return True

    def write(self, data) -> int:
        self.out.write(bytes(data))
        self.written += len(data)
        return len(data)

    def tell(self) -> int:
        return self.written


class _Sink(DataSourceArrowWriter):
    """Writes lanes to a store and the manifest's parts beside one another, and ends the job either way."""

    def __init__(self, spec: dict):
        self.store, self.manifest = (Store(*spec[k]) for k in ("store", "manifest"))
        self.layout, self.limits, self.run, self.job = Layout(*spec["layout"]), Limits(*spec["limits"]), spec["run"], uuid.uuid4().hex

    def write(self, iterator):
        files, beside = self.store.open().begin(self.job), self.manifest.open().begin(self.job)
        name = f"part-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}.parquet"
        held, out, parquet = [], None, None

        def save():
            nonlocal out, parquet
            if out is None:
                out = beside.create(name)
                parquet = pq.ParquetWriter(_Through(out), _ARROW, compression="zstd")
            parquet.write_batch(pa.RecordBatch.from_arrays([pa.array([r.get(n) for r in held], t) for n, t in zip(_ARROW.names, _ARROW.types)], schema=_ARROW))
            held.clear()

        for row in _written_rows(files, self.layout, self.limits, self.run, iterator):
            held.append(row)
            if len(held) >= MANIFEST_ROWS:
                save()
        if held:
            save()
        files.sync()
        if out is not None:
            parquet.close()
            out.close()
            beside.sync()
        return _Written(name if out is not None else None)

    def commit(self, messages) -> None:
        """The manifest is what the tasks that count wrote; parts of other attempts and earlier runs go."""
        beside, parts = self.manifest.open(), {m.part for m in messages if m is not None and m.part}
        if not parts:  # nothing came: the manifest is there, and empty
            parts.add(name := f"part-none-{self.job}.parquet")
            out = beside.create(name)
            pq.write_table(_ARROW.empty_table(), _Through(out))
            out.close()
        for name in beside.names(""):
            if name.endswith(".parquet") and name not in parts:
                beside.delete(name)
        for store in (self.store, self.manifest):
            store.open().settle(self.job)

    def abort(self, messages) -> None:
        for store in (self.store, self.manifest):
            store.open().undo(self.job)


class _ArchiveSink(DataSource):
    """The sink's name is for Spark's protocol alone: write_archive prepares what it takes."""

    @classmethod
    def name(cls) -> str:
        return "driftvault_sink"

    def writer(self, schema, overwrite: bool):
        return _Sink(json.loads(self.options["spec_secret"]))


_ROWS = [*LANE, "_split", "_base", "ts", "value", "off"]


def lane_rows(routed: DataFrame, lane_offsets: int | None = LANE_OFFSETS) -> DataFrame:
    """Routed records as the writer takes them, with `_split`, the range of offsets (0 where none cuts a lane). A null ts is the window's start, or
    1970 where that is null too; a null value is an empty payload; a null offset comes before all others."""
    start = F.coalesce("ts", "window", F.timestamp_seconds(F.lit(0)))
    return routed.filter("destination IS NOT NULL").withColumns({
        "part": F.col("part").cast("int"), "window": F.col("window").cast("timestamp"), "off": F.coalesce(F.col("off").cast("long"), F.lit(NO_OFFSET)),
        "ts": start.cast("timestamp"), "value": F.coalesce(F.col("value").cast("binary"), F.lit(b"")),
    }).withColumn("_split", (F.lit(0) if lane_offsets is None else F.floor(F.col("off") / lane_offsets)).cast("long"))


def in_lane(rows: DataFrame) -> DataFrame:
    """lane_rows with `_pos`, each one's place in its lane: by offset, then time, then payload. A lane has a bounded
    range of offsets."""
    order = Window.partitionBy(*LANE, "_split").orderBy("off", "ts", "value")
    return rows.withColumn("_pos", F.row_number().over(order).cast("long") - 1)


def in_lanes(rows: DataFrame, lanes: DataFrame, how: str, *on: Column) -> DataFrame:
    """lane_rows joined with rows that name lanes (the lane's columns and split); nulls are equal to each other."""
    names = {c: f"_of_{c}" for c in (*LANE, "split")}
    same = [F.col(c).eqNullSafe(F.col(names[c])) for c in LANE] + [F.col("_split") == F.col(names["split"])]
    return rows.join(lanes.withColumnsRenamed(names), reduce(Column.__and__, [*same, *on]), how).drop(*names.values())


def _write(rows: DataFrame, store: Store, manifest: Store, run: str, layout: Layout, limits: Limits, parts: int | None) -> None:
    spark, lane = rows.sparkSession, [*LANE, "_split", "_base"]
    spec = {"store": [store.uri, store.settings], "manifest": [manifest.uri, manifest.settings], "layout": [*layout._replace(codec=codec_name(layout.codec))], "limits": [*limits], "run": run}
    spark.dataSource.register(_ArchiveSink)
    dealt = rows.repartition(parts, *lane) if parts else rows.repartition(*lane)
    ordered = dealt.sortWithinPartitions(*lane, "off", "ts", "value").select(*_ROWS)
    # Spark shows no option whose name says that it is secret: the stores' keys are in this one
    ordered.write.format("driftvault_sink").mode("append").option("spec_secret", json.dumps(spec)).save()


def write_archive(
    routed: DataFrame, store: Store | str, run: str, layout: Layout = Layout(), limits: Limits = Limits(), parts: int | None = None, lane_offsets: int | None = LANE_OFFSETS,
    manifest: Store | str | None = None, read_from: str | None = None, options: dict[str, str] | None = None,
) -> DataFrame:
    """Archives routed (destination, part, window, off, ts, value) and returns the manifest, which is kept in a folder of
    its own (`manifest`; read_from, options: how Spark reads it, where that differs).

    Records without a destination are not written. Nulls of part and window are lanes of their own, those of the other
    columns are as lane_rows has them. A lane is written by one task as a stream, in a total order, so that a repeated
    task or run writes the same bytes; more than `lane_offsets` offsets of one partition are lanes of their own, so a
    hot destination is many tasks; with None, a lane is one whatever its offsets, and its flushes follow each other from
    its first record to its last. A file that is there already with other contents is an error, never replaced.

    Where a store refuses a whole file for good, its records are written again in two halves, round by round, until
    those that are refused stand alone; their rows have `refusal` and no path. Where it refuses the name, none is tried
    again. When this fails, the files that it made are gone.
    """
    spark, store = routed.sparkSession, Store.of(store)
    manifest = Store.of(manifest if manifest is not None else shared_folder(spark, "manifest"))
    read_from, rows = read_from or manifest.uri, lane_rows(routed, lane_offsets)
    for name in ("round=" + str(k) for k in range(1, 99)):  # of an earlier attempt at this batch
        files = manifest.open()
        if not files.names(name):
            break
        files.delete_folder(name)
    _write(rows.withColumn("_base", F.lit(0).cast("long")), store, manifest.below("round=0"), run, layout, limits, parts)
    for k in range(1, 99):
        again = _manifest_rows(spark, read_from, options).filter(F.col("round") == k - 1).filter(_TRIED_AGAIN)
        if again.isEmpty():
            break
        half = F.floor(F.col("n_records") / 2)
        halves = F.array(F.struct(F.col("first_pos").alias("base"), half.alias("n")), F.struct((F.col("first_pos") + half).alias("base"), (F.col("n_records") - half).alias("n")))
        pieces = again.select(*LANE, "split", F.explode(halves).alias("h")).select(*LANE, "split", "h.*")
        asked = pieces.withColumn("at", F.explode(F.sequence(F.col("base"), F.col("base") + F.col("n") - 1)))
        lanes = pieces.select(*LANE, "split").distinct()
        some = in_lanes(in_lane(in_lanes(rows, lanes, "left_semi")), asked, "inner", F.col("_pos") == F.col("at"))
        _write(some.withColumn("_base", F.col("base")), store, manifest.below(f"round={k}"), f"{run}/again-{k}", layout, limits, parts)
    return read_manifest(spark, read_from, options)


#: Rows of a manifest whose records were written again in a later round.
_TRIED_AGAIN = "coalesce(refused_at = 'write' AND n_records > 1, false)"


def _manifest_rows(spark: SparkSession, folder: str, options: dict[str, str] | None) -> DataFrame:
    return spark.read.options(**(options or {})).schema(MANIFEST + ", round int").parquet(folder)


def read_manifest(spark: SparkSession, folder: str, options: dict[str, str] | None = None) -> DataFrame:
    """The rows of a manifest's folder, or of one with a folder for each batch: what is archived, and what was refused
    in the end."""
    return _manifest_rows(spark, folder, options).filter(f"NOT {_TRIED_AGAIN}").drop("round")


def refused_records(manifest: DataFrame) -> DataFrame:
    """The lane, `split`, place `at` and refusal of each record that the store refused in the end."""
    places = F.sequence(F.col("first_pos"), F.col("first_pos") + F.col("n_records") - 1)
    return manifest.filter("refusal IS NOT NULL").select(*LANE, "split", "refusal", F.explode(places).alias("at"))


_RESTORED = pa.schema([("path", pa.string()), ("destination", pa.string()), ("part", pa.int32()), ("block", pa.int32()), ("pos", pa.int32()), ("value", pa.binary())])


def _cut(lines: bytes, lengths: np.ndarray) -> pa.Array:
    """The payloads of a block, without the line end after each: cut by their lengths, so line ends within do no harm."""
    offsets = np.zeros(len(lengths) + 1, np.int32)
    np.cumsum(lengths, out=offsets[1:])
    data = np.delete(np.frombuffer(lines, np.uint8), offsets[1:] + np.arange(len(lengths)))
    return pa.Array.from_buffers(pa.binary(), len(lengths), [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def restore(manifest: DataFrame, store: Store | str, codec: str = "zstd", as_text: bool = True) -> DataFrame:
    """The records of a manifest's blocks: path, destination, part, block, pos, value, byte for byte. Neighbouring
    blocks of a file are read at once, each by its place; files are cut between tasks, so a large one is many tasks'."""
    codec, store = codec_name(codec), Store.of(store)

    def task(batches):
        files = store.open()
        for batch in batches:
            for row in batch.to_pylist():
                with files.read(row["path"]) as f:
                    for b in row["blocks"]:
                        f.seek(b["start"])
                        data = decompress(codec, f.read(b["length"]))
                        if len(data) != b["raw_bytes"]:
                            raise ValueError(f"{row['path']}: block {b['block']} has {len(data)} bytes, not {b['raw_bytes']}")
                        n = len(b["lengths"])
                        constant = [pa.repeat(pa.scalar(row[c], _RESTORED.field(c).type), n) for c in ("path", "destination", "part")]
                        block = pa.repeat(pa.scalar(b["block"], pa.int32()), n)
                        yield pa.RecordBatch.from_arrays([*constant, block, pa.array(np.arange(n, dtype=np.int32)), _cut(data, np.array(b["lengths"], np.int64))], schema=_RESTORED)

    block = F.struct("block", "start", "length", "raw_bytes", "lengths")
    reads = manifest.groupBy("path", "destination", "part", F.floor(F.col("block") / READ_BLOCKS).alias("_read")).agg(F.sort_array(F.collect_list(block)).alias("blocks"))
    # by their number, not by the size of what the manifest says of them, which is small for any amount of data
    n, most = manifest.select("path", F.floor(F.col("block") / READ_BLOCKS)).distinct().count(), 2 * manifest.sparkSession.sparkContext.defaultParallelism
    reads = reads.repartition(max(1, min(n, max(most, n // 8))), "path", "_read")
    out = reads.drop("_read").mapInArrow(task, "path string, destination string, part int, block int, pos int, value binary")
    return out.withColumn("value", F.col("value").cast("string")) if as_text else out


def compare_with_files(manifest: DataFrame, files: DataFrame) -> DataFrame:
    """What a manifest says against what is there: path, state, n_bytes, stated_bytes. files: (path, n_bytes), as
    Store.list gives them. state: `whole`, `short`, `long`, `missing`, or `unknown` for files that no manifest names."""
    stated = manifest.groupBy("path").agg(F.max(F.col("start") + F.col("length")).alias("stated_bytes"))
    n, want = F.col("n_bytes"), F.col("stated_bytes")
    state = F.when(n.isNull(), "missing").when(want.isNull(), "unknown").when(n < want, "short").when(n > want, "long").otherwise("whole")
    return stated.join(files, "path", "full_outer").select("path", state.alias("state"), "n_bytes", "stated_bytes")
