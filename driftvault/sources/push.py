"""The push way in: producers append segments to a log in a shared store, and a stream reads them by offset.

A log has a folder for each producer, which alone appends to it: a part of the source. A segment is an Arrow file whose
name says its first offset and how many records it has; it is there as a whole or not at all, so what was pushed is
kept from then on, whatever becomes of producer or reader. Segments go when a batch that has them is committed.
"""

from __future__ import annotations

import datetime as dt
import io
import json
import re
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from driftvault.sources.stores import Files, Store

_SEGMENT = re.compile(r"(\d{20})-(\d{10})\.arrow\Z")
_PUSHED = pa.schema([("topic", pa.string()), ("ts", pa.timestamp("us", tz="UTC")), ("value", pa.binary())])
_RECORDS = "topic string, part int, off long, ts timestamp, value binary"
_RECORDS_ARROW = pa.schema([("topic", pa.string()), ("part", pa.int32()), ("off", pa.int64()), ("ts", pa.timestamp("us", tz="UTC")), ("value", pa.binary())])
#: Records that one task reads about.
TASK_RECORDS = 500_000


def _folder(part: int) -> str:
    return f"{part:05d}"


def segments(files: Files, part: int) -> list[tuple[int, int, str]]:
    """(first offset, number of records, path) of a part's segments, in order. Files of other names are none."""
    found = ((m, n) for n in files.names(_folder(part)) if (m := _SEGMENT.match(n)))
    return sorted((int(m[1]), int(m[2]), f"{_folder(part)}/{n}") for m, n in found)


class PushLog:
    """A producer's end of a log. It goes on where its last whole segment ends, also after a crash."""

    def __init__(self, store: Store | str, part: int = 0):
        self.files, self.part = Store.of(store).open(), part
        self.next = max([self._kept_end(), *(first + n for first, n, _ in segments(self.files, part))])

    def _kept_end(self) -> int:
        """Where segments that are gone ended: the reader notes it before it deletes any."""
        path = f"{_folder(self.part)}/committed"
        if not self.files.exists(path):
            return 0
        with self.files.read(path) as f:
            return int(f.read() or b"0")

    def append(self, records: list[tuple[str | None, dt.datetime | None, bytes | None]]) -> range:
        """Appends (topic, ts, value) and returns their offsets; when this returns they are kept. A null topic is the
        empty one: such a record is routed by its fields alone."""
        if not records:
            return range(self.next, self.next)
        topics, times, values = zip(*records)
        batch = pa.RecordBatch.from_arrays([pa.array([t or "" for t in topics], pa.string()), pa.array(times, _PUSHED.field("ts").type), pa.array(values, pa.binary())], schema=_PUSHED)
        sink = io.BytesIO()
        with pa.ipc.new_file(sink, _PUSHED) as writer:
            writer.write_batch(batch)
        out = self.files.create(f"{_folder(self.part)}/{self.next:020d}-{len(records):010d}.arrow")
        out.write(sink.getvalue())
        out.close()
        first, self.next = self.next, self.next + len(records)
        return range(first, self.next)


@dataclass
class _Segments(InputPartition):
    part: int
    start: int
    stop: int
    paths: list[tuple[int, str]]


class PushReader(DataSourceStreamReader):
    """A log as a stream: offsets are {part: the offset after the last record}."""

    def __init__(self, store: Store):
        self.store = store

    def _parts(self, files: Files) -> list[int]:
        found = files.store.get_file_info(fs.FileSelector(files.at(""), allow_not_found=True))
        return sorted(int(i.base_name) for i in found if i.type == fs.FileType.Directory and i.base_name.isdigit())

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        files = self.store.open()
        ends = {str(p): max([PushLog(self.store, p)._kept_end(), *(first + n for first, n, _ in segments(files, p))]) for p in self._parts(files)}
        return {p: end for p, end in ends.items() if end}

    def partitions(self, start: dict, end: dict):
        files, out = self.store.open(), []
        for name, stop in end.items():
            part, at = int(name), start.get(name, 0)
            if stop <= at:
                continue
            held = [(first, n, path) for first, n, path in segments(files, part) if first < stop and first + n > at]
            reached = at
            for first, n, path in held:
                if first > reached:
                    break
                if not out or out[-1].part != part or reached - out[-1].start >= TASK_RECORDS:
                    out.append(_Segments(part, reached, reached, []))
                out[-1].paths.append((first, path))
                reached = out[-1].stop = min(stop, first + n)
            if reached < stop:
                raise OSError(f"offsets {reached} to {stop - 1} of part {part} are no longer in the log")
        return out

    def read(self, partition: _Segments):
        files = self.store.open()
        for first, path in partition.paths:
            with files.read(path) as f:
                table = pa.ipc.open_file(f).read_all()
            lo, hi = max(partition.start - first, 0), min(partition.stop - first, table.num_rows)
            for batch in table.slice(lo, hi - lo).to_batches(max_chunksize=10_000):
                n = batch.num_rows
                columns = [batch.column(0), pa.repeat(pa.scalar(partition.part, pa.int32()), n), pa.array(range(first + lo, first + lo + n), pa.int64()), batch.column(1), batch.column(2)]
                yield pa.RecordBatch.from_arrays(columns, schema=_RECORDS_ARROW)
                lo += n

    def commit(self, end: dict) -> None:
        """Deletes segments that lie before `end`; where they ended is kept, so that no offset is given out again."""
        files = self.store.open()
        for name, stop in end.items():
            gone = [(first + n, path) for first, n, path in segments(files, int(name)) if first + n <= stop]
            if not gone:
                continue
            with files.store.open_output_stream(files.at(f"{_folder(int(name))}/committed"), compression=None) as out:
                out.write(str(max(end for end, _ in gone)).encode())
            for _, path in gone:
                files.delete(path)


class PushSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "driftvault_push"

    def schema(self) -> str:
        return _RECORDS

    def streamReader(self, schema) -> PushReader:
        return PushReader(Store(*json.loads(self.options["spec_secret"])))


def push_stream(spark: SparkSession, store: Store | str) -> DataFrame:
    """A stream of the records (topic, part, off, ts, value) that producers append to a log."""
    store = Store.of(store)
    spark.dataSource.register(PushSource)
    return spark.readStream.format("driftvault_push").option("spec_secret", json.dumps([store.uri, store.settings])).load()
