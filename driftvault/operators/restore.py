"""Records from archive files alone, without a manifest: any file's lines, and an archive's folder as a source."""

from __future__ import annotations

import datetime as dt
import json
import re
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual

from driftvault.functions.codecs import EXTENSION_OF, codec_name, decompressed
from driftvault.functions.frames import Between, first_frame, whole_until
from driftvault.operators.errors import is_unreadable
from driftvault.sources.shared import shared_folder
from driftvault.sources.stores import STAGING, Store

#: Bytes of a file, as it lies in its store, that one task reads about; opening a file counts as so many.
RANGE_BYTES, OPENING_BYTES = 64 << 20, 1 << 20
_LINES = pa.schema([("uri", pa.string()), ("line", pa.int64()), ("value", pa.binary()), ("problem", pa.string())])
_LINES_DDL = "uri string, line long, value binary, problem string"


def _opened(uri: str, settings: dict | None):
    return Store(uri, settings or {}).open().read("")


def _problem(error: Exception) -> str:
    if not is_unreadable(error):
        raise error
    return f"{type(error).__name__}: {error}"


def _lines(uri: str, first: int, values: list[bytes]) -> pa.RecordBatch:
    n = len(values)
    return pa.RecordBatch.from_arrays([pa.repeat(uri, n), pa.array(range(first, first + n), pa.int64()), pa.array(values, pa.binary()), pa.nulls(n, pa.string())], schema=_LINES)


def _failed(uri: str, problem: str) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([uri]), pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()), pa.array([problem])], schema=_LINES)


def _data(raw, codec: str, start: int, stop: int):
    """What the frames between two places hold, some megabytes at a time. Where the last one is cut short, what the
    whole ones before it hold comes first."""
    given = 0
    try:
        for data in decompressed(codec, Between(raw, start, stop)):
            given += len(data)
            yield data
    except Exception as failure:
        end = whole_until(raw, codec, start, stop)
        if end is None or end == stop:
            raise
        for data in decompressed(codec, Between(raw, start, end)):
            if given < len(data):
                yield data[given:]
            given = max(0, given - len(data))
        raise EOFError("the file ends within a frame") from failure
    if whole_until(raw, codec, start, stop) not in (None, stop):
        raise EOFError("the file ends within a frame")


def _dealt(rows: DataFrame, n: int, *keys: str) -> DataFrame:
    """Few bytes that ask for much work, dealt to tasks by their number: by their size Spark would make one task of them."""
    most = 2 * rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(max(1, min(n, max(most, n // 8))), *keys)


_RANGES = "uri string, size long, k long, start long, stop long, problem string"


def _ranges(uris: DataFrame, codec: str, range_bytes: int, settings: dict | None) -> DataFrame:
    """For each file its ranges of whole frames in order: k, start, stop. Every byte is looked at once, by the task of
    the range that it lies in, to find the first frame there; a range without one is part of the one before."""

    def sizes(batches):
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                size, problem = None, None
                try:
                    with _opened(uri, settings) as raw:
                        size = raw.size()
                except Exception as e:  # noqa: BLE001 - any other failure is raised again
                    problem = _problem(e)
                yield pa.RecordBatch.from_arrays([pa.array([uri]), pa.array([size], pa.int64()), pa.array([problem], pa.string())], names=["uri", "size", "problem"])

    def starts(batches):
        for batch in batches:
            for row in batch.to_pylist():
                with _opened(row["uri"], settings) as raw:
                    row["start"] = first_frame(raw, codec, row["at"], min(row["at"] + range_bytes, row["size"]), row["size"])
                yield pa.RecordBatch.from_pylist([row], schema=pa.schema([("uri", pa.string()), ("size", pa.int64()), ("at", pa.int64()), ("start", pa.int64())]))

    named = uris.select("uri").filter("uri IS NOT NULL").distinct()
    sized = _dealt(named, named.count(), "uri").mapInArrow(sizes, "uri string, size long, problem string")
    at = shared_folder(uris.sparkSession, "file-sizes")
    sized.write.parquet(at)
    sized = uris.sparkSession.read.parquet(at)
    cut = sized.filter(F.col("size") > range_bytes).select("uri", "size", F.explode(F.sequence(F.lit(0), F.floor((F.col("size") - 1) / range_bytes))).alias("k"))
    cut = cut.select("uri", "size", (F.col("k") * range_bytes).alias("at"))
    found = _dealt(cut, cut.count(), "uri", "at").mapInArrow(starts, "uri string, size long, at long, start long").filter("start IS NOT NULL")
    order = Window.partitionBy("uri").orderBy("start")
    many = found.select("uri", "size", (F.row_number().over(order) - 1).cast("long").alias("k"), "start", F.lead("start", 1).over(order).alias("next"))
    many = many.select("uri", "size", "k", "start", F.coalesce("next", "size").alias("stop"), F.lit(None).cast("string").alias("problem"))
    zero = F.lit(0).cast("long")
    one = sized.filter((F.col("size") <= range_bytes) | F.col("problem").isNotNull()).select("uri", "size", zero.alias("k"), zero.alias("start"), F.col("size").alias("stop"), "problem")
    at = shared_folder(uris.sparkSession, "file-ranges")
    one.unionByName(many).write.parquet(at)
    return uris.sparkSession.read.schema(_RANGES).parquet(at)


_SCANNED = pa.schema([("uri", pa.string()), ("k", pa.int64()), ("ends", pa.int64()), ("head", pa.binary()), ("problem", pa.string())])


def _scanned(ranges: DataFrame, codec: str, settings: dict | None) -> DataFrame:
    """For each range: how many lines end in it, and its bytes up to the first end (all, where there is none)."""

    def task(batches):
        for batch in batches:
            for row in batch.to_pylist():
                ends, head, problem = 0, [], None
                try:
                    with _opened(row["uri"], settings) as raw:
                        for data in _data(raw, codec, row["start"], row["stop"]):
                            if not ends:
                                cut = data.find(b"\n")
                                head.append(data if cut < 0 else data[: cut + 1])
                            ends += data.count(b"\n")
                except Exception as e:  # noqa: BLE001 - any other failure is raised again
                    problem = _problem(e)
                yield pa.RecordBatch.from_pylist([{"uri": row["uri"], "k": row["k"], "ends": ends, "head": b"".join(head), "problem": problem}], schema=_SCANNED)

    at = shared_folder(ranges.sparkSession, "range-ends")
    _dealt(ranges, ranges.count(), "uri", "k").mapInArrow(task, "uri string, k long, ends long, head binary, problem string").write.parquet(at)
    return ranges.sparkSession.read.parquet(at)


def restore_files(uris: DataFrame, codec: str, settings: dict | None = None, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Lines of archive files without a manifest (uri), as bytes: uri, line, value, problem. Each file is read once,
    however often it is named. Paths of any name are read, also those that begin with `_` or `.`, which Spark's own file
    sources pass over. A file that can never be read, or only as far as some line, ends with a row that has nothing but
    the problem; any other failure is raised.

    A file of more than `range_bytes` is cut at frames between many tasks, whoever wrote it; a file of one frame is one
    task's, as a stream. Of such files the lines that end in each range are counted first, so that lines are numbered
    through, and a line that reaches over cuts is put together by the task of the range that it begins in.
    """
    codec = codec_name(codec)
    ranges = _ranges(uris, codec, range_bytes, settings)
    per = ranges.groupBy("uri").agg(F.count("*").alias("n_ranges"))
    ranges = ranges.join(per, "uri")
    small = ranges.filter("n_ranges = 1").select("uri", "start", "stop", "problem", F.lit(True).alias("first"), F.lit(0).cast("long").alias("before"), F.lit(True).alias("only"), F.lit(None).cast("binary").alias("opening"), F.lit(None).cast("binary").alias("rest"))
    large = ranges.filter("n_ranges > 1")
    if not large.isEmpty():
        scanned = _scanned(large.select("uri", "k", "start", "stop"), codec, settings)
        earlier = Window.partitionBy("uri").orderBy("k").rowsBetween(Window.unboundedPreceding, -1)
        zero = F.lit(0).cast("long")
        placed = scanned.withColumns({"before": F.coalesce(F.sum("ends").over(earlier), zero), "line_of": F.coalesce(F.count_if(F.col("ends") > 0).over(earlier), zero)})
        # the heads of ranges continue the line that begins in the last range before with an end, or in the file's first
        heads = placed.groupBy("uri", "line_of").agg(F.sort_array(F.collect_list(F.struct("k", "head"))).alias("h"))
        heads = heads.select("uri", "line_of", F.aggregate("h", F.lit(b""), lambda acc, x: F.concat(acc, x["head"])).alias("joined"))
        begun = placed.select("uri", "k", "ends", "before", F.col("problem").alias("scan_problem"), F.when(F.col("ends") > 0, F.col("line_of") + 1).alias("own"))
        told = begun.join(heads.select("uri", F.col("line_of").alias("own"), F.col("joined").alias("rest")), ["uri", "own"], "left")
        told = told.join(heads.filter("line_of = 0").select("uri", F.lit(0).cast("long").alias("k"), F.col("joined").alias("opening")), ["uri", "k"], "left")
        told = large.select("uri", "k", "start", "stop").join(told, ["uri", "k"])
        small = small.unionByName(told.select(
            "uri", "start", "stop", F.col("scan_problem").alias("problem"), (F.col("k") == 0).alias("first"), "before", F.lit(False).alias("only"), "opening",
            F.when(F.col("ends") > 0, F.coalesce("rest", F.lit(b""))).alias("rest"),
        ))

    def numbered(raw, row):
        """(number of the first, lines) of a range, some at a time; what is left at a file's end is a failure."""
        at, rest, skip = row["before"], b"", not row["only"]
        if row["opening"]:
            if not row["opening"].endswith(b"\n"):
                raise EOFError("the file ends within a line")
            yield 0, [row["opening"][:-1]]
        try:
            for data in _data(raw, codec, row["start"], row["stop"]):
                *lines, rest = (rest + data).split(b"\n")
                if lines:
                    yield (at + 1, lines[1:]) if skip else (at, lines)
                    at, skip = at + len(lines), False
        except EOFError:
            if row["only"] or row["rest"] is None:
                raise
        if row["only"]:
            last, whole = rest, False
        elif row["rest"] is None:
            return
        else:
            last, whole = rest + row["rest"], row["rest"].endswith(b"\n")
        if whole:
            yield at, [last[:-1]]
        elif last:
            raise EOFError("the file ends within a line")
        if row["problem"]:
            raise EOFError(row["problem"].partition(": ")[2])

    def task(batches):
        for batch in batches:
            for row in batch.to_pylist():
                if row["only"] and row["problem"]:
                    yield _failed(row["uri"], row["problem"])
                    continue
                try:
                    with _opened(row["uri"], settings) as raw:
                        for first, values in numbered(raw, row):
                            if values:
                                yield _lines(row["uri"], first, values)
                except Exception as e:  # noqa: BLE001 - any other failure is raised again
                    yield _failed(row["uri"], _problem(e))

    return _dealt(small, ranges.count(), "uri", "start").mapInArrow(task, _LINES_DDL)


# -- an archive's folder as a source --

#: What a template's placeholders look like in a path.
_SHAPES = {"{year}": r"(?P<year>\d{4,})", "{month}": r"(?P<month>\d\d)", "{day}": r"(?P<day>\d\d)", "{hour}": r"(?P<hour>\d\d)", "{minute}": r"(?P<minute>\d\d)", "{timestamp}": r"-?\d+", "{seq}": r"\d{4,}"}


def path_pattern(template: str, extension: str, codec: str) -> re.Pattern:
    """What the paths of an archive's files look like: destination, then the template, number and token."""
    shape, seen = "", set()
    for piece in re.split(r"(\{[a-z]+\})", template):
        known = _SHAPES.get(piece, re.escape(piece))
        shape += re.sub(r"\(\?P<[a-z]+>(.*)\)", r"\1", known) if piece in seen else known
        seen.add(piece)
    end = f".{extension}" + (f".{EXTENSION_OF[codec]}" if EXTENSION_OF[codec] else "")
    return re.compile(rf"(?P<destination>.+)/{shape}-\d{{4,}}-[0-9a-f]{{16}}{re.escape(end)}\Z")


def opened_hour(found: re.Match) -> dt.datetime | None:
    """The hour, or the day where a template has no more, that a file was opened in."""
    parts = found.groupdict()
    if not parts.get("year"):
        return None
    return dt.datetime(int(parts["year"]), int(parts.get("month") or 1), int(parts.get("day") or 1), int(parts.get("hour") or 0))


@dataclass
class _FileRange:
    path: str
    destination: str
    hour: dt.datetime | None
    start: int
    stop: int
    size: int


@dataclass
class _Ranges(InputPartition):
    """What one task reads: small files together."""

    ranges: list[_FileRange]


_SOURCE = pa.schema([("path", pa.string()), ("destination", pa.string()), ("hour", pa.timestamp("us")), ("value", pa.binary())])


class ArchiveReader(DataSourceReader):
    """Reads an archive's files that its filters leave, in ranges of bytes. Filters on destination and hour are answered
    by paths: folders of other destinations and other times are not listed."""

    def __init__(self, spec: dict):
        self.store, self.template, self.extension, self.codec = Store(*spec["store"]), spec["template"], spec["extension"], spec["codec"]
        self.range_bytes, self.cores = spec["range_bytes"], spec["cores"]
        self.destinations: set[str] | None = None
        self.since: dt.datetime | None = None
        self.until: dt.datetime | None = None
        self.listed = 0

    def pushFilters(self, filters):
        for f in filters:
            name = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            if name == "destination" and isinstance(f, (EqualTo, In)):
                asked = {f.value} if isinstance(f, EqualTo) else set(f.value)
                self.destinations = asked if self.destinations is None else self.destinations & asked
                continue
            if name == "hour" and isinstance(f, (EqualTo, GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual)):
                at = f.value.astimezone(dt.UTC).replace(tzinfo=None) if f.value.tzinfo else f.value
                if isinstance(f, (EqualTo, GreaterThan, GreaterThanOrEqual)):
                    self.since = max(self.since or at, at)
                if isinstance(f, (EqualTo, LessThan, LessThanOrEqual)):
                    self.until = min(self.until or at, at)
            yield f  # files are left out by paths; what a bound leaves is Spark's to decide

    def _wanted(self, found: re.Match) -> bool:
        hour = opened_hour(found)
        if self.destinations is not None and found["destination"] not in self.destinations:
            return False
        return hour is None or (self.since is None or hour >= self.since) and (self.until is None or hour <= self.until)

    def _can_hold(self, folder: str) -> bool:
        """Whether files that are wanted may lie below a folder: by its destination, and by the times it can have."""
        if folder.split("/")[0] == STAGING:
            return False
        levels = self.template.split("/")[:-1]
        for d in self.destinations if self.destinations is not None else ():
            if d == folder or d.startswith(f"{folder}/"):
                return True
        inside = [d for d in self.destinations or () if folder.startswith(f"{d}/")]
        if self.destinations is not None and not inside:
            return False
        if self.destinations is None:
            return True
        return any(self._time_fits(levels, folder.removeprefix(f"{d}/").split("/")) for d in inside)

    def _time_fits(self, levels: list[str], names: list[str]) -> bool:
        if len(names) > len(levels):
            return True
        shape = "/".join(levels[: len(names)])
        found = re.fullmatch(re.sub(r"\\?\{([a-z]+)\\?\}", lambda m: _SHAPES.get("{" + m[1] + "}", ".*"), re.escape(shape)), "/".join(names))
        first = opened_hour(found) if found else None
        if first is None:
            return True
        parts = found.groupdict()
        span = dt.timedelta(hours=1) if parts.get("hour") else dt.timedelta(days=1) if parts.get("day") else dt.timedelta(days=31) if parts.get("month") else dt.timedelta(days=366)
        return (self.until is None or first <= self.until) and (self.since is None or first + span > self.since)

    def partitions(self):
        files, pattern, out, folders = self.store.open(), path_pattern(self.template, self.extension, self.codec), [], [""]
        if self.destinations is not None:
            folders = sorted(d for d in self.destinations if d)
        while folders:
            folder = folders.pop()
            self.listed += 1
            for info in files.store.get_file_info(fs.FileSelector(files.at(folder), allow_not_found=True)):
                path = files.relative(info.path)
                if info.type == fs.FileType.Directory:
                    if self._can_hold(path):
                        folders.append(path)
                    continue
                found = pattern.match(path)
                if found and self._wanted(found):
                    out += [_FileRange(path, found["destination"], opened_hour(found), at, min(at + self.range_bytes, info.size), info.size) for at in range(0, info.size, self.range_bytes)]
        return self._together(out)

    def _together(self, ranges: list[_FileRange]) -> list[_Ranges]:
        """Small files share tasks, as far as all cores have some."""
        cost = [r.stop - r.start + min(OPENING_BYTES, self.range_bytes) for r in ranges]
        most, out, held = max(1, min(self.range_bytes, sum(cost) // self.cores)), [], 0
        for r, c in zip(ranges, cost):
            if not out or held + c > most:
                out.append(_Ranges([]))
                held = 0
            out[-1].ranges.append(r)
            held += c
        return out

    def read(self, partition: _Ranges | None):
        # Spark's only partition of a source that has none is null
        files = self.store.open() if partition is not None else None
        for part in partition.ranges if partition is not None else ():
            yield from self._read(files, part)

    def _read(self, files, part: _FileRange):
        with files.read(part.path) as raw:
            start = first_frame(raw, self.codec, part.start, part.stop, part.size)
            if start is None:
                return
            if self.codec == "none":
                start, stop = (_after_line(raw, at, part.size) if at else 0 for at in (part.start, part.stop))
            else:
                stop = first_frame(raw, self.codec, part.stop, part.size, part.size) if part.stop < part.size else None
            rest = b""
            for data in _data(raw, self.codec, start, part.size if stop is None else stop):
                *lines, rest = (rest + data).split(b"\n")
                for at in range(0, len(lines), 10_000):
                    some = lines[at : at + 10_000]
                    same = [pa.repeat(pa.scalar(v, t), len(some)) for v, t in ((part.path, pa.string()), (part.destination, pa.string()), (part.hour, pa.timestamp("us")))]
                    yield pa.RecordBatch.from_arrays([*same, pa.array(some, pa.binary())], schema=_SOURCE)
            if rest:
                raise EOFError(f"{part.path}: a frame ends within a line; restore_files joins lines over frames")


def _after_line(raw, at: int, size: int) -> int:
    """Where the first line begins that begins at `at` or later."""
    at -= 1
    while at < size:
        raw.seek(at)
        data = raw.read(1 << 16)
        cut = data.find(b"\n")
        if cut >= 0:
            return at + cut + 1
        at += len(data)
    return size


class ArchiveSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "driftvault_archive"

    def schema(self) -> str:
        return "path string, destination string, hour timestamp_ntz, value binary"

    def reader(self, schema) -> ArchiveReader:
        return ArchiveReader(json.loads(self.options["spec_secret"]))


def read_archive(spark: SparkSession, store: Store | str, template: str = "{year}/{month}/{day}/{hour}", codec: str = "zstd", extension: str = "jsonl", range_bytes: int = RANGE_BYTES) -> DataFrame:
    """The records of an archive's folder: path, destination, hour (UTC, of the file's opening, by its path) and value.

    Filters on destination and hour are pushed to the listing: files of others are neither listed nor opened. Files of
    more than range_bytes are many tasks'. An empty or absent folder gives no rows; files of other names are passed over.
    Spark's own switch for filters of Python sources is turned on.
    """
    store = Store.of(store)
    spark.dataSource.register(ArchiveSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spec = {"store": [store.uri, store.settings], "template": template, "extension": extension, "codec": codec_name(codec), "range_bytes": range_bytes, "cores": spark.sparkContext.defaultParallelism}
    return spark.read.format("driftvault_archive").option("spec_secret", json.dumps(spec)).load()
