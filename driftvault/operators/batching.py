"""Which records are flushed together, and which flushes share a file: the limits, and where they end a flush.

Records of a lane (a destination, a source partition, a roll window and a range of offsets) are taken in order. Where
a flush or a file ends depends on where the one before ended, so the archive's writer finds the ends as it goes, by
binary search in the cumulated sizes; what it did stands in its manifest.
"""

from __future__ import annotations

from bisect import bisect_left
from typing import NamedTuple

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LANE = ["destination", "part", "window"]
#: Offsets of a source partition that one lane may reach over: more of them are files of their own, written side by side.
LANE_OFFSETS = 1 << 22
MICROSECONDS = 1_000_000


class Limits(NamedTuple):
    """After a record is added, the buffer is flushed if it holds flush_bytes or more (`size`), flush_records or more
    (`records`), or if flush_secs or more have gone since the last flush or the lane's beginning (`age`), in this
    order. Before a flush is written, its lane's open file is closed if it holds roll_bytes or more (`size`), or else
    if roll_secs whole seconds or more have gone since it was opened (`age`). Times are the records' own."""

    flush_bytes: int = 1 << 20
    flush_records: int = 100_000
    flush_secs: int = 60
    roll_bytes: int = 1 << 30
    roll_secs: int = 300


def roll_window(at: Column, seconds: int) -> Column:
    """The start of the roll window that a time lies in: files never reach over it."""
    return F.window(at, f"{seconds} seconds")["start"]


def _first_from(times: np.ndarray | list[int], at: int, stop: int, bound: int) -> int:
    """The first position from `at` up to `stop` whose time is `bound` or later; else one past stop."""
    if isinstance(times, list):
        return next((k for k in range(at, stop + 1) if times[k] >= bound), max(at, stop + 1))
    width = 64
    while at <= stop:
        hit = np.flatnonzero(times[at : min(at + width, stop + 1)] >= bound)
        if len(hit):
            return at + int(hit[0])
        at, width = at + width, 2 * width
    return stop + 1


def flush_end(ends: np.ndarray | list[int], times: np.ndarray | list[int], at: int, held: int, n_held: int, since: int, limits: Limits) -> tuple[int, str | None]:
    """The last record of the flush that record `at` belongs to, and what ends it; null where all records from `at` on
    go in without reaching a limit. ends: the records' cumulated sizes; times: in microseconds; held, n_held: bytes and
    records that the buffer holds before `at`; since: when it was last flushed. Lists are quicker where they are short."""
    before = int(ends[at - 1]) if at else 0
    full = before + limits.flush_bytes - held
    by_size = bisect_left(ends, full) if isinstance(ends, list) else int(np.searchsorted(ends, full))
    by_records = at + limits.flush_records - n_held - 1
    most = min(by_size, by_records)
    by_age = _first_from(times, at, min(most, len(ends) - 1), since + limits.flush_secs * MICROSECONDS)
    if by_age < min(most, len(ends)):
        return by_age, "age"
    if most >= len(ends):
        return len(ends) - 1, None
    return most, "size" if by_size <= by_records else "records"


def flushes(manifest: DataFrame) -> DataFrame:
    """One row for each flush of an archive's manifest: lane, flush_no, n_records, bytes, flushed_at, flush_trigger,
    which is null for what was left at a lane's end."""
    return manifest.select(*LANE, "flush_no", "n_records", F.col("raw_bytes").alias("bytes"), "flushed_at", "flush_trigger")


def files(manifest: DataFrame) -> DataFrame:
    """One row for each file of an archive's manifest: lane, file_no, opened_at, n_blocks, n_records, bytes (before
    compression) and roll_trigger: what closed it before its lane's next flush, or `end`."""
    return manifest.groupBy(*LANE, "file_no").agg(
        F.first("opened_at").alias("opened_at"), F.count("*").alias("n_blocks"), F.sum("n_records").alias("n_records"), F.sum("raw_bytes").alias("bytes"),
        F.first("roll_trigger").alias("roll_trigger"),
    )

