"""Records held over micro-batches, so that a quiet destination makes a file a roll interval, not one a batch.

Each destination and source partition keeps its records in the query's state until its roll interval has gone by since
the first of them, or they are many bytes. State is part of the checkpoint: what is held when a query stops is there
when it starts again, and offsets are never ahead of it.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from driftvault.operators.batching import LANE_OFFSETS
from driftvault.operators.routing import route
from driftvault.plans.config import Config

_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_RECORDS = "topic string, part int, off long, ts timestamp, value binary"
_NAMES = [c.split()[0] for c in _RECORDS.split(", ")]
_ARROW = pa.schema([("topic", pa.string()), ("part", pa.int32()), ("off", pa.int64()), ("ts", pa.timestamp("us")), ("value", pa.binary())])
#: Records that are kept as one value of the state.
BLOCK_RECORDS = 5_000


def _packed(rows: list[tuple]) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, _ARROW, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _ARROW)], schema=_ARROW))
    return sink.getvalue().to_pybytes()


class Holder(StatefulProcessor):
    """Keeps a key's records, in blocks, until its timer goes off or they reach most_bytes."""

    def __init__(self, roll_secs: int, most_bytes: int):
        self.roll_millis, self.most_bytes = roll_secs * 1000, most_bytes

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.blocks = handle.getListState("blocks", "block binary")
        self.held = handle.getValueState("held", "bytes long")

    def handleInputRows(self, key, rows, timerValues):
        held, new = (self.held.get()[0] if self.held.exists() else None), []
        for row in rows:
            if held is None:
                self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.roll_millis)
                held = 0
            new.append(tuple(row[c] for c in _NAMES))
            held += len(row["value"] or b"") + 1
            if held >= self.most_bytes:
                self._keep(new)
                new, held = [], None
                yield from self._all()
            elif len(new) >= BLOCK_RECORDS:
                self._keep(new)
                new = []
        self._keep(new)
        if held is not None:
            self.held.update((held,))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        yield from self._all()

    def _keep(self, rows: list[tuple]) -> None:
        if rows:
            self.blocks.appendValue((_packed(rows),))

    def _all(self):
        for (block,) in self.blocks.get() if self.blocks.exists() else ():
            for row in pa.ipc.open_stream(block).read_all().to_pylist():
                yield Row(**row)
        self.blocks.clear()
        self.held.clear()
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)

    def close(self) -> None:
        pass


def hold(records: DataFrame, config: Config) -> DataFrame:
    """The stream of records, each when its destination's turn has come. A destination's offsets are held by ranges of
    lane_offsets, as its files are cut by them, so a hot one is many keys. Nulls stay nulls and are keys of their own.

    Needs Spark's RocksDB state store; which one a query has is fixed by its first start.
    """
    if records.sparkSession.conf.get("spark.sql.streaming.stateStore.providerClass") != _PROVIDER:
        raise ValueError(f"set spark.sql.streaming.stateStore.providerClass to {_PROVIDER}: records are held in state with timers")
    routed = route(records, config.routing.mode, config.effective_fields(), config.routing.default_segment, config.transport)
    keyed = routed.select("destination", F.col("part").alias("of_part"), F.floor(F.col("off") / LANE_OFFSETS).alias("of_offsets"), *[F.col(n).cast(t).alias(n) for n, t in (c.split() for c in _RECORDS.split(", "))])
    holder = Holder(config.roll_interval_secs(), config.buffer.hold_bytes)
    return keyed.groupBy("destination", "of_part", "of_offsets").transformWithState(holder, _RECORDS, "Append", "ProcessingTime")
