"""How far a running query has read, kept as a table by a listener."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener

from driftvault.operators import metrics
from driftvault.plans.config import Config
from driftvault.sources.stores import Store

_POSITIONS = "query string, batch long, at string, source int, topic string, part string, position long, latest long, n_rows long"


def offsets_of(offset) -> dict[tuple[str, str], int]:
    """A source's offset as (topic, partition) to position: brokers name both; of other sources each whole number in
    their offset is a position of its own."""
    try:  # a report in JSON has JSON offsets as they are, others as text
        found = json.loads(offset) if isinstance(offset, str) else offset
    except ValueError:
        found = None
    if isinstance(found, int):
        found = {"": {"offset": found}}
    out = {}
    for name, value in found.items() if isinstance(found, dict) else ():
        for part, at in value.items() if isinstance(value, dict) else [("", value)]:
            if isinstance(at, int):
                out[name, str(part)] = at
    return out


def positions(progress: dict) -> list[dict]:
    """The rows of one progress report: the position after the batch, and the latest that the source knew of; where it
    tells none, the position itself."""
    out = []
    for k, source in enumerate(progress["sources"]):
        latest = offsets_of(source.get("latestOffset"))
        for (topic, part), at in offsets_of(source.get("endOffset")).items():
            out.append({
                "query": progress["id"], "batch": progress["batchId"], "at": progress["timestamp"], "source": k, "topic": topic, "part": part, "position": at,
                "latest": latest.get((topic, part), at), "n_rows": source.get("numInputRows", 0),
            })
    return out


def _as_dict(progress) -> dict:
    return json.loads(progress.json)


class PositionListener(StreamingQueryListener):
    """Writes the positions of each batch that a query has done as a file of its own; a listener never stops a query."""

    def __init__(self, store: Store):
        self.store, self.failures = store, 0

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        try:
            progress = _as_dict(event.progress)
            rows = positions(progress)
            files, path = self.store.open(), f"{progress['id']}/{progress['batchId']:012d}.json"
            if rows and not files.exists(path):
                out = files.create(path)
                out.write("".join(json.dumps(r) + "\n" for r in rows).encode())
                out.close()
        except Exception:  # noqa: BLE001 - what a report costs is the report
            self.failures += 1


def listen(spark: SparkSession, config: Config) -> PositionListener:
    """Keeps the positions of all this session's queries beside the archive, until removeListener takes it away."""
    listener = PositionListener(config.store().below("_meta/positions"))
    spark.streams.addListener(listener)
    return listener


def positions_table(spark: SparkSession, config: Config) -> DataFrame:
    """All positions that were kept."""
    options = config.hadoop_options() | {"recursiveFileLookup": "true"}
    if not config.store().open().exists("_meta/positions"):
        return spark.createDataFrame([], _POSITIONS)
    return spark.read.options(**options).schema(_POSITIONS).json(config.tables("_meta/positions"))


def current_lag(spark: SparkSession, config: Config) -> DataFrame:
    """Each topic's lag after the last batch that was reported of each query, as metrics.lag sums it."""
    rows = positions_table(spark, config)
    last = rows.groupBy("query", "source", "topic", "part").agg(F.max_by(F.struct("position", "latest"), "batch").alias("p"))
    return metrics.lag(last.select("topic", "part", "p.position", "p.latest"))
