"""The folder that driver and executors share, and what is staged in it."""

from __future__ import annotations

import tempfile
import threading
import uuid

from pyspark.sql import SparkSession

_LOCAL: dict[str, str] = {}


class _Staged(threading.local):
    """The folders that this thread was given and has not deleted yet, in order."""

    def __init__(self):
        self.paths: list[str] = []


_staged = _Staged()


def shared_root(spark: SparkSession) -> str:
    """spark.checkpoint.dir; where that is unset, a temporary folder in local mode, and below the warehouse on a
    cluster, if that is not on one machine's own disk. The session's settings stay as they are."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    context = spark.sparkContext
    if context.master.startswith("local") and not context.master.startswith("local-cluster"):
        if context.applicationId not in _LOCAL:
            _LOCAL[context.applicationId] = "file://" + tempfile.mkdtemp(prefix="driftvault-")
        return _LOCAL[context.applicationId]
    warehouse = spark.conf.get("spark.sql.warehouse.dir")
    if "://" not in warehouse or warehouse.startswith("file:"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return f"{warehouse.rstrip('/')}/_driftvault"


def shared_folder(spark: SparkSession, label: str) -> str:
    """The path of a fresh folder in the shared one, which no other call gets."""
    path = f"{shared_root(spark)}/driftvault/{label}-{uuid.uuid4().hex}"
    _staged.paths.append(path)
    return path


def latest() -> str:
    """The folder that was handed out last."""
    return _staged.paths[-1]


def mark() -> int:
    """How many folders this thread holds: what it is given later can be released as far as here."""
    return len(_staged.paths)


def release(spark: SparkSession, since: int = 0, keep: tuple[str, ...] = ()) -> int:
    """Deletes the folders handed out after a mark, but for those in `keep`, and returns how many: call it when the
    results that came of them are written."""
    hadoop, jvm, gone = spark.sparkContext._jsc.hadoopConfiguration(), spark.sparkContext._jvm, 0
    for path in _staged.paths[since:]:
        if path not in keep:
            at = jvm.org.apache.hadoop.fs.Path(path)
            gone += at.getFileSystem(hadoop).delete(at, True)
    _staged.paths[since:] = [p for p in _staged.paths[since:] if p in keep]
    return gone
