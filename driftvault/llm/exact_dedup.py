"""Exact deduplication by a tree-merge of sorted digest runs.

Every partition of the input makes a run: its digests in order, each once, with the smallest identifier and the
number of rows. The digest space is cut into segments, and a run's part of a segment is one sorted array of entries.
In each round FAN_IN runs with neighbouring numbers exchange their arrays and are merged into one run (three binomial
rounds at once): two sorted arrays are merged by binary search of one in the other, never sorted again, and entries
that agree become one with the smaller identifier. A digest that a third of all rows carry is one entry in each run
from the start. Entries agree if the SHA-256 digest, the length and a second 64-bit hash do; texts are not compared.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftvault.llm.common import SPACE, column, fresh, join_weighted, n_parts, stage

#: Runs merged into one in a round: a power of two.
FAN_IN = 8
#: Digests that a segment of the digest space may hold, on average: some megabytes.
SEGMENT_ROWS = 50_000
#: An entry: digest, length and second hash as one key that sorts by bytes; whether the identifier is null, the
#: identifier, its row, and the number of rows.
_ENTRY = np.dtype([("key", "S44"), ("no_id", "u1"), ("id", "<i8"), ("row", "<i8"), ("n", "<i8")])
_SIGN = np.uint64(1 << 63)
_RUN = "segment int, run int, entries binary"
_MERGED = "digest binary, n_bytes int, check long, min_id long, min_row long, n long"
_MERGED_ARROW = pa.schema([("digest", pa.binary()), ("n_bytes", pa.int32()), ("check", pa.int64()), ("min_id", pa.int64()), ("min_row", pa.int64()), ("n", pa.int64())])


def normalised(text):
    """Runs of ASCII white space as one space each; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), f"{SPACE}+", " ")


def fold(entries: np.ndarray) -> np.ndarray:
    """Sorted entries with those of equal keys as one: the smallest (identifier, row), null identifiers last, and the
    summed number of rows."""
    if not len(entries):
        return entries
    starts = np.flatnonzero(np.concatenate([[True], entries["key"][1:] != entries["key"][:-1]]))
    if len(starts) == len(entries):
        return entries
    group = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(entries))))
    first = np.lexsort((entries["row"], entries["id"], entries["no_id"], group))[starts]  # groups stay in place
    out = entries[first].copy()
    out["n"] = np.add.reduceat(entries["n"], starts)
    return out


def merge_two(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Two sorted runs as one: where each entry of b goes among those of a is found by binary search."""
    if not len(a) or not len(b):
        return a if len(a) else b
    at = np.searchsorted(a["key"], b["key"], side="right") + np.arange(len(b))
    out, of_a = np.empty(len(a) + len(b), _ENTRY), np.ones(len(a) + len(b), bool)
    of_a[at] = False
    out[at], out[of_a] = b, a
    return fold(out)


def merge_runs(runs: list[np.ndarray]) -> np.ndarray:
    """Sorted runs as one, pair by pair in binomial rounds."""
    while len(runs) > 1:
        runs = [merge_two(*runs[i : i + 2]) if i + 1 < len(runs) else runs[i] for i in range(0, len(runs), 2)]
    return runs[0]


def _make_runs(batches):
    """Rows (segment, run, digest, n_bytes, check, doc_id, row), sorted by segment and key, as one row for each segment."""
    held, segment, run = [], None, None
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = {c: batch.column(c) for c in batch.schema.names}
        entries = np.zeros(batch.num_rows, _ENTRY)
        digest = np.frombuffer(b"".join(cols["digest"].to_pylist()), np.uint8).reshape(-1, 32)
        n_bytes = cols["n_bytes"].to_numpy().astype(">u4").view(np.uint8).reshape(-1, 4)
        check = (cols["check"].to_numpy().view(np.uint64) ^ _SIGN).astype(">u8").view(np.uint8).reshape(-1, 8)  # in the order of signed numbers
        entries["key"] = np.hstack([digest, n_bytes, check]).reshape(-1).view("S44")
        entries["no_id"] = cols["doc_id"].is_null().to_numpy(zero_copy_only=False)
        entries["id"] = cols["doc_id"].fill_null(0).to_numpy()
        entries["row"], entries["n"] = cols["row"].to_numpy(), 1
        of, by = cols["segment"].to_numpy(), cols["run"].to_numpy()
        cuts = [0, *(np.flatnonzero((of[1:] != of[:-1]) | (by[1:] != by[:-1])) + 1).tolist(), len(of)]
        for a, b in zip(cuts, cuts[1:]):
            if (of[a], by[a]) != (segment, run):
                if held:
                    yield _run_row(segment, run, held)
                held, segment, run = [], int(of[a]), int(by[a])
            held.append(fold(entries[a:b]))
    if held:
        yield _run_row(segment, run, held)


def _run_row(segment: int, run: int, parts: list[np.ndarray]) -> pa.RecordBatch:
    whole = fold(np.concatenate(parts))  # parts follow each other in the order of keys
    return pa.RecordBatch.from_arrays([pa.array([segment], pa.int32()), pa.array([run], pa.int32()), pa.array([whole.tobytes()], pa.binary())], names=["segment", "run", "entries"])


def _merge_group(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("run")
    merged = merge_runs([np.frombuffer(x, _ENTRY) for x in rows["entries"]])
    return pd.DataFrame({"segment": [rows["segment"].iloc[0]], "run": [rows["run"].iloc[0] // FAN_IN], "entries": [merged.tobytes()]}).astype({"segment": "int32", "run": "int32"})


def _unpack(batches):
    for batch in batches:
        for blob in batch.column("entries").to_pylist():
            e = np.frombuffer(blob, _ENTRY)
            raw = np.ascontiguousarray(e["key"]).view(np.uint8).reshape(-1, 44)
            digest = np.ascontiguousarray(raw[:, :32]).tobytes()
            n_bytes = np.ascontiguousarray(raw[:, 32:36]).view(">u4").ravel().astype(np.int32)
            check = (np.ascontiguousarray(raw[:, 36:44]).view(">u8").ravel().astype(np.uint64) ^ _SIGN).view(np.int64)
            yield pa.RecordBatch.from_arrays([
                pa.array([digest[i : i + 32] for i in range(0, len(digest), 32)], pa.binary()), pa.array(n_bytes), pa.array(check),
                pa.array(e["id"].copy(), mask=e["no_id"].astype(bool)), pa.array(e["row"].copy()), pa.array(e["n"].copy()),
            ], schema=_MERGED_ARROW)


def digests(docs: DataFrame) -> DataFrame:
    """A row number, the identifier, digest, length and second hash of every row, and the run it belongs to."""
    body = normalised(F.col("text"))
    return docs.select("doc_id", body.alias("body")).select(
        F.monotonically_increasing_id().alias("row"),
        F.spark_partition_id().alias("run"),
        "doc_id",
        F.unhex(F.sha2(F.encode("body", "UTF-8"), 256)).alias("digest"),
        F.octet_length("body").alias("n_bytes"),
        F.xxhash64("body").alias("check"),
    )


def merged(rows: DataFrame, total: int) -> DataFrame:
    """One entry for each digest of `rows`: min_id (null where no row has one), min_row, n."""
    segments = max(n_parts(rows.sparkSession), total // SEGMENT_ROWS)
    key = ["segment", "digest", "n_bytes", "check"]
    runs = rows.select(F.pmod(F.xxhash64("digest"), F.lit(segments)).cast("int").alias("segment"), "run", "digest", "n_bytes", "check", "doc_id", "row")
    n_runs = (rows.agg(F.max("run")).first()[0] or 0) + 1
    # a stored partition of rows holds one run's rows or several runs' one after the other
    runs = runs.sortWithinPartitions("run", *key).mapInArrow(_make_runs, _RUN)
    while True:  # one round even of one run, whose rows may have come in two parts
        runs = runs.groupBy("segment", F.floor(F.col("run") / FAN_IN).alias("_group")).applyInPandas(_merge_group, _RUN)
        n_runs = -(-n_runs // FAN_IN)
        if n_runs <= 1:
            break
    return runs.select("entries").mapInArrow(_unpack, _MERGED)


def _resolved(rows: DataFrame) -> DataFrame:
    total = rows.count()
    groups = stage(merged(rows, total), "exact-groups")
    return join_weighted(rows, groups, ["digest", "n_bytes", "check"], "n", total)


def dedup_exact(docs: DataFrame) -> DataFrame:
    """One row per row of docs: doc_id, keep_id, group_size, kept, text_sha256.

    Null texts are empty texts, and equal to them. A null doc_id counts as larger than any other. Of repeated rows
    with one doc_id exactly one is kept. An empty table gives an empty result; other columns are not looked at.
    """
    rows = stage(digests(docs.select("doc_id", "text")), "exact-digests")
    return _resolved(rows).select(
        "doc_id", F.col("min_id").alias("keep_id"), F.col("n").alias("group_size"), (F.col("row") == F.col("min_row")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256")
    )


def keep_exact(docs: DataFrame) -> DataFrame:
    """The rows of docs that stay, with docs' own columns, whatever their names; the cases are dedup_exact's. docs is
    read a second time and joined with the kept (identifier, digest) pairs, each of which is one row, so no key is
    hot; of rows equal in both, one stays."""
    rows = stage(digests(docs.select("doc_id", "text")), "exact-digests")
    no_id, key, digest = fresh(docs, "_no_id", "_id", "_digest")
    identity = [F.col("doc_id").isNull().alias(no_id), F.coalesce("doc_id", F.lit(0)).cast("long").alias(key)]
    kept = _resolved(rows).filter(F.col("row") == F.col("min_row")).select(*identity, F.col("digest").alias(digest))
    body = F.unhex(F.sha2(F.encode(normalised(F.col("text")), "UTF-8"), 256))
    own = [column(c) for c in docs.columns]
    keyed = docs.select(*own, *identity, body.alias(digest))
    return keyed.join(kept, [no_id, key, digest], "left_semi").dropDuplicates([no_id, key, digest]).select(*own)
