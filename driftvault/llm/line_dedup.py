"""Line deduplication across documents, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftvault.llm.common import SPACE, join_weighted, stage

#: Keys shorter than this are left alone; keys found in fewer documents are not repeated.
MIN_CHARS = 10
_FIRST = -(2**63)
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_KEY = ["h1", "h2"]


def line_key(line: Column) -> Column:
    return F.translate(F.regexp_replace(line, f"^{SPACE}++|{SPACE}++$", ""), _UPPER, _LOWER)


def _lines(body: Column) -> Column:
    return F.split(body, "\n")


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """One row per row of docs: doc_id, n_lines, n_dropped, kept_text.

    Null and empty texts are one empty line. A null doc_id counts as the smallest. Rows that repeat a doc_id are
    one document where documents are counted. Keys are told apart by 128 bits of hash. An empty table gives an
    empty result; other columns are not looked at.

    Only hashes and positions are shuffled for the counts: the key's smallest and largest document tell whether
    two hold it, and both are combined before the shuffle. A line that a third of all documents hold is joined
    without an exchange. The texts move once, to be put together again.
    """
    rows = docs.select(F.coalesce("doc_id", F.lit(_FIRST)).alias("doc"), "doc_id", F.coalesce("text", F.lit("")).alias("body"))
    # two hashes of the text tell rows with one doc_id apart
    rows = rows.withColumn("text_hash", F.xxhash64("body"))
    lines = (
        rows.select("doc", "text_hash", F.posexplode(_lines(F.col("body"))).alias("pos", "line"))
        .withColumn("key", line_key(F.col("line")))
        .filter(F.char_length("key") >= min_chars)
        .select("doc", "text_hash", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(7), "key").alias("h2"))
    )
    lines = stage(lines, "line-hashes")
    counted = lines.groupBy(*_KEY).agg(F.min("doc").alias("first_doc"), F.max("doc").alias("last_doc"), F.count("*").alias("n"))
    repeated = counted.filter(F.col("first_doc") < F.col("last_doc")).select(*_KEY, "first_doc", "n")
    drop = (
        join_weighted(lines, stage(repeated, "repeated-lines"), _KEY, "n", lines.count())
        .filter(F.col("doc") != F.col("first_doc"))
        .groupBy("doc", "text_hash")
        .agg(F.collect_set("pos").alias("drop"))
    )
    found = rows.join(drop, ["doc", "text_hash"], "left")
    all_lines = _lines(F.col("body"))

    def rebuilt(parts: Column) -> Column:
        keep = F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), F.col("drop"))
        return F.array_join(F.transform(keep, lambda i: F.get(parts, i)), "\n")

    return found.select(
        "doc_id",
        (F.octet_length("body") - F.octet_length(F.translate("body", "\n", "")) + 1).cast("long").alias("n_lines"),
        F.when(F.col("drop").isNull(), 0).otherwise(F.size("drop")).cast("long").alias("n_dropped"),
        F.when(F.col("drop").isNull(), F.col("body")).otherwise(F.transform(F.array(all_lines), rebuilt)[0]).alias("kept_text"),
    )
