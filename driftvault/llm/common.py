"""Helpers that the training-data operators share: tables in the shared folder, joins that survive hot keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from driftvault.sources.shared import shared_folder

#: ASCII white space, as a character class of Java, Python and RE2 patterns.
SPACE = r"[\x20\x09-\x0D]"
NOT_SPACE = r"[^\x20\x09-\x0D]"
#: A key held by more than one in so many rows counts as hot: there are fewer than so many hot keys, whatever the input.
HOT_SHARE = 1000


def stage(df: DataFrame, label: str) -> DataFrame:
    """Writes df to the shared folder as Parquet and returns what was written: lineage ends there, and values
    that depend on the order of a scan (row numbers) stay as they are."""
    path = shared_folder(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def column(name: str) -> Column:
    """The column of exactly this name, whatever characters are in it."""
    return F.col("`" + name.replace("`", "``") + "`")


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names like these that no column of df has."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def n_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def join_weighted(left: DataFrame, right: DataFrame, on: list[str], weight: str, total: int, how: str = "inner") -> DataFrame:
    """left joined with right, which holds each key once, with the number of left's rows of that key in `weight`.

    Keys with more than a thousandth of left's `total` rows are fewer than a thousand: they are broadcast, so
    that a key with a third of all rows goes through no exchange. The rest is an ordinary join of even keys.
    """
    limit = max(total // HOT_SHARE, 1000)
    hot = F.broadcast(right.filter(F.col(weight) > limit))
    cold = right.filter(F.col(weight) <= limit)
    return left.join(hot, on, "inner").unionByName(left.join(hot, on, "left_anti").join(cold, on, how))
