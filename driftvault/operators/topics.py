"""Which topics are read."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Patterns of topics that belong to brokers and tools, never to producers.
INTERNAL_TOPICS = (r"^__.*", r"^strimzi.*", r"^_?confluent.*", r"^redpanda.*", r"^_?schemas?.*", r"^_?connect-.*", r".*_dlq$")


def select_topics(df: DataFrame, include: tuple[str, ...] = (), exclude: tuple[str, ...] = INTERNAL_TOPICS, topic: str = "topic") -> DataFrame:
    """Rows whose topic matches one of `include` (any, where there is none) and none of `exclude`."""
    if include:
        df = df.filter(F.col(topic).rlike("|".join(f"(?:{p})" for p in include)))
    return df.filter(~F.col(topic).rlike("|".join(f"(?:{p})" for p in exclude))) if exclude else df


def prefer_landing(df: DataFrame, topic: str = "topic", known: DataFrame | None = None) -> DataFrame:
    """df without each `<name>_load` whose `<name>_land` is there too, or is among topics known from before."""
    seen = df.select(topic) if known is None else df.select(topic).unionByName(known.select(F.col("topic").alias(topic)))
    landed = seen.filter(F.col(topic).endswith("_land")).select(F.regexp_replace(topic, "_land$", "_load").alias(topic)).distinct()
    return df.join(landed, topic, "left_anti")
