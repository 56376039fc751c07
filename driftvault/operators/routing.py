"""From record to destination."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftvault.functions.json_fields import field_text, is_blank, is_too_deep, strict_json
from driftvault.functions.segments import path_segment

#: The fields that name a destination on each transport where none are given.
DEFAULT_FIELDS = {"kafka": ("_org_id",), "grpc": ("_source", "_org_id")}


def topic_destination(topic: Column, default_segment: str = "default") -> Column:
    return F.when(F.coalesce(topic, F.lit("")) == "", default_segment).otherwise(path_segment(topic))


def route_by_topic(records: DataFrame, default_segment: str = "default") -> DataFrame:
    """records with destination; payloads are not looked at."""
    return records.withColumns({
        "destination": topic_destination(F.col("topic"), default_segment), "fallback_fields": F.array().cast("array<int>"),
        "routing_error": F.lit(False), "too_deep": F.lit(False),
    })


def route_by_fields(records: DataFrame, fields: tuple[str, ...] = ("_org_id",), default_segment: str = "default") -> DataFrame:
    """records (topic, value) with destination, fallback_fields, routing_error and too_deep.

    destination is the topic's segment, where there is a topic, and one for each field; a field that is missing,
    blank, null or no scalar is the default segment, and its index is in fallback_fields. A payload that is not JSON
    is an error and goes by its topic; one that nests too deeply is not parsed and has no destination. Null payloads
    are not JSON. Each payload is parsed twice, whatever the number of fields and whatever is filtered afterwards: within
    an array and within an object.
    """
    text = F.coalesce(F.col("value").cast("string"), F.lit(""))
    df = records.withColumn("too_deep", is_too_deep(text))
    df = df.withColumn("_json", F.when(~F.col("too_deep"), strict_json(text)))
    found = F.array(*[field_text(F.col("_json"), f) for f in fields])
    df = df.withColumn("_found", F.transform(found, lambda v: F.when(~is_blank(v), v)))
    parts = F.transform(F.col("_found"), lambda v: F.coalesce(path_segment(v), F.lit(default_segment)))
    topic = F.coalesce(F.col("topic"), F.lit(""))
    path = F.array_join(F.when(topic == "", parts).otherwise(F.concat(F.array(path_segment(topic)), parts)), "/")
    missing = F.filter(F.transform(F.col("_found"), lambda v, i: F.when(v.isNull(), i)), lambda i: i.isNotNull())
    parsed = F.col("_json").isNotNull()
    return _bound(df, {
        "destination": F.when(F.col("too_deep"), F.lit(None).cast("string")).when(parsed, path).otherwise(topic_destination(topic, default_segment)),
        "fallback_fields": F.when(parsed, missing).otherwise(F.array().cast("array<int>")),
        "routing_error": ~F.col("too_deep") & ~parsed, "too_deep": F.col("too_deep"),
    }).drop("_json", "_found")


def _bound(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """df with columns that are worked out once a row. As fields of a generator's only element no filter on them can be
    pushed below it, where the optimizer would put the whole expression in the place of each mention of a column."""
    one = F.explode(F.array(F.struct(*[c.alias(n) for n, c in columns.items()])))
    return df.withColumn("_bound", one).withColumns({n: F.col("_bound")[n] for n in columns}).drop("_bound")


def route(records: DataFrame, mode: str = "expression", fields: tuple[str, ...] | None = None, default_segment: str = "default", transport: str = "kafka") -> DataFrame:
    """Routing as a configuration asks for it; a mode that is not `expression` is by topic."""
    if mode != "expression":
        return route_by_topic(records, default_segment)
    return route_by_fields(records, tuple(fields or DEFAULT_FIELDS[transport]), default_segment)
