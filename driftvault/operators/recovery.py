"""What file keys tell."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from driftvault.functions.segments import segment_value


def parse_key(key: Column, n_fields: int, keyed_by_topic: bool = True) -> dict[str, Column]:
    """What a file key tells: topic, the routing fields' values, seq and token."""
    parts, n = F.split(key, "/"), int(keyed_by_topic)
    name = F.element_at(parts, -1)
    return {
        **({"topic": segment_value(parts[0])} if keyed_by_topic else {}),
        **{f"field_{i}": segment_value(F.get(parts, F.lit(n + i))) for i in range(n_fields)},
        "seq": F.regexp_extract(name, r"-(\d{4,})-[0-9a-f]{16}\.", 1).cast("int"),
        "token": F.regexp_extract(name, r"-([0-9a-f]{16})\.", 1),
    }
