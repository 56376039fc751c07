"""Path segments: any string as one safe path segment, and back."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_PLAIN = r"^[A-Za-z0-9._-]+\z"


def path_segment(value: Column) -> Column:
    """value as one path segment, injective: bytes outside [A-Za-z0-9._-] become =XX; the empty string, `.` and
    `..`, which no segment may be, become `=`, `=2E` and `=2E=2E`. Null stays null."""
    octets = F.regexp_extract_all(F.hex(F.encode(value, "UTF-8")), F.lit(".."), F.lit(0))

    def octet(h: Column) -> Column:
        plain = h.between("30", "39") | h.between("41", "5A") | h.between("61", "7A") | h.isin("2D", "2E", "5F")
        return F.when(plain, F.char(F.conv(h, 16, 10).cast("int"))).otherwise(F.concat(F.lit("="), h))

    return (
        F.when(value == "", "=")
        .when(value.isin(".", ".."), F.replace(value, F.lit("."), F.lit("=2E")))
        .when(value.rlike(_PLAIN), value)  # most values need no work on their bytes
        .otherwise(F.array_join(F.transform(octets, octet), ""))
    )


def segment_value(segment: Column) -> Column:
    """The string that path_segment made segment from."""
    parts = F.regexp_extract_all(segment, F.lit("=[0-9A-F]{2}|[^=]"), F.lit(0))
    octets = F.transform(parts, lambda p: F.when(p.startswith("=") & (F.length(p) == 3), F.substring(p, 2, 2)).otherwise(F.hex(F.encode(p, "UTF-8"))))
    return F.when(segment == "=", "").when(~segment.contains("="), segment).otherwise(F.decode(F.unhex(F.array_join(octets, "")), "UTF-8"))


def is_confined(path: Column) -> Column:
    """Whether a relative path stays below its root: not absolute, no `.` or `..` segment."""
    return ~path.rlike(r"(^/)|((^|/)\.{1,2}(/|\z))")


MAX_KEY_BYTES, MAX_NAME_BYTES = 1024, 255


def is_storable(key: Column) -> Column:
    """Whether a store can hold the key: confined, at most 1024 bytes, no segment over 255 bytes. The key is worked out
    once, however much went into it."""

    def fits(k: Column) -> Column:
        longest = F.array_max(F.transform(F.split(k, "/"), lambda s: F.octet_length(s)))
        return is_confined(k) & (F.octet_length(k) <= MAX_KEY_BYTES) & (longest <= MAX_NAME_BYTES)

    return F.transform(F.array(key), fits)[0]
