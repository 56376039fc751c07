"""Path templates and file keys."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from driftvault.functions.codecs import EXTENSION_OF

#: The placeholders of a template, with the pattern of the ones that are parts of the time.
TIME_PARTS = {"{year}": "yyyy", "{month}": "MM", "{day}": "dd", "{hour}": "HH", "{minute}": "mm"}
PLACEHOLDERS = (*TIME_PARTS, "{timestamp}", "{seq}")
#: Folders in Hive's layout, whose parts Spark prunes when it reads.
HIVE = "year={year}/month={month}/day={day}/hour={hour}"


def padded(number: Column, width: int = 4) -> Column:
    """A number in at least `width` digits, never cut."""
    text = number.cast("string")
    return F.when(F.length(text) >= width, text).otherwise(F.lpad(text, width, "0"))


def expand_template(template: str, at: Column, seq: Column | None = None) -> Column:
    """template at a UTC time; `{seq}` stays as it is where no number is given."""
    out = F.lit(template)
    for placeholder, pattern in TIME_PARTS.items():
        if placeholder in template:
            out = F.replace(out, F.lit(placeholder), F.date_format(at, pattern))
    if "{timestamp}" in template:
        out = F.replace(out, F.lit("{timestamp}"), F.unix_timestamp(at).cast("string"))
    return F.replace(out, F.lit("{seq}"), padded(seq)) if seq is not None and "{seq}" in template else out


def expanded(template: str, at: dt.datetime) -> str:
    """template at one UTC time, as expand_template gives it; `{seq}` stays as it is."""
    parts = {"{year}": f"{at.year:04d}", "{month}": f"{at.month:02d}", "{day}": f"{at.day:02d}", "{hour}": f"{at.hour:02d}", "{minute}": f"{at.minute:02d}"}
    for placeholder, value in {**parts, "{timestamp}": str(int(at.timestamp() // 1))}.items():
        template = template.replace(placeholder, value)
    return template


def file_key(destination: Column, template: str, at: Column, seq: Column, token: Column, extension: str = "jsonl", codec: str = "zstd") -> Column:
    """<destination>/<expanded template>-<seq>-<token>.<extension>[.<codec's extension>]"""
    end = f".{extension}" + (f".{EXTENSION_OF[codec]}" if EXTENSION_OF[codec] else "")
    return F.concat(destination, F.lit("/"), expand_template(template, at, seq), F.lit("-"), padded(seq), F.lit("-"), token, F.lit(end))


def unknown_placeholders(template: str) -> list[str]:
    """What stands in braces and is no placeholder, each once, in order."""
    return [x for x in dict.fromkeys(re.findall(r"\{[^{}]*\}", template)) if x not in PLACEHOLDERS]


def unknown_placeholders_column(template: Column) -> Column:
    found = F.regexp_extract_all(template, F.lit(r"\{[^{}]*\}"), F.lit(0))
    return F.array_except(found, F.array(*map(F.lit, PLACEHOLDERS)))
