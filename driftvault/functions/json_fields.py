"""Fields of JSON payloads as text, and how deeply payloads nest."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MAX_DEPTH = 64


def strict_json(value: Column) -> Column:
    """The variant of a payload that is one JSON value and nothing else; null otherwise, also for the empty string.

    The parser stops after the first value and ignores what follows, so a payload must parse both inside an array
    and inside an object: nothing but one whole value closes neither."""
    inside = F.try_parse_json(F.concat(F.lit('{"v":'), value, F.lit("}")))
    return F.when(F.try_parse_json(F.concat(F.lit("["), value, F.lit("]"))).isNotNull(), inside)


def plain_number(value: Column) -> Column:
    """A double in decimal digits without an exponent and without needless zeros; from 1e38 and below 1e-18 as it is."""
    text = value.cast("string")
    digits = F.when(F.abs(value) >= 1e20, text.try_cast("decimal(38,0)").cast("string")).otherwise(text.try_cast("decimal(38,18)").cast("string"))
    long = F.when((F.abs(value) >= 1e-18) | (value == 0), digits)
    return F.regexp_replace(F.coalesce(F.when(text.contains("E"), long), text), r"\.0*\z|(\.\d*[1-9])0+\z", "$1")


def field_text(parsed: Column, path: str) -> Column:
    """The scalar at a dotted path of strict_json's result, as text; null for objects, arrays, null and what is
    absent. Every part of the path is a key of an object. Numbers with a fraction or an exponent are doubles."""
    at = '$["v"]' + "".join(f'["{part}"]' for part in path.split("."))
    kind = F.schema_of_variant(F.try_variant_get(parsed, at, "variant"))
    text = F.try_variant_get(parsed, at, "string")
    # whole numbers of up to 20 digits are integers, as far as the text has neither point nor exponent
    number = kind.rlike("^(DOUBLE|FLOAT|DECIMAL)") & ~text.rlike(r"^-?\d{1,20}\z")
    return F.when(~kind.rlike("^(OBJECT|ARRAY|VOID)"), F.when(number, plain_number(F.try_variant_get(parsed, at, "double"))).otherwise(text))


def is_blank(value: Column) -> Column:
    """Whether a string is empty but for white space, in Unicode's sense."""
    return value.rlike(r"^\p{IsWhite_Space}*$")


def _brackets(value: Column) -> Column:
    """A payload's brackets outside strings, in order. A string without an end runs to the payload's end."""
    outside = F.regexp_replace(value, r'"(?:[^"\\]|\\.)*+(?:"|\\?$)', "")
    return F.regexp_replace(outside, r"[^\[\]{}]++", "")


def json_depth(value: Column) -> Column:
    """The deepest nesting of objects and arrays."""
    start = F.struct(F.lit(0).alias("now"), F.lit(0).alias("most"))

    def step(acc: Column, bracket: Column) -> Column:
        now = F.when(bracket.isin("[", "{"), acc["now"] + 1).otherwise(F.greatest(acc["now"] - 1, F.lit(0)))
        return F.struct(now.alias("now"), F.greatest(acc["most"], now).alias("most"))

    return F.aggregate(F.regexp_extract_all(_brackets(value), F.lit("."), F.lit(0)), start, step, lambda acc: acc["most"])


def is_too_deep(value: Column, limit: int = MAX_DEPTH) -> Column:
    """Whether a payload nests deeper than limit; payloads with no more opening brackets are not looked into."""
    opening = F.octet_length(value) - F.octet_length(F.translate(value, "[{", ""))
    return F.coalesce(F.when(opening <= limit, F.lit(False)).otherwise(json_depth(value) > limit), F.lit(False))
