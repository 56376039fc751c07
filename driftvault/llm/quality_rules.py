"""Quality rules: a table of thresholds compiled into one projection of built-in functions."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftvault.llm.common import NOT_SPACE, column, fresh

#: Words of a window, and what share of a text's words may lie in windows found twice or more (percent).
WINDOW = 8
MAX_REPEAT_PERCENT = 30
MIN_WORDS = 20
SYMBOLS = "#*$%&|<>"
#: The languages that STOP_WORDS covers: texts that are said to be in another one are not judged by it.
COVERED = ("en", "de", "fr", "es")
#: Frequent function words of those languages.
STOP_WORDS = (
    "the and of to in is that it as for was with by on be are at this an or from not have "
    "der die das und in zu den von mit ist des sich auf ein eine im dem nicht auch "
    "le la les de des et un une du en que qui dans pour est par sur au pas "
    "el los las del y que en un una por con para se su al lo como es"
).split()


class Rule(NamedTuple):
    """A text stays while low <= metric <= high."""

    metric: str
    low: float
    high: float


#: The ratios are per word or per line with a word; a text breaks the table if one rule doesn't hold.
RULES = (
    Rule("n_words", MIN_WORDS, float("inf")),
    Rule("mean_word_chars", 1.5, 20.0),
    Rule("symbols_per_word", 0.0, 0.25),
    Rule("stop_word_share", 0.02, 1.0),
    Rule("upper_word_share", 0.0, 0.5),
    Rule("dup_line_share", 0.0, 0.4),
)


def _bound(value: Column, use) -> Column:
    """use(value), with value computed once for each row however often `use` names it."""
    return F.transform(F.array(value), use)[0]


def split_words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(f"{NOT_SPACE}+"), F.lit(0))


def repeated_words(words: Column, window: int = WINDOW) -> Column:
    """How many words lie in windows that the text holds twice or more. Windows are told apart by 64-bit hashes
    of their words' hashes; windows of equal hash are sorted next to each other, so the work is n log n for any text."""
    starts = F.when(F.size(words) >= window, F.sequence(F.lit(0), F.size(words) - window)).otherwise(F.array().cast("array<int>"))
    hashes = _bound(
        F.transform(words, lambda w: F.xxhash64(w)),
        lambda ws: F.transform(starts, lambda i: F.xxhash64(*[F.get(ws, i + k) for k in range(window)])),
    )

    def covered(rows: Column) -> Column:
        """rows: (hash, start), sorted."""
        twice = F.filter(
            rows,
            lambda x, i: ((i > 0) & (F.get(rows, i - 1)["h"] == x["h"])) | ((i < F.size(rows) - 1) & (F.get(rows, i + 1)["h"] == x["h"])),
        )
        at = F.sort_array(F.transform(twice, lambda x: x["i"]))
        return _bound(at, lambda s: F.aggregate(s, F.struct(F.lit(0).alias("end"), F.lit(0).alias("n")), _cover(window), lambda acc: acc["n"]))

    def count(hs: Column) -> Column:
        pairs = F.sort_array(F.transform(hs, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(hs)) == F.size(hs), F.lit(0)).otherwise(_bound(pairs, covered))

    return _bound(hashes, count).cast("long")


def _cover(window: int):
    def step(acc: Column, start: Column) -> Column:
        end = start + window
        return F.struct(end.alias("end"), (acc["n"] + end - F.greatest(acc["end"], start)).alias("n"))

    return step


def measures(docs: DataFrame, name: str) -> DataFrame:
    """docs with a struct column `name` of every measure that a rule can name. Null texts count as empty. The share of
    stop words is 1 where docs has a column lang and it names a language that the list does not cover."""
    body, own = F.coalesce("text", F.lit("")), [column(c) for c in docs.columns]
    lines = F.filter(F.split(body, "\n"), lambda x: x.rlike(NOT_SPACE))
    words_name, lines_name, raw = fresh(docs.withColumn(name, F.lit(0)), "_words", "_lines", "_raw")
    df = docs.select(*own, split_words(body).alias(words_name), lines.alias(lines_name))

    def share(part: Column, whole: Column) -> Column:
        return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))

    words, lines = F.col(words_name), F.col(lines_name)
    covered = F.coalesce(F.col("lang").isin(*COVERED), F.lit(True)) if "lang" in docs.columns else F.lit(True)
    df = df.select(
        *own,
        F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.char_length(F.array_join(words, "")).cast("long").alias("word_chars"),
            F.char_length(F.regexp_replace(body, f"[^{SYMBOLS}]++", "")).cast("long").alias("n_symbols"),
            (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
            repeated_words(words).alias("n_repeat_words"),
            F.size(lines).cast("long").alias("n_lines"),
            F.size(F.filter(words, lambda w: w.rlike("^[^a-z]*[A-Z][^a-z]*$") & (F.char_length(w) > 1))).cast("long").alias("n_upper_words"),
            F.size(F.filter(F.transform(words, lambda w: F.lower(F.rtrim(w, F.lit(".,;:!?")))), lambda w: w.isin(list(dict.fromkeys(STOP_WORDS))))).cast("long").alias("n_stop_words"),
            covered.alias("covered"),
        ).alias(raw),
    )
    m = F.col(raw)
    return df.select(
        *own,
        F.struct(
            *[m[k].alias(k) for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
            share(m["word_chars"], m["n_words"]).alias("mean_word_chars"),
            share(m["n_symbols"], m["n_words"]).alias("symbols_per_word"),
            F.when(m["covered"], share(m["n_stop_words"], m["n_words"])).otherwise(1.0).alias("stop_word_share"),
            share(m["n_upper_words"], m["n_words"]).alias("upper_word_share"),
            share(m["n_dup_lines"], m["n_lines"]).alias("dup_line_share"),
        ).alias(name),
    )


def base_failed(m: Column) -> Column:
    return (m["n_words"] < MIN_WORDS) | (100 * m["n_repeat_words"] > MAX_REPEAT_PERCENT * m["n_words"])


def verdict(m: Column, rules=RULES) -> Column:
    """The table as one expression."""
    out = F.lit(True)
    for rule in rules:
        out = out & m[rule.metric].between(rule.low, rule.high)
    return out


def score_quality(docs: DataFrame, rules=RULES) -> DataFrame:
    """One row per row of docs: doc_id, the measures, base_failed and kept.

    Null and empty texts have no words and fail; repeated rows are scored each for itself; an empty table gives
    an empty result; of docs' other columns only lang is looked at. No shuffle: one projection over the scan.
    """
    m = F.col("_m")
    base = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return measures(docs.select("doc_id", "text", *(["lang"] if "lang" in docs.columns else [])), "_m").select(
        "doc_id", *[m[k].alias(k) for k in base], base_failed(m).alias("base_failed"), (~base_failed(m) & verdict(m, rules)).alias("kept")
    )


def keep_quality(docs: DataFrame, rules=RULES) -> DataFrame:
    """The rows of docs that pass, with docs' own columns, whatever their names; the cases are score_quality's."""
    (name,) = fresh(docs, "_m")
    m = F.col(name)
    return measures(docs, name).filter(~base_failed(m) & verdict(m, rules)).select(*[column(c) for c in docs.columns])
