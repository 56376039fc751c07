"""How filters interact: what each removes in every order that they can be applied in, in DataFrame functions only.

Each document has a mask of the filters that it fails. All that the orders' reports need are the counts of the masks, of
which there are 32 for five filters: the corpus is read once, and the 120 orders are worked out from the counts.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftvault.llm.common import SPACE, join_weighted, stage

_FIRST = -(2**63)
_TEXT = ["h1", "h2"]

#: Failure conditions by name, of a text and its words.
CONDITIONS: dict[str, Callable[[Column, Column], Column]] = {
    "A": lambda body, words: F.size(words) < 100,
    "B": lambda body, words: 100 * F.size(F.array_distinct(words)) < 80 * F.size(words),
    "C": lambda body, words: 100 * F.length(F.regexp_replace(body, "[^A-Z]++", "")) > 10 * F.char_length(body),
    "D": lambda body, words: body.rlike(r"[#$%&*|]"),
}
#: The name of the condition that a document with a smaller doc_id has the same text.
DUPLICATE = "E"


def _mask(bits: list[Column]) -> Column:
    return sum((F.when(b, 1 << i).otherwise(0) for i, b in enumerate(bits)), F.lit(0)).cast("int")


def failure_masks(docs: DataFrame, part: str = "lang", conditions: dict[str, Callable] = CONDITIONS) -> DataFrame:
    """doc_id, part and mask of each row of docs: bit i is set where it fails the i-th condition, the bit after those
    where a smaller doc_id has the same text.

    Null texts are empty, a null part is the empty string. A null doc_id counts as the smallest; rows that repeat a
    doc_id and its text are no copies of each other. Texts are told apart by 128 bits of hash. Whole texts are read,
    however long; other columns are not looked at, and an empty table gives an empty result.

    Only hashes and masks are shuffled: a text's smallest doc_id is combined before the shuffle, and a text that a
    third of all rows hold is joined without an exchange.
    """
    rows = docs.select("doc_id", F.coalesce(part, F.lit("")).alias("part"), F.coalesce("text", F.lit("")).alias("body"))
    rows = rows.withColumn("words", F.array_remove(F.split("body", f"{SPACE}+"), ""))
    rows = stage(
        rows.select(
            "doc_id", "part", F.coalesce("doc_id", F.lit(_FIRST)).alias("doc"), F.xxhash64("body").alias("h1"), F.xxhash64(F.lit(7), "body").alias("h2"),
            _mask([c(F.col("body"), F.col("words")) for c in conditions.values()]).alias("own"),
        ),
        "filter-masks",
    )
    firsts = rows.groupBy(*_TEXT).agg(F.min("doc").alias("first_doc"), F.count("*").alias("n")).filter("n > 1")
    joined = join_weighted(rows, stage(firsts, "repeated-texts"), _TEXT, "n", rows.count(), "left")
    copy = F.coalesce(F.col("doc") > F.col("first_doc"), F.lit(False))
    return joined.select("doc_id", "part", (F.col("own") + F.when(copy, 1 << len(conditions)).otherwise(0)).alias("mask"))


def mask_histogram(masks: DataFrame, labels: DataFrame) -> DataFrame:
    """part, mask, n, good, toxic: documents of each mask, and how many of them the labels call good and toxic.

    Of several labels of one doc_id one that says so is enough; labels of no document and null labels count nowhere.
    Rows that repeat a doc_id are counted before they meet its labels, so that none is a hot key.
    """
    said = labels.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"), F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic")
    )
    rows = masks.groupBy("doc_id", "part", "mask").agg(F.count("*").alias("n")).join(said.filter("good OR toxic"), "doc_id", "left")
    return rows.groupBy("part", "mask").agg(F.sum("n").alias("n"), *[F.sum(F.when(F.col(c), F.col("n")).otherwise(0)).alias(c) for c in ("good", "toxic")])


def _orders(names: list[str]) -> Column:
    """For each order of the names an array of its steps: struct(filter_order, step, bit, before), where before has the
    bits of the filters applied earlier."""
    bits = F.array(*[F.lit(1 << i) for i in range(len(names))])
    known = F.array(*map(F.lit, names))

    def bit(name: Column) -> Column:
        return F.element_at(bits, F.array_position(known, name).cast("int"))

    def steps(order: Column) -> Column:
        def step(name: Column, i: Column) -> Column:
            before = F.aggregate(F.slice(order, 1, i), F.lit(0), lambda acc, x: acc + bit(x))
            return F.struct(F.array_join(order, "").alias("filter_order"), (i + 1).alias("step"), bit(name).alias("bit"), before.alias("before"))

        return F.transform(order, step)

    return F.flatten(F.transform(F.array(*[F.array(*map(F.lit, p)) for p in permutations(names)]), steps))


def interactions(histogram: DataFrame, names: list[str]) -> DataFrame:
    """Every order's report from a mask histogram, a row for each part, order and step: kept, removed, redundant,
    unique_fails, good_lost, toxic_lost, shapley. A part's row has at most 2^filters counts."""
    parts = histogram.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells"))
    rows = parts.select("part", "cells", F.explode(_orders(names)).alias("s")).select("part", "cells", "s.*")
    bit, before, zero = F.col("bit"), F.col("before"), F.lit(0).cast("long")

    def total(of: Callable[[Column], Column], where: Callable[[Column], Column]) -> Column:
        return F.aggregate("cells", zero, lambda acc, c: acc + F.when(where(c["mask"]), of(c)).otherwise(zero))

    def fails(m: Column) -> Column:
        return m.bitwiseAND(bit) != 0

    def here(m: Column) -> Column:
        return fails(m) & (m.bitwiseAND(before) == 0)

    # of the orders of a document's k failed filters each one comes first in the same number
    share = lambda c: c["n"] * (F.lit(factorial(len(names))) / F.bit_count(c["mask"])).cast("long")
    return rows.select(
        "part", "filter_order", F.col("step").cast("int").alias("step"),
        total(lambda c: c["n"], lambda m: m.bitwiseAND(bit + before) == 0).alias("kept"), total(lambda c: c["n"], here).alias("removed"),
        total(lambda c: c["n"], lambda m: fails(m) & ~here(m)).alias("redundant"), total(lambda c: c["n"], lambda m: m == bit).alias("unique_fails"),
        total(lambda c: c["good"], here).alias("good_lost"), total(lambda c: c["toxic"], here).alias("toxic_lost"), total(share, fails).alias("shapley"),
    )


def audit_filters(docs: DataFrame, labels: DataFrame, part: str = "lang", conditions: dict[str, Callable] = CONDITIONS) -> DataFrame:
    """The report of all orders of the conditions and of the one on copies, for each part of docs. Names are single
    letters. What nulls, repeated rows and empty tables give is said at failure_masks and mask_histogram."""
    return interactions(mask_histogram(failure_masks(docs, part, conditions), labels), [*conditions, DUPLICATE])
