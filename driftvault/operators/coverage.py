"""Which offsets of each source partition came to which end, as ranges without holes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftvault.operators import archive
from driftvault.operators.batching import LANE_OFFSETS

#: Offsets that are put in order by one task; ranges are stitched over these afterwards.
SPAN = 1 << 16
#: Where a record of each status is.
ENDS = {"rejected": "dead letters", "filtered": "filtered", "dropped": "dropped"}


def record_ends(ledger: DataFrame, manifest: DataFrame, files: DataFrame, lane_offsets: int = LANE_OFFSETS) -> DataFrame:
    """The records of an outcomes ledger with `end`: `archive` where the file that the manifest has them in is there and
    long enough (files: path, n_bytes, as Store.list gives them), `lost` where it is not, else by status. A delivered
    record is found in the manifest by its place in its lane."""
    rows = archive.in_lane(archive.lane_rows(ledger.filter("status = 'delivered'"), lane_offsets))
    whole = files.withColumnRenamed("path", "_path")
    blocks = manifest.filter("path IS NOT NULL").join(whole, F.col("path") == F.col("_path"), "left")
    held = blocks.select(
        *archive.LANE, "split", F.coalesce(F.col("n_bytes") >= F.col("start") + F.col("length"), F.lit(False)).alias("_is_held"),
        F.explode(F.sequence(F.col("first_pos"), F.col("first_pos") + F.col("n_records") - 1)).alias("at"),
    )
    found = archive.in_lanes(rows, held, "left", F.col("_pos") == F.col("at"))
    delivered = found.select("topic", "part", "off", F.when(F.coalesce("_is_held", F.lit(False)), "archive").otherwise("lost").alias("end"))
    end = F.coalesce(*[F.when(F.col("status") == s, e) for s, e in ENDS.items()], F.col("status"))
    return delivered.unionByName(ledger.filter("status <> 'delivered'").select("topic", "part", F.col("off").cast("long").alias("off"), end.alias("end")))


def offset_ranges(ends: DataFrame, keys: tuple[str, ...] = ("topic", "part"), span: int = SPAN) -> DataFrame:
    """Ranges of offsets of one end each, a row for each: keys, first_off, last_off, end, n_records.

    An offset that more than one record has is `twice`, whatever their ends; between the first and the last offset of a
    partition those that no record has are `missing`. Null offsets are no offsets and are left out. Ranges are found
    within spans of offsets, which tasks share, and then only those at a span's edges are stitched, so no partition is
    one task's.
    """
    keys, off = list(keys), F.col("off")
    each = ends.filter("off IS NOT NULL").groupBy(*keys, "off").agg(F.count("*").alias("n"), F.min("end").alias("end"))
    each = each.withColumns({"end": F.when(F.col("n") > 1, "twice").otherwise(F.col("end")), "_span": F.floor(off / span)})
    by = Window.partitionBy(*keys, "_span").orderBy("off")
    before = F.lag("off").over(by)
    begins = before.isNull() | (before < off - 1) | ~F.lag("end").over(by).eqNullSafe(F.col("end"))
    each = each.withColumns({"_before": before, "_begins": begins})
    each = each.withColumn("_number", F.count_if("_begins").over(by))
    inside = each.groupBy(*keys, "_span", "_number").agg(F.min("off").alias("first_off"), F.max("off").alias("last_off"), F.first("end").alias("end"), F.sum("n").alias("n_records"))
    at_edge = (F.col("first_off") == F.col("_span") * span) | (F.col("last_off") == (F.col("_span") + 1) * span - 1)
    order = Window.partitionBy(*keys).orderBy("first_off")
    edges = inside.filter(at_edge)
    goes_on = (F.lag("last_off").over(order) == F.col("first_off") - 1) & F.lag("end").over(order).eqNullSafe(F.col("end"))
    edges = edges.withColumn("_new", ~F.coalesce(goes_on, F.lit(False))).withColumn("_chain", F.count_if("_new").over(order))
    stitched = edges.groupBy(*keys, "_chain").agg(F.min("first_off").alias("first_off"), F.max("last_off").alias("last_off"), F.first("end").alias("end"), F.sum("n_records").alias("n_records"))

    def missing(rows: DataFrame, first: Column, last: Column) -> DataFrame:
        return rows.select(*keys, first.alias("first_off"), last.alias("last_off"), F.lit("missing").alias("end"), F.lit(0).cast("long").alias("n_records"))

    spans = each.groupBy(*keys, "_span").agg(F.min("off").alias("lo"), F.max("off").alias("hi")).withColumn("_before", F.lag("hi").over(Window.partitionBy(*keys).orderBy("_span")))
    columns = [*keys, "first_off", "last_off", "end", "n_records"]
    out = inside.filter(~at_edge).select(*columns).unionByName(stitched.select(*columns))
    out = out.unionByName(missing(each.filter(F.col("_before") < off - 1), F.col("_before") + 1, off - 1))
    return out.unionByName(missing(spans.filter(F.col("_before") < F.col("lo") - 1), F.col("_before") + 1, F.col("lo") - 1))


def commit_floor(ranges: DataFrame, keys: tuple[str, ...] = ("topic", "part")) -> DataFrame:
    """How far each source partition may be committed: to the first offset that is lost or missing, or one past its last."""
    open_ = F.col("end").isin("lost", "missing", "errored")
    held = F.min(F.when(open_, F.col("first_off")))
    return ranges.groupBy(*keys).agg(F.coalesce(held, F.max("last_off") + 1).alias("commit_to"), F.coalesce(F.sum(F.when(open_, F.col("last_off") - F.col("first_off") + 1)), F.lit(0)).cast("long").alias("n_withheld"))
