"""A pipeline's metrics as DataFrames over its ledgers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def message_counts(ledger: DataFrame) -> DataFrame:
    """Records by status and reason."""
    return ledger.groupBy("status", F.coalesce("reason", F.lit("")).alias("reason")).agg(F.count("*").alias("n_records"))


def bytes_by_destination(routed: DataFrame) -> DataFrame:
    """Records and archived bytes (payload and line end) of each destination."""
    return routed.filter("destination IS NOT NULL").groupBy("destination").agg(
        F.count("*").alias("n_records"), F.sum(F.octet_length(F.col("value").cast("string")) + 1).alias("bytes")
    )


def fallback_counts(routed: DataFrame) -> DataFrame:
    """How often each routing field fell back to the default segment."""
    return routed.select(F.explode("fallback_fields").alias("field")).groupBy("field").agg(F.count("*").alias("n_records"))


def routing_totals(routed: DataFrame) -> DataFrame:
    return routed.agg(
        F.count("*").alias("n_received"), F.count_if("routing_error").alias("n_routing_errors"), F.count_if("too_deep").alias("n_too_deep"),
        F.count_distinct("destination").alias("n_destinations"),
    )


def lag(positions: DataFrame) -> DataFrame:
    """positions (topic, part, position, latest) summed to each topic's lag; a position past the end is no lag."""
    return positions.groupBy("topic").agg(F.sum(F.greatest(F.col("latest") - F.col("position"), F.lit(0))).alias("lag"))


def records_per_second(records: DataFrame, seconds: int = 3600) -> DataFrame:
    """Records and mean rate of each time window."""
    per = records.groupBy(F.window("ts", f"{seconds} seconds").alias("w")).agg(F.count("*").alias("n_records"))
    return per.select(F.col("w.start").alias("window_start"), "n_records", (F.col("n_records") / seconds).alias("per_second"))


def size_histogram(files: DataFrame, width: int) -> DataFrame:
    """Files by size, in steps of width bytes."""
    return files.groupBy((F.floor(F.col("bytes") / width) * width).cast("long").alias("from_bytes")).agg(F.count("*").alias("n_files"))


#: Each power of two has so many buckets: a value differs from its bucket's middle by less than a hundredth.
STEPS = 64


def bucket(value: Column) -> Column:
    """The bucket of a whole number in a log-linear histogram: -1 for nought and less, then STEPS for each power of two."""

    def of(v: Column) -> Column:
        power = F.length(F.bin(v)) - 1
        down, up = F.call_function("shiftright", v, power - 6), F.call_function("shiftleft", v, 6 - power)
        return F.when(v <= 0, -1).otherwise(power * STEPS + F.when(power >= 6, down).otherwise(up).cast("int") - STEPS)

    return F.transform(F.array(value.cast("long")), of)[0]


def bucket_start(number: Column) -> Column:
    """The least number of a bucket."""
    power = F.floor(number / STEPS).cast("int")
    inside = (number % STEPS + STEPS).cast("long")
    return F.when(number < 0, F.lit(0).cast("long")).when(power >= 6, F.call_function("shiftleft", inside, power - 6)).otherwise(F.ceil(inside / F.pow(F.lit(2.0), 6 - power)).cast("long"))


def histogram(rows: DataFrame, value: Column, *by: str) -> DataFrame:
    """(by, bucket, n) of whole numbers; nulls count nowhere. Histograms are merged by adding up n."""
    return rows.filter(value.isNotNull()).groupBy(*by, bucket(value).alias("bucket")).agg(F.count("*").alias("n"))


def merged(*histograms: DataFrame) -> DataFrame:
    both = reduce(DataFrame.unionByName, histograms)
    return both.groupBy(*[c for c in both.columns if c != "n"]).agg(F.sum("n").alias("n"))


def quantiles(histogram: DataFrame, shares: tuple[float, ...] = (0.5, 0.9, 0.99)) -> DataFrame:
    """(by, share, value, n): of each group the least value that so many of its n have or stay below, as the start of its
    bucket. A group has a few thousand buckets at most."""
    by = [c for c in histogram.columns if c not in ("bucket", "n")]
    order = Window.partitionBy(*by).orderBy("bucket")
    rows = histogram.withColumns({"upto": F.sum("n").over(order), "total": F.sum("n").over(Window.partitionBy(*by))})
    each = rows.withColumn("share", F.explode(F.array(*map(F.lit, shares)))).filter(F.col("upto") >= F.ceil(F.col("share") * F.col("total")))
    return each.groupBy(*by, "share").agg(F.min("bucket").alias("bucket"), F.first("total").alias("n")).select(*by, "share", bucket_start(F.col("bucket")).alias("value"), "n")


def archive_histograms(manifest: DataFrame) -> DataFrame:
    """(metric, bucket, n) of what a writer did: bytes of each batch before compression, microseconds to compress it and
    to get it into its file, bytes of each file and microseconds to close it."""
    written = manifest.filter("path IS NOT NULL")
    per_file = written.groupBy("path").agg(F.sum("length").alias("length"), F.max("close_micros").alias("close_micros"))
    named = lambda rows, **of: [histogram(rows.withColumn("metric", F.lit(n)), c, "metric") for n, c in of.items()]
    return merged(
        *named(written, batch_size_bytes=F.col("raw_bytes"), compression_duration_micros=F.col("compress_micros"), flush_duration_micros=F.col("compress_micros") + F.col("write_micros")),
        *named(per_file, archive_file_size_bytes=F.col("length"), file_close_micros=F.col("close_micros")),
    )


def counts_by_trigger(rows: DataFrame, trigger: str) -> DataFrame:
    """Flushes or files by what ended them."""
    return rows.groupBy(F.coalesce(trigger, F.lit("end")).alias("ended_by")).agg(F.count("*").alias("n"), F.sum("n_records").alias("n_records"))


def compression_ratio(manifest: DataFrame) -> DataFrame:
    """Archived by payload bytes of each destination, from an archive's manifest."""
    sums = manifest.groupBy("destination").agg(F.sum("length").alias("bytes_compressed"), F.sum("raw_bytes").alias("bytes_written"))
    return sums.withColumn("ratio", F.when(F.col("bytes_written") > 0, F.col("bytes_compressed") / F.col("bytes_written")))


def archive_totals(manifest: DataFrame) -> DataFrame:
    """One row of what an archive's writer did: files, by what closed them, flushes, by what ended them, records, bytes
    before and after compression, and flushes that the store refused."""
    written, first = F.col("path").isNotNull(), F.col("block") == 0

    def count(column: str, name: str, *kinds: str) -> list:
        which = first if column == "roll_trigger" else written
        return [F.count_if(which & (F.coalesce(column, F.lit("end")) == kind)).alias(f"{name}_by_{kind}") for kind in kinds]

    return manifest.agg(
        F.count_if(first).alias("files"), *count("roll_trigger", "rolls", "size", "age", "end"), F.count_if(written).alias("flushes"), *count("flush_trigger", "flushes", "size", "records", "age", "end"),
        F.sum(F.when(written, F.col("n_records"))).alias("records"), F.sum("raw_bytes").alias("bytes_written"), F.sum("length").alias("bytes_compressed"),
        F.count_if(F.col("refusal").isNotNull()).alias("refused_flushes"),
    )


#: Weight and saturation point of each part of the scaling figure.
SCALING = {"lag": (0.40, 100_000.0), "buffer_depth": (0.30, 10_000.0), "memory": (0.30, 1.0)}


def scaling_pressure(samples: DataFrame) -> DataFrame:
    """samples (lag, buffer_depth, memory, circuit_open) with pressure, 0 to 1; 0 while the sink's circuit is open."""
    total = sum((F.lit(w) * F.least(F.col(c) / F.lit(s), F.lit(1.0)) for c, (w, s) in SCALING.items()), F.lit(0.0))
    return samples.withColumn("pressure", F.when(F.col("circuit_open"), 0.0).otherwise(total))
