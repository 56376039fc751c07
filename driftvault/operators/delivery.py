"""What became of each record, and how far a source may be committed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftvault.functions.json_fields import MAX_DEPTH
from driftvault.functions.segments import is_storable
from driftvault.operators import archive
from driftvault.operators.batching import LANE_OFFSETS

#: Why records are dropped.
DROP_REASONS = ("refused", "dlq_too_large", "too_deep", "unreplayable")
#: What dead letters say of why they are there.
TOO_DEEP = f"payload nesting exceeds the maximum parse depth of {MAX_DEPTH}"
REFUSED, FILTERED = "storage_write_failed: ", "inbound filter"


def _settled(reason: Column, size: Column, dlq: bool, max_dlq_bytes: int, text: Column | None = None) -> Column:
    """struct(status, reason, reason_text) for a reason to reject (null: none; `dropped`: an inbound filter drops it).
    The reason is worked out once, however often a plan names what comes of it."""

    def settle(x: Column) -> Column:
        why = x["reason"]
        kept = why.isNull() | (why == "dropped")
        too_large = ~kept & (x["size"] > max_dlq_bytes) if dlq else F.lit(False)
        status = F.when(why.isNull(), "delivered").when(why == "dropped", "filtered").when(F.lit(not dlq) | too_large, "dropped").otherwise("rejected")
        said = F.when(why == "filtered", FILTERED).when(why == "too_deep", TOO_DEEP).when(why == "refused", x["text"])
        return F.struct(status.alias("status"), F.when(too_large, "dlq_too_large").when(~kept, why).alias("reason"), said.alias("reason_text"))

    given = F.struct(reason.alias("reason"), size.alias("size"), F.coalesce(text if text is not None else F.lit(REFUSED + "invalid path")).alias("text"))
    return F.transform(F.array(given), settle)[0]


def _with_settled(df: DataFrame, settled: Column) -> DataFrame:
    return df.withColumn("_settled", settled).withColumns({c: F.col("_settled")[c] for c in ("status", "reason", "reason_text")}).drop("_settled")


def outcomes(routed: DataFrame, dlq: bool = True, max_dlq_bytes: int = 1_000_000) -> DataFrame:
    """routed records (with `key`, the file key, and perhaps `inbound`, what an inbound filter says) with status,
    reason and reason_text.

    delivered: archived. filtered: an inbound filter drops it. rejected: too deeply nested, refused by the store or by
    an inbound filter; the dead-letter output holds it. dropped: rejected, but there is no dead-letter output or it
    cannot hold the payload.
    """
    inbound = F.col("inbound") if "inbound" in routed.columns else F.lit(None).cast("string")
    reason = F.when(inbound == "drop", "dropped").when(inbound == "reject", "filtered").when(F.col("too_deep"), "too_deep").when(~F.coalesce(is_storable(F.col("key")), F.lit(True)), "refused")
    return _with_settled(routed, _settled(reason, F.octet_length("value"), dlq, max_dlq_bytes))


def with_refusals(ledger: DataFrame, manifest: DataFrame, dlq: bool = True, max_dlq_bytes: int = 1_000_000, lane_offsets: int = LANE_OFFSETS) -> DataFrame:
    """An outcomes ledger after its archive was written: the records that the store refused for good (manifest rows with
    `refusal`) are rejected or dropped in place of delivered. Records are known by their places in their lanes, so ties
    and null offsets are told apart; only lanes with a refusal are put in order again."""
    refused = archive.refused_records(manifest)
    if refused.isEmpty():
        return ledger
    delivered = ledger.filter("status = 'delivered'").withColumn("_whole", F.struct(*ledger.columns))
    rows, lanes = archive.lane_rows(delivered, lane_offsets), refused.select(*archive.LANE, "split").distinct()
    touched = archive.in_lane(archive.in_lanes(rows, lanes, "left_semi"))
    told = archive.in_lanes(touched, refused.withColumnRenamed("refusal", "_refusal"), "left", F.col("_pos") == F.col("at"))
    told = told.select("_whole.*", "_refusal")
    bad = told.filter("_refusal IS NOT NULL")
    settled = _settled(F.lit("refused"), F.octet_length("value"), dlq, max_dlq_bytes, F.concat(F.lit(REFUSED), "_refusal"))
    bad = _with_settled(bad, settled).select(*ledger.columns)
    others = archive.in_lanes(rows, lanes, "left_anti").select("_whole.*")
    return ledger.filter("status <> 'delivered'").unionByName(others).unionByName(told.filter("_refusal IS NULL").drop("_refusal")).unionByName(bad)


#: An entry's payload has at most so many bytes, unless a configuration says otherwise.
MAX_PAYLOAD_BYTES = 524_288


def _cut(payload: Column, most: int) -> Column:
    """The longest beginning of a binary payload of at most so many bytes; of text, whole characters only."""
    begins = [F.substring(payload, 1, max(most - k, 0)) for k in range(4)]
    is_text = F.is_valid_utf8(payload.cast("string"))
    whole = F.coalesce(*[F.when(F.is_valid_utf8(b.cast("string")), b) for b in begins], begins[0])
    return F.when(F.octet_length(payload) <= most, payload).when(is_text, whole).otherwise(begins[0])


def dead_letters(ledger: DataFrame, service: str = "driftvault", max_payload_bytes: int | None = MAX_PAYLOAD_BYTES) -> DataFrame:
    """The dead-letter entries of an outcomes ledger, one for each rejected record.

    payload: the record's bytes as they are, as text where they are UTF-8 and in base64 where not (`encoding`). One of
    more than max_payload_bytes is cut, between characters of text, and marked `truncated`; payload_bytes is its whole
    length. A null payload stays null, and has no length.
    """
    time = ["ts"] if "ts" in ledger.columns else []
    rejected = ledger.filter("status = 'rejected'").withColumn("_bytes", F.col("value").cast("binary"))
    kept = _cut(F.col("_bytes"), max_payload_bytes) if max_payload_bytes is not None else F.col("_bytes")
    rejected = rejected.withColumns({"_kept": kept, "_is_text": F.coalesce(F.is_valid_utf8(F.col("_bytes").cast("string")), F.lit(True))})
    return rejected.select(
        F.lit(service).alias("service"), "reason", "reason_text", F.when(F.col("_is_text"), F.col("_kept").cast("string")).otherwise(F.base64("_kept")).alias("payload"),
        F.when(F.col("_is_text"), "utf8").otherwise("base64").alias("encoding"), F.coalesce(F.octet_length("_kept") < F.octet_length("_bytes"), F.lit(False)).alias("truncated"),
        F.octet_length("_bytes").cast("long").alias("payload_bytes"),
        F.coalesce("destination", "topic").alias("destination"), F.col("topic").alias("src_topic"), F.col("part").alias("src_partition"), F.col("off").alias("src_offset"), *time,
    )


def retry_delay(attempt, first: float, most: float):
    """The upper end of the wait before a retry, in seconds: doubled each time, up to `most`. The actual wait is a
    random share of a half to the whole of it."""
    return F.least(F.lit(float(first)) * F.pow(F.lit(2.0), F.least(attempt, F.lit(16))), F.lit(float(most)))
