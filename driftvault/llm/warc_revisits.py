"""Web archives with revisit records: payloads that are equal are stored once.

Only headers are shuffled to find equal payloads: by digest, with the largest page_id taken before the shuffle.
Then each page moves once, to the task that writes it; what repeats another page's payload is written as a revisit
record without the payload. Archives are gzip members, one for each record, below the shared folder; a task writes
files under names of its own and reports them, so what a lost or repeated task leaves behind is never read.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import json
import uuid

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftvault.llm.common import join_weighted, n_parts, stage
from driftvault.sources.shared import shared_folder

#: Shorter payloads are stored each for itself.
MIN_BYTES = 1000
#: A task begins a new file when one has this many bytes.
FILE_BYTES = 256 << 20
GZIP_LEVEL = 4
_FIRST = -(2**63)
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_RESPONSE = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
_MANIFEST = "archive string, records long, bytes long"
_RECORDS = "page_key long, is_null boolean, url string, record_id string, record_type string, refers_to_id string, payload_digest string, payload_bytes long, payload binary"


def record_id(page_key: int, digest: str, label: str = "") -> str:
    """The identifier of a page's record with this payload; label: which of several rows that repeat both it is."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_key}/{digest}/{label}')}>"


def write_record(fields: dict[str, str], block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in (fields | {"Content-Length": str(len(block))}).items())
    return gzip.compress(b"WARC/1.1\r\n" + head.encode("utf-8") + b"\r\n" + block + b"\r\n\r\n", GZIP_LEVEL, mtime=0)


def read_records(stream):
    """(fields, block) of each record of an uncompressed archive stream."""
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no record begins with {line[:40]!r}")
        fields = {}
        while (line := stream.readline()) not in (b"\r\n", b""):
            name, _, value = line.decode("utf-8").partition(":")
            fields[name.strip().lower()] = value.strip()
        size = int(fields["content-length"])
        block = stream.read(size)
        if len(block) != size:
            raise ValueError(f"a record of {size} bytes ends after {len(block)}")
        yield fields, block


def _sha1_field(digest: str) -> str:
    return "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode()


def target_uri(url: str | None, page_key: int) -> str:
    """A page's URL as a header takes it, or a URN where it has none."""
    return " ".join(url.split()) if url and url.strip() else f"urn:page:{page_key}"


def _page_records(row, date: str) -> bytes:
    """The record of a page; row: page_key, is_null, url, html, n_bytes, digest, label, revisit, winner (of a revisit), winner_url."""
    fields = {
        "WARC-Type": "response", "WARC-Record-ID": record_id(row.page_key, row.digest, row.label), "WARC-Date": date, "WARC-Target-URI": target_uri(row.url, row.page_key),
        "WARC-Payload-Digest": _sha1_field(row.digest), "X-Page-Key": str(row.page_key), "X-Page-Null": str(int(row.is_null)),
        "Content-Type": "application/http; msgtype=response",
    }
    if row.url is not None:
        fields["X-Url"] = json.dumps(row.url)  # as it is; the target URI is what a reader of archives can take
    head = _RESPONSE % row.n_bytes
    if not row.revisit:
        return write_record(fields, head + row.html.encode("utf-8"))
    of = row.winner
    fields |= {
        "WARC-Type": "revisit", "WARC-Profile": _PROFILE, "WARC-Refers-To": record_id(of, row.digest), "WARC-Refers-To-Target-URI": target_uri(row.winner_url, of),
        "WARC-Refers-To-Date": date,
    }
    return write_record(fields, head)


def _writer(folder: str, date: str):
    def write(frames):
        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        out, path, records, size = None, "", 0, 0
        for frame in frames:
            for row in frame.itertuples(index=False):
                if out is not None and size >= FILE_BYTES:
                    out.close()
                    yield pd.DataFrame({"archive": [path], "records": [records], "bytes": [size]})
                    out = None
                if out is None:
                    name, records, size = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                    path, out = f"{folder}/{name}", store.open_output_stream(f"{root}/{name}", compression=None)
                record = _page_records(row, date)
                out.write(record)
                records, size = records + 1, size + len(record)
        if out is not None:
            out.close()
            yield pd.DataFrame({"archive": [path], "records": [records], "bytes": [size]})

    return write


_PAGE = ["page_key", "digest"]
_WRITTEN = ["page_key", "is_null", "url", "html", "n_bytes", "digest", "label", "winner", "winner_url"]


def _for_writer(rows: DataFrame) -> DataFrame:
    """No number is null in what the writer gets: beside nulls pandas would make doubles of identifiers."""
    return rows.withColumns({"revisit": F.col("winner").isNotNull(), "winner": F.coalesce("winner", F.lit(0).cast("long"))})


def _repeated(pages: DataFrame, repeats: DataFrame, revisits: DataFrame, total: int) -> DataFrame:
    """The rows to write of pages that repeat page and payload (repeats: n, first_url). Rows that agree in all are
    counted before the shuffle and told apart again after it, with the payload only where it is written."""
    hot = F.broadcast(repeats.filter(F.col("n") > max(total // 1000, 1000)).select(*_PAGE))
    cold = repeats.select(*_PAGE)
    rows = pages.join(hot, _PAGE, "left_semi").unionByName(pages.join(hot, _PAGE, "left_anti").join(cold, _PAGE, "left_semi"))
    rows = stage(rows.groupBy("page_key", "is_null", "digest", "n_bytes", "url").agg(F.count("*").alias("copies"), F.first("html").alias("html")), "warc-repeated")
    rows = join_weighted(rows, repeats, _PAGE, "n", total).drop("n").join(revisits, _PAGE, "left")
    rows = rows.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)))
    first = (F.col("copy") == 0) & F.col("url").eqNullSafe(F.col("first_url"))
    again = F.col("winner").isNull() & (F.col("n_bytes") >= MIN_BYTES) & ~first
    return rows.select(
        "page_key", "is_null", "url", F.when(F.col("winner").isNull() & ~again, F.col("html")).alias("html"), "n_bytes", "digest",
        F.when(first, "").otherwise(F.concat_ws("/", "copy", F.hex(F.xxhash64("url")), F.col("url").isNull().cast("string"))).alias("label"),
        F.when(again, F.col("page_key")).otherwise(F.col("winner")).alias("winner"), F.when(again, F.col("first_url")).otherwise(F.col("winner_url")).alias("winner_url"),
    )


def headers(pages: DataFrame) -> DataFrame:
    return pages.select("page_key", "url", "n_bytes", "digest", F.xxhash64("html").alias("check"))


def write_archives(pages: DataFrame, folder: str | None = None, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Writes a record for each row of pages (page_id, url, html) and returns the manifest: archive, records, bytes.

    A null html is an empty payload, a null page_id counts as the smallest, a null url is written as a URN. Of
    rows that repeat page_id and payload one with the largest url is the response, if one of them is. An empty table
    writes nothing; other columns are not looked at. `date` is the records' date: pages carry none.
    """
    spark = pages.sparkSession
    folder, body = (folder or shared_folder(spark, "warc")).rstrip("/"), F.encode("html", "UTF-8")
    pages = pages.select(
        F.coalesce("page_id", F.lit(_FIRST)).cast("long").alias("page_key"), F.col("page_id").isNull().alias("is_null"), "url", F.coalesce("html", F.lit("")).alias("html")
    ).withColumns({"n_bytes": F.length(body).cast("long"), "digest": F.sha1(body)})
    heads = stage(headers(pages), "warc-headers")
    total, size = heads.agg(F.count("*"), F.coalesce(F.sum("n_bytes"), F.lit(0))).first()
    key = ["digest", "n_bytes", "check"]
    repeats = stage(heads.groupBy(*_PAGE).agg(F.count("*").alias("n"), F.max("url").alias("first_url")).filter("n > 1"), "warc-repeats")
    large = heads.filter(F.col("n_bytes") >= MIN_BYTES)
    # of rows that repeat the largest page_id one with the largest url is the response
    groups = large.groupBy(*key).agg(F.max(F.struct("page_key", "url")).alias("best"), F.count("*").alias("n")).filter("n > 1")
    groups = groups.select(*key, "n", F.col("best.page_key").alias("winner"), F.col("best.url").alias("winner_url"))
    revisits = join_weighted(large.drop("url"), stage(groups, "warc-groups"), key, "n", total).filter("page_key <> winner")
    revisits = revisits.groupBy(*_PAGE).agg(F.max(F.struct("winner", "winner_url")).alias("w")).select(*_PAGE, "w.*")
    parts, once = max(n_parts(spark), size // FILE_BYTES), pages
    if not repeats.isEmpty():
        once = pages.join(F.broadcast(repeats.filter(F.col("n") > max(total // 1000, 1000))), _PAGE, "left_anti").join(repeats, _PAGE, "left_anti")
    # by page_id, so that equal payloads of many pages do not meet in one task
    dealt = once.withColumn("label", F.lit("")).repartition(parts, *_PAGE)
    rows = dealt.join(revisits.hint("merge"), _PAGE, "left").select(*_WRITTEN)
    if not repeats.isEmpty():
        again = _repeated(pages, repeats, stage(revisits, "warc-revisits"), total)
        rows = rows.unionByName(again.repartition(parts, *_PAGE, "label").select(*_WRITTEN))
    return stage(_for_writer(rows).mapInPandas(_writer(folder, date), _MANIFEST), "warc-manifest")


def _reader(with_payload: bool):
    def read(frames):
        for frame in frames:
            for uri in frame["archive"]:
                store, path = fs.FileSystem.from_uri(uri)
                rows = []
                with store.open_input_stream(path, compression=None) as raw, io.BufferedReader(gzip.GzipFile(fileobj=raw), 1 << 20) as stream:
                    for fields, block in read_records(stream):
                        rows.append(_parsed(fields, block, with_payload))
                        if len(rows) >= (200 if with_payload else 5000):
                            yield pd.DataFrame(rows, columns=_COLUMNS)
                            rows = []
                yield pd.DataFrame(rows, columns=_COLUMNS)

    return read


_COLUMNS = [c.split()[0] for c in _RECORDS.split(", ")]


def _parsed(fields: dict[str, str], block: bytes, with_payload: bool) -> tuple:
    payload = block.partition(b"\r\n\r\n")[2]
    stated = base64.b32decode(fields["warc-payload-digest"].removeprefix("sha1:")).hex()
    revisit = fields["warc-type"] == "revisit"
    if not revisit and hashlib.sha1(payload).hexdigest() != stated:
        raise ValueError(f"{fields['warc-record-id']}: the payload does not have the digest that its header states")
    url = json.loads(fields["x-url"]) if "x-url" in fields else None
    return (
        int(fields["x-page-key"]), fields["x-page-null"] == "1", url, fields["warc-record-id"], fields["warc-type"], fields.get("warc-refers-to"),
        stated, len(payload), payload if with_payload and not revisit else None,
    )


def read_archives(manifest: DataFrame, with_payload: bool = False) -> DataFrame:
    """The records of the manifest's archives, revisits resolved: page_id, url, record_type, refers_to,
    payload_digest, payload_bytes and, on demand, payload. Every response's payload is held against its digest; a
    revisit's payload and length come from the response that it names; one that names none of the archives' responses
    is an error. A response that a third of all records revisit is joined without an exchange."""
    files = manifest.select("archive").repartition(max(n_parts(manifest.sparkSession), manifest.count()))
    records = stage(files.mapInPandas(_reader(with_payload), _RECORDS), "warc-records")
    page_id = F.when(~F.col("is_null"), F.col("page_key"))
    responses = records.filter("record_type = 'response'")
    own = responses.select(
        page_id.alias("page_id"), "url", "record_type", F.lit(None).cast("long").alias("refers_to"), "payload_digest", "payload_bytes", "payload"
    )
    revisits = records.filter("record_type = 'revisit'").select(page_id.alias("page_id"), "url", "record_type", "refers_to_id", "payload_digest")
    asked = revisits.groupBy("refers_to_id").agg(F.count("*").alias("n"))
    named = responses.select(F.col("record_id").alias("refers_to_id"), page_id.alias("refers_to"), "payload_bytes", "payload")
    found = join_weighted(revisits, stage(named.join(asked, "refers_to_id"), "warc-revisited"), ["refers_to_id"], "n", revisits.count(), "left")
    lost = F.raise_error(F.concat(F.lit("a revisit names a response that is in no archive: "), "refers_to_id"))
    found = found.withColumns({c: F.when(F.col("n").isNotNull(), F.col(c)).otherwise(lost) for c in ("refers_to", "payload_bytes")})
    return own.unionByName(found.drop("refers_to_id", "n")).select(*([c for c in own.columns if c != "payload"] + ["payload"] * with_payload))
