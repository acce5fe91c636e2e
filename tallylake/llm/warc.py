"""WARC archives: writing captures, and assembling them again from their records.

A capture is a request, a response (or a revisit, if an earlier capture had the same payload)
and a metadata record.  The records are written as text whose line end is what ends a WARC
record, so the writer is Spark's own and any of its file systems will do.  Reading parses each
archive by the records' lengths.  Transactions are assembled by joins on concurrent-to.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallylake.llm.common import staged

END = "\r\n"
RECORD_END = END + END
RECORDS_PER_FILE = 9_999
DATE = "2024-01-01T00:00:00Z"
MIN_REVISIT_BYTES = 0
#: Staged payloads take less disk this way.
PAYLOAD_CODEC = "zstd"

_HEX_DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
_BASE32_DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32_sha1(data: Column) -> Column:
    """The SHA-1 digest as 32 base32 characters: five hex digits give four."""
    digest = F.sha1(data)
    parts = [
        F.lpad(F.conv(F.substring(digest, i * 5 + 1, 5), 16, 32), 4, "0") for i in range(8)
    ]
    return F.translate(F.concat(*parts), _HEX_DIGITS, _BASE32_DIGITS)


def _uuid(*parts: Column) -> Column:
    h = F.md5(F.concat_ws("\n", *parts))
    cut = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">"))


def _record(kind: Column, headers: list[tuple[str, Column]], block: Column) -> Column:
    """One record without its end; a header whose value is null is left out."""
    lines = [
        F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit(END)) for name, value in headers
    ]
    return F.concat(
        F.lit(f"WARC/1.1{END}WARC-Type: "),
        kind,
        F.lit(END),
        F.concat_ws("", *lines),
        F.lit("Content-Length: "),
        F.octet_length(block).cast("string"),
        F.lit(RECORD_END),
        block,
    )


def plan_captures(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    min_revisit_bytes: int = MIN_REVISIT_BYTES,
) -> DataFrame:
    """Rows (capture, page_id, url, payload, digest, size, refers_to), one per page.

    Of captures with equal payloads of at least ``min_revisit_bytes`` bytes the one with the
    smallest page id is the response; the others are revisits and ``refers_to`` names it.
    """
    rows = pages.select(
        F.uuid().alias("capture"),
        F.col(id_col).cast("bigint").alias("page_id"),
        F.col(url_col).cast("string").alias("url"),
        F.coalesce(F.col(payload_col).cast("string"), F.lit("")).alias("payload"),
    ).withColumns(
        {
            "digest": base32_sha1(F.col("payload").cast("binary")),
            "size": F.octet_length("payload").cast("bigint"),
        }
    )
    # Written, so that a task that runs again cannot give a capture another name.
    rows = staged(rows, "warc-captures", PAYLOAD_CODEC)
    # A null id counts as larger than any other; the name settles ties.
    order = F.struct(F.col("page_id").isNull().alias("n"), "page_id", "capture")
    first = (
        rows.where(F.col("size") >= min_revisit_bytes)
        .groupBy("digest", "size")
        .agg(F.min(order).alias("first"), F.count("*").alias("n"))
        .where("n > 1")
        .select("digest", "size", F.col("first.capture").alias("refers_to"))
    )
    # Payloads stay out of the join on the digest, which many rows may share.
    revisits = (
        rows.select("capture", "digest", "size")
        .join(first, ["digest", "size"])
        .where("capture <> refers_to")
        .select("capture", "refers_to")
    )
    # Written, so that its size is known: where it is small, payloads are not shuffled.
    return rows.join(staged(revisits, "warc-revisits"), "capture", "left")


def write_archives(
    captures: DataFrame, folder: str, records_per_file: int = RECORDS_PER_FILE
) -> None:
    """Three records for every capture, gzipped archives of so many records at most."""
    request, main, meta = (
        _uuid(F.col("capture"), F.lit(x)) for x in ("request", "response", "metadata")
    )
    # A header is one line.
    target = F.regexp_replace(F.coalesce("url", F.lit("")), r"[\r\n]+", " ")
    common = [("WARC-Target-URI", target), ("WARC-Date", F.lit(DATE))]
    host = F.regexp_extract(target, r"://([^/?#]*)", 1)
    ask = F.concat(
        F.lit("GET "), target, F.lit(f" HTTP/1.1{END}Host: "), host, F.lit(RECORD_END)
    )
    answer = F.concat(
        F.lit(f"HTTP/1.1 200 OK{END}Content-Type: text/html; charset=utf-8{END}"),
        F.lit("Content-Length: "),
        F.col("size").cast("string"),
        F.lit(RECORD_END),
        F.when(F.col("refers_to").isNotNull(), F.lit("")).otherwise(F.col("payload")),
    )
    fields = F.concat_ws("", F.concat(F.lit("page-id: "), F.col("page_id").cast("string"), F.lit(END)))
    refers = F.when(F.col("refers_to").isNotNull(), _uuid(F.col("refers_to"), F.lit("response")))
    profile = F.when(
        F.col("refers_to").isNotNull(),
        F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
    )
    records = captures.select(
        F.explode(
            F.array(
                _record(
                    F.lit("request"),
                    [("WARC-Record-ID", request), ("WARC-Concurrent-To", main), *common,
                     ("Content-Type", F.lit("application/http; msgtype=request"))],
                    ask,
                ),
                _record(
                    F.when(F.col("refers_to").isNotNull(), F.lit("revisit")).otherwise(F.lit("response")),
                    [("WARC-Record-ID", main), *common,
                     ("Content-Type", F.lit("application/http; msgtype=response")),
                     ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
                     ("WARC-Profile", profile), ("WARC-Refers-To", refers)],
                    answer,
                ),
                _record(
                    F.lit("metadata"),
                    [("WARC-Record-ID", meta), ("WARC-Concurrent-To", main), *common,
                     ("Content-Type", F.lit("application/warc-fields"))],
                    fields,
                ),
            )
        ).alias("value")
    )
    (
        records.write.option("lineSep", RECORD_END)
        .option("compression", "gzip")
        .option("maxRecordsPerFile", records_per_file)
        .text(folder)
    )


# --- reading --------------------------------------------------------------------------


def parse_records(archive: BinaryIO) -> Iterator[tuple[dict[str, list[str]], bytes]]:
    """(headers, block) of every record; header names in lower case."""
    while line := archive.readline():
        if line in (b"\r\n", b"\n"):
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no WARC record begins with {line[:40]!r}")
        headers: dict[str, list[str]] = {}
        while (line := archive.readline()) not in (b"\r\n", b"\n", b""):
            name, _, value = line.decode("utf-8", "replace").partition(":")
            headers.setdefault(name.strip().lower(), []).append(value.strip())
        size = int(headers["content-length"][0])
        block = archive.read(size)
        if len(block) != size:
            raise ValueError("a record is cut off")
        yield headers, block


RECORD = {
    "record_id": pa.string(),
    "type": pa.string(),
    "concurrent_to": pa.list_(pa.string()),
    "refers_to": pa.string(),
    "target_uri": pa.string(),
    "payload_digest": pa.string(),
    "http_header": pa.string(),
    "payload_bytes": pa.int64(),
    "payload_sha1": pa.string(),
    "payload": pa.binary(),
}
RECORD_SCHEMA = (
    "record_id string, type string, concurrent_to array<string>, refers_to string,"
    " target_uri string, payload_digest string, http_header string, payload_bytes bigint,"
    " payload_sha1 string, payload binary"
)
ROWS_AT_ONCE = 500
CAPTURED = ("response", "revisit")


def _row(headers: dict[str, list[str]], block: bytes, with_payloads: bool) -> tuple:
    def one(name: str) -> str | None:
        return headers.get(name, [None])[0]

    http_header = None
    if (one("content-type") or "").startswith("application/http"):
        head, _, block = block.partition(b"\r\n\r\n")
        http_header = head.decode("utf-8", "replace")
    return (
        one("warc-record-id"),
        one("warc-type"),
        headers.get("warc-concurrent-to", []),
        one("warc-refers-to"),
        one("warc-target-uri"),
        one("warc-payload-digest"),
        http_header,
        len(block),
        base64.b32encode(hashlib.sha1(block).digest()).decode(),
        block if with_payloads or one("warc-type") not in CAPTURED else None,
    )


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [()] * len(RECORD)
    arrays = [pa.array(list(c), kind) for c, kind in zip(columns, RECORD.values())]
    return pa.RecordBatch.from_arrays(arrays, list(RECORD))


def read_records(spark: SparkSession, folder: str, with_payloads: bool = True) -> DataFrame:
    """All records of the gzipped archives in a folder; an archive is read by one task.

    The task holds the archive as it is stored, and the records of one batch.  Size and SHA-1
    are those of the payload as read; without payloads those of responses and revisits are
    left null.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                rows = []
                with gzip.GzipFile(fileobj=io.BytesIO(content.as_py())) as archive:
                    for headers, block in parse_records(archive):
                        rows.append(_row(headers, block, with_payloads))
                        if len(rows) == ROWS_AT_ONCE:
                            yield _batch(rows)
                            rows = []
                yield _batch(rows)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(folder)
    return files.select("content").mapInArrow(run, RECORD_SCHEMA)


# --- assembly -------------------------------------------------------------------------


_PART = "struct<record_id:string,type:string,http_header:string,payload:binary>"


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: response, request, metadata and target_uri.

    A capture is a response or revisit.  Its request is the one that either names in its
    concurrent-to; its metadata are the records that name the response or that request.  Each
    part is a struct (record_id, type, http_header, payload, ...), metadata an array; a missing
    request is null, and metadata are an empty array.  Requests and metadata without a
    response give no row.  Of several requests of one response the smallest id is taken.
    """
    part = F.struct("record_id", "type", "http_header", "payload")
    main = records.where(F.col("type").isin(*CAPTURED))
    requests = records.where(F.col("type") == "request")
    metadata = records.where(F.col("type") == "metadata")

    # (response, request), whichever of the two names the other.
    forward = requests.select(
        F.explode("concurrent_to").alias("response_id"), F.col("record_id").alias("request_id")
    )
    back = main.select(
        F.col("record_id").alias("response_id"), F.explode("concurrent_to").alias("request_id")
    )
    pairs = forward.unionByName(back)
    # Ids alone are joined to each other; what they name is joined to them once.
    named = requests.groupBy(F.col("record_id").alias("request_id")).agg(
        F.min(part).alias("request")
    )
    ids = (
        pairs.join(requests.select(F.col("record_id").alias("request_id")), "request_id", "left_semi")
        .groupBy("response_id")
        .agg(F.min("request_id").alias("request_id"))
    )
    asked = ids.join(named, "request_id")
    about = metadata.select(F.explode("concurrent_to").alias("about"), part.alias("meta"))
    through_request = about.join(
        ids.select(F.col("request_id").alias("about"), "response_id"), "about"
    ).select("response_id", "meta")
    described = (
        about.select(F.col("about").alias("response_id"), "meta")
        .unionByName(through_request)
        .groupBy("response_id")
        .agg(F.sort_array(F.collect_set("meta")).alias("metadata"))
    )
    return (
        main.select(
            F.col("record_id").alias("response_id"),
            "target_uri",
            F.struct(
                "record_id",
                "type",
                "refers_to",
                "payload_digest",
                "http_header",
                "payload_bytes",
                "payload_sha1",
                "payload",
            ).alias("response"),
        )
        .join(asked.select("response_id", "request"), "response_id", "left")
        .join(described, "response_id", "left")
        .select(
            "target_uri",
            "response",
            "request",
            F.coalesce("metadata", F.array().cast(f"array<{_PART}>")).alias("metadata"),
        )
    )


def transactions(
    pages: DataFrame,
    folder: str,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    min_revisit_bytes: int = MIN_REVISIT_BYTES,
    records_per_file: int = RECORDS_PER_FILE,
    with_payloads: bool = True,
) -> DataFrame:
    """Writes a capture for every row of ``pages`` to ``folder`` and assembles them again.

    A null payload is an empty one, a null URL an empty target; a null id is left out of the
    metadata.  Rows that repeat an id are captures of their own; of equal payloads one row is
    the response, that with the smallest id, the rest are revisits.  Other columns are ignored;
    an empty table leaves archives without records and gives no rows.  Without payloads the
    rows carry the payloads' size and SHA-1 only.
    """
    captures = plan_captures(pages, id_col, url_col, payload_col, min_revisit_bytes)
    write_archives(captures, folder, records_per_file)
    spark = pages.sparkSession
    # Written, since the assembly reads the records once for each of their sorts.
    rows = assemble(staged(read_records(spark, folder, with_payloads=False), "warc-records", PAYLOAD_CODEC))
    if not with_payloads:
        return rows
    # Payloads are read from the archives once the small columns are joined.
    payloads = (
        read_records(spark, folder)
        .where(F.col("type").isin(*CAPTURED))
        .select(F.col("record_id").alias("payload_of"), "payload")
    )
    return payloads.join(rows, F.col("payload_of") == F.col("response.record_id")).select(
        "target_uri",
        F.col("response").withField("payload", F.col("payload")).alias("response"),
        "request",
        "metadata",
    )


def page_facts(captures: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type and refers_to of every capture.

    The page id is read from the capture's metadata.  Size and digest are made from the
    capture's payload; a revisit has those of the response that it refers to.  Captures without
    payloads have neither.
    """
    fields = F.decode(F.get("metadata", F.lit(0))["payload"], "UTF-8")
    rows = captures.select(
        F.col("response.record_id").alias("id"),
        F.col("response.type").alias("record_type"),
        F.col("response.refers_to").alias("refers_id"),
        F.nullif(F.regexp_extract(fields, r"page-id: (-?\d+)", 1), F.lit(""))
        .cast("bigint")
        .alias("page_id"),
        F.octet_length("response.payload").cast("bigint").alias("payload_bytes"),
        base32_sha1(F.col("response.payload")).alias("payload_digest"),
    )
    rows = staged(rows, "warc-facts")
    known = rows.where(F.col("record_type") == "response").select(
        F.col("id").alias("refers_id"),
        F.col("page_id").alias("o_page"),
        F.col("payload_bytes").alias("o_bytes"),
        F.col("payload_digest").alias("o_digest"),
    )
    return rows.join(known, "refers_id", "left").select(
        "page_id",
        F.coalesce("o_bytes", "payload_bytes").alias("payload_bytes"),
        F.coalesce("o_digest", "payload_digest").alias("payload_digest"),
        "record_type",
        F.col("o_page").alias("refers_to"),
    )
