"""WARC archives without repeated payloads.

Records carry their payload's SHA-1. Of the headers alone, those that share a digest meet: the largest id among equal
payloads is the original, the others become revisit records that name it and carry no payload. Only digests that occur
twice and are long enough form the table of originals, one row each, so a payload that a third of all records repeat
is one row there; Catalyst broadcasts that table or joins by sorting, as its written size tells.

Archives are written and read by Spark's text source. A WARC record ends with two line breaks, which the writer adds
as its line separator; the reader splits where a record's first two header lines follow. The second of them names the
archive's own random UUID, so no payload can hold the separator, files can be read in splits, and neither a file nor a
partition has to fit one task, only a record.

Nulls: a null payload is empty (and always a response), a null url gives a record without target, a null id counts as
smaller than any other. If rows repeat the largest id of a payload, or no row has an id, those are all responses. Line
breaks in urls are escaped. An empty table gives an archive of its description only. Columns besides id, url and
payload are not archived.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sparkcorpus.llm.common import save

MIN_REVISIT_BYTES = 1000
_BREAK = "\r\n"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _start(archive: str) -> str:
    return f"WARC/1.1{_BREAK}WARC-Warcinfo-ID: <urn:uuid:{archive}>{_BREAK}"


def _record_id(*parts: Column) -> Column:
    """A name-based UUID as URN."""
    h = F.md5(F.concat_ws("|", *parts))
    cut = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (14, 3), (18, 3), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), cut[0], F.lit("-"), cut[1], F.lit("-3"), cut[2], F.lit("-8"), cut[3], F.lit("-"), cut[4], F.lit(">"))


def resolve_revisits(records: DataFrame, least_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Records (id, payload, digest, payload_bytes, ...) with `refers_to`, the original's id where they revisit it."""
    headers = records.filter(F.col("payload_bytes") >= least_bytes).select("digest", "payload_bytes", "id")
    originals = headers.groupBy("digest", "payload_bytes").agg(F.max("id").alias("original"), F.count("*").alias("n"))
    originals = save(originals.filter("n > 1 and original is not null").drop("n"), "originals")
    joined = records.join(originals, ["digest", "payload_bytes"], "left")
    revisit = F.col("original").isNotNull() & ~F.col("id").eqNullSafe(F.col("original"))
    return joined.withColumn("refers_to", F.when(revisit, F.col("original"))).drop("original")


def write_warc(pages: DataFrame, path: str, page_id: str = "page_id", url: str = "url", payload: str = "html", least_bytes: int = MIN_REVISIT_BYTES) -> str:
    """Write the deduplicated archive; returns its id, which the reader needs."""
    archive = str(uuid.uuid4())
    content = F.coalesce(F.col(payload), F.lit(""))
    target = F.regexp_replace(F.regexp_replace(F.col(url), "\r", "%0D"), "\n", "%0A")
    records = pages.select(
        F.col(page_id).alias("id"), target.alias("url"), content.alias("payload"),
        F.sha1(content).alias("digest"), F.octet_length(content).cast("long").alias("payload_bytes"),
    )
    records = resolve_revisits(records, least_bytes)
    revisit = F.col("refers_to").isNotNull()
    name = lambda c: _record_id(F.lit(archive), F.coalesce(F.col(c).cast("string"), F.lit("")), F.col("digest"))
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{_BREAK}Content-Type: text/html; charset=utf-8{_BREAK}Content-Length: "), F.col("payload_bytes").cast("string"), F.lit(_BREAK * 2))
    block = F.concat(http, F.when(revisit, F.lit("")).otherwise(F.col("payload")))
    line = lambda field, value: F.coalesce(F.concat(F.lit(field + ": "), value, F.lit(_BREAK)), F.lit(""))
    text = F.concat(
        F.lit(_start(archive)),
        line("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        line("WARC-Record-ID", name("id")),
        line("WARC-Date", F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'")),
        line("WARC-Target-URI", F.col("url")),
        line("WARC-Refers-To", F.when(revisit, name("refers_to"))),
        line("WARC-Profile", F.when(revisit, F.lit(_PROFILE))),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        line("X-Page-ID", F.col("id").cast("string")),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", F.octet_length(block).cast("string")),
        F.lit(_BREAK), block,
    )
    fields = f"software: sparkcorpus{_BREAK}format: WARC File Format 1.1{_BREAK}"
    about = (
        f"{_start(archive)}WARC-Type: warcinfo{_BREAK}WARC-Record-ID: <urn:uuid:{archive}>{_BREAK}"
        f"Content-Type: application/warc-fields{_BREAK}Content-Length: {len(fields)}{_BREAK * 2}{fields}"
    )
    described = pages.sparkSession.range(1).select(F.lit(about).alias("text"))
    described.unionByName(records.select(text.alias("text"))).write.option("lineSep", _BREAK * 2).text(path)
    return archive


def read_warc(spark: SparkSession, path: str, archive: str) -> DataFrame:
    """One row per record but the description: `headers` (a map), `block` (binary), `whole` (is the block as long as
    its header says?)."""
    pieces = spark.read.option("lineSep", _start(archive)).text(path)
    cut = F.instr("value", _BREAK * 2)
    lines = F.split(F.substring(F.col("value"), F.lit(1), cut - 1), _BREAK)
    pairs = F.transform(lines, lambda x: F.struct(F.substring_index(x, ": ", 1).alias("k"), F.substring(x, F.instr(x, ": ") + 2, F.length(x)).alias("v")))
    body = F.encode(F.substring(F.col("value"), cut + 4, F.length("value")), "UTF-8")
    records = pieces.filter(F.length("value") > 0).select(F.map_from_entries(pairs).alias("headers"), body.alias("rest"))
    size = F.col("headers")["Content-Length"].cast("int")
    return records.filter(F.col("headers")["WARC-Type"] != "warcinfo").select(
        "headers", F.substring(F.col("rest"), F.lit(1), size).alias("block"), (F.octet_length("rest") >= size).alias("whole")
    )


def payload_of(block: Column) -> Column:
    """The payload of an HTTP response block: what follows its header, as text."""
    text = F.decode(block, "UTF-8")
    return F.substring(text, F.instr(text, _BREAK * 2) + 4, F.length(text))


def index(records: DataFrame, id_type: str = "bigint") -> DataFrame:
    """A slim row per record read: ids (page ids of the given type), type, digest, and for responses length and digest of the payload as read."""
    h = F.col("headers")
    response = h["WARC-Type"] == "response"
    payload = payload_of(F.col("block"))
    return records.select(
        h["WARC-Record-ID"].alias("record"), h["WARC-Refers-To"].alias("refers_to_record"), h["WARC-Type"].alias("record_type"),
        h["X-Page-ID"].cast(id_type).alias("page_id"), F.substring_index(h["WARC-Payload-Digest"], ":", -1).alias("declared"),
        F.when(response, F.octet_length(payload).cast("long")).alias("payload_bytes"), F.when(response, F.sha1(payload)).alias("read_digest"), "whole",
    )


def archive_pages(pages: DataFrame, path: str, **columns) -> DataFrame:
    """Write the archive, read it back, and resolve its revisits: one row per record with `page_id`, `payload_bytes`
    and `payload_digest` of the full payload, `record_type`, `refers_to`, and `intact` (is the payload read what the
    header declares?)."""
    archive = write_warc(pages, path, **columns)
    id_type = dict(pages.dtypes)[columns.get("page_id", "page_id")]
    rows = save(index(read_warc(pages.sparkSession, path, archive), id_type), "warc-index")
    asked = rows.filter("record_type = 'revisit'").select(F.col("refers_to_record").alias("record")).distinct()
    originals = rows.filter("record_type = 'response'").join(save(asked, "asked"), "record", "left_semi")
    originals = originals.groupBy(F.col("record").alias("original")).agg(
        F.first("page_id").alias("refers_to"), F.first("payload_bytes").alias("original_bytes"), F.first("read_digest").alias("original_digest")
    )
    found = rows.join(save(originals, "originals-read"), F.col("refers_to_record") == F.col("original"), "left")
    digest = F.coalesce("read_digest", "original_digest")
    return found.select(
        "page_id", F.coalesce("payload_bytes", "original_bytes").alias("payload_bytes"), digest.alias("payload_digest"),
        "record_type", "refers_to", (F.col("whole") & (digest == F.col("declared"))).alias("intact"),
    )
