"""WARC derivatives: a metadata record and a plain-text conversion record for every response, linked to it.

Responses are rows of (record_id, target_uri, date, http_headers, payload). Each derived record refers to its response by
record id, target URI and date, and preserves the source's headers and payload digest; its own block has a digest too. Ids
are made from the source's id, so a task that runs again makes the same records. Records are whole strings, which
Spark's text sink writes as WARC files (:func:`write`); :func:`read` splits them again by their lengths.

The text of a page is its HTML without comments, scripts, styles and tags; ends of blocks are line breaks, spaces are
joined, and the named entities of ``ENTITIES`` are resolved.

Defined results. Control characters cannot break a record: in URIs they are percent-encoded, in field values and
headers white space and control characters are joined to one space. Null payloads, headers and URIs are empty (a header without
value is left out). Repeated responses give repeated, equal records; there are no ties to break. An empty table gives no
records. A payload and its derivatives are values of one row, so of less than 2 GB. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

VERSION = "WARC/1.1"
DERIVED_DATE = "2024-01-01T00:00:00Z"
PAGE_HEADERS = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
# FIXED VALUES: named entities and what they stand for; & last, so that nothing is resolved twice.
ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&"))
# FIXED VALUES: what goes from HTML, in order, as (pattern, replacement).
CUTS = (
    (r"(?s)<!--.*?-->", " "),
    (r"(?is)<script\b.*?</script\s*>", " "),
    (r"(?is)<style\b.*?</style\s*>", " "),
    (r"(?i)<(?:br|/p|/div|/li|/h[1-6]|/title|/article|/ul|/nav|/tr)\b[^>]*>", "\n"),
    (r"(?s)<[^>]*>", ""),
    (r"[ \t\r\f]+", " "),
    (r" ?\n[ \n]*", "\n"),
)


CONTROL = [*range(0x20), 0x7F]
BLANKS = r"[\x00-\x20\x7F]+"
FILE_RECORDS = 100_000


def uri(text: Column) -> Column:
    """A URI without control characters: each is percent-encoded."""
    for code in CONTROL:
        text = F.replace(text, F.lit(chr(code)), F.lit(f"%{code:02X}"))
    return text


def one_line(text: Column) -> Column:
    """A field's value: white space and control characters as one space, none at the ends."""
    return F.trim(F.regexp_replace(text, BLANKS, " "))


def uuid_of(text: Column) -> Column:
    """A record id that is always the same for the same text."""
    digest = F.sha2(text, 256)
    parts = [F.substring(digest, at, size) for at, size in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def digest(text: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(text, 256))


def plain_text(html: Column) -> Column:
    text = F.coalesce(html, F.lit(""))
    for pattern, replacement in CUTS:
        text = F.regexp_replace(text, pattern, replacement)
    for entity, char in ENTITIES:
        text = F.replace(text, F.lit(entity), F.lit(char))
    return F.trim(text)


def responses(pages: DataFrame) -> DataFrame:
    """Response records of a table of pages."""
    url, html = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("url", "html"))
    key = F.concat_ws("|", F.lit("response"), F.coalesce(F.col("page_id").cast("string"), F.lit("")), url, html)
    return pages.select(
        "page_id",
        uuid_of(key).alias("record_id"),
        url.alias("target_uri"),
        F.lit(DERIVED_DATE).alias("date"),
        F.lit(PAGE_HEADERS).alias("http_headers"),
        html.alias("payload"),
    )


def derivatives(source: DataFrame, keep: tuple[str, ...] = (), date: str = DERIVED_DATE) -> DataFrame:
    """Two rows for each response: its metadata and its conversion record, with their headers as columns.

    ``keep`` are columns of the source that are carried along.
    """
    names = ("record_id", "target_uri", "date", "http_headers", "payload")
    known = {c: F.coalesce(F.col(c).cast("string"), F.lit("")) for c in names}
    known |= {"target_uri": uri(known["target_uri"]), "date": one_line(known["date"]), "record_id": one_line(known["record_id"])}
    read = source.select(*keep, *[c.alias(name) for name, c in known.items()])
    read = read.withColumn("source_digest", digest(F.col("payload"))).withColumn("plain", plain_text(F.col("payload")))
    # Header lines of the source are kept as fields, each with its own line; the status line is a field too.
    lines = F.filter(F.split("http_headers", "\r\n"), lambda line: line != "")
    kept = F.transform(lines, lambda line: F.concat(F.lit("source-header: "), one_line(line), F.lit("\r\n")))
    title = one_line(F.regexp_extract("payload", r"(?is)<title[^>]*>(.*?)</title", 1))
    language = F.regexp_extract("payload", r"(?i)<html[^>]*\blang=[\"']?([A-Za-z-]+)", 1)
    links = F.size(F.split("payload", r"(?i)<a\s[^>]*href=")) - 1
    fields = F.concat(
        F.lit("source-payload-digest: "), F.col("source_digest"), F.lit("\r\nsource-payload-length: "),
        F.octet_length("payload").cast("string"), F.lit("\r\n"), F.array_join(kept, ""), F.lit("title: "), title,
        F.lit("\r\nlanguage: "), language, F.lit("\r\noutlinks: "), links.cast("string"),
        F.lit("\r\nconversion: "), uuid_of(F.concat("record_id", F.lit("|conversion"))), F.lit("\r\n"),
    )
    made = F.array(
        F.struct(F.lit("metadata").alias("record_type"), F.lit("application/warc-fields").alias("content_type"), fields.alias("block")),
        F.struct(F.lit("conversion").alias("record_type"), F.lit("text/plain; charset=utf-8").alias("content_type"), F.col("plain").alias("block")),
    )
    rows = read.select(*keep, F.col("record_id").alias("refers_to"), "target_uri", F.col("date").alias("refers_to_date"), "source_digest", F.explode(made).alias("made"))
    return rows.select(
        *keep,
        "made.record_type",
        uuid_of(F.concat("refers_to", F.lit("|"), F.col("made.record_type"))).alias("record_id"),
        "refers_to",
        "target_uri",
        "refers_to_date",
        F.lit(date).alias("date"),
        "source_digest",
        "made.content_type",
        F.octet_length("made.block").cast("long").alias("content_length"),
        digest(F.col("made.block")).alias("block_digest"),
        "made.block",
    )


def records(derived: DataFrame) -> DataFrame:
    """One string a record, as it stands in a WARC file, but for the last line break, which the sink adds."""
    headers = (
        ("WARC-Type", "record_type"),
        ("WARC-Record-ID", "record_id"),
        ("WARC-Date", "date"),
        ("WARC-Target-URI", "target_uri"),
        ("WARC-Refers-To", "refers_to"),
        ("WARC-Refers-To-Target-URI", "target_uri"),
        ("WARC-Refers-To-Date", "refers_to_date"),
        ("WARC-Source-Payload-Digest", "source_digest"),
        ("WARC-Block-Digest", "block_digest"),
        ("Content-Type", "content_type"),
    )
    lines = [F.when(F.col(c) != "", F.concat(F.lit(f"{name}: "), F.col(c))) for name, c in headers]
    length = F.concat(F.lit("Content-Length: "), F.col("content_length").cast("string"))
    head = F.concat_ws("\r\n", F.lit(VERSION), *lines, length)
    return derived.select(F.concat(head, F.lit("\r\n\r\n"), F.col("block"), F.lit("\r\n")).alias("value"))


def write(derived: DataFrame, path: str) -> None:
    """WARC files, one or more a task, of ``FILE_RECORDS`` records at most."""
    records(derived).write.option("lineSep", "\r\n").option("maxRecordsPerFile", FILE_RECORDS).text(path)


def read(spark, path: str) -> DataFrame:
    """(record_type, record_id, refers_to, target_uri, block) of the WARC files under a path; a task reads whole files."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = {"WARC-Type": 0, "WARC-Record-ID": 1, "WARC-Refers-To": 2, "WARC-Target-URI": 3}
        for batch in batches:
            for content in batch.column(0).to_pylist():
                rows, at = [], 0
                while at < len(content):
                    end = content.index(b"\r\n\r\n", at)
                    fields = dict(line.split(": ", 1) for line in content[at:end].decode().split("\r\n")[1:])
                    size = int(fields["Content-Length"])
                    row = [fields.get(name) for name in names]
                    rows.append([*row, content[end + 4 : end + 4 + size].decode()])
                    at = end + 4 + size + 4
                columns = [pa.array(list(c), pa.string()) for c in zip(*rows)] or [pa.array([], pa.string())] * 5
                yield pa.RecordBatch.from_arrays(columns, ["record_type", "record_id", "refers_to", "target_uri", "block"])

    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(run, "record_type string, record_id string, refers_to string, target_uri string, block string")
