"""Derived WARC records: every response gets a metadata record and a plain-text conversion record that refer to it.

The three records of a capture are linked both ways a reader needs: ``WARC-Refers-To`` holds the response's record id,
``WARC-Refers-To-Target-URI`` and ``WARC-Refers-To-Date`` repeat its URI and date, and ``WARC-Concurrent-To`` ties the
metadata to the conversion. Record ids are URNs computed from the capture, so a rerun or a retried task writes the same
records. Blocks carry ``WARC-Block-Digest``; the digest of the response's payload is kept in both derived records. The
source's own HTTP headers are kept in the response block, and its content type and length in the metadata.

Everything is a function of one row; nothing is shuffled. References (``&copy;``, ``&#233;``) are decoded in Python, as
there are more than two thousand names.

Defined results: a capture without html (NULL) has an empty payload and an empty text; a NULL url gives records without
a target URI; a NULL id or url counts as a value of its own in the record id; line breaks in a url are percent-encoded
in headers; repeated rows give repeated records; no captures
give no rows. Other columns are ignored.
"""

from __future__ import annotations

from html import unescape

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CRLF = "\r\n"
DATE = "2024-01-01T00:00:00Z"  # of captures whose table has no date
# What plain text drops and replaces, in order: pattern and replacement. Comments, scripts and styles go first, whichever
# begins first: what looks like a tag inside them is none. One that is never closed goes on to the end of the page.
MARKUP_RULES = (
    (r"(?is)<!--.*?(?:-->|\z)|<(script|style)(?=[\s/>])[^>]*>.*?(?:</\1(?=[\s/>])[^>]*>|\z)", " "),
    (r"(?is)<(head|noscript)(?=[\s/>])[^>]*>.*?</\1(?=[\s/>])[^>]*>", " "),
    (r"(?i)<(br|/p|/div|/li|/tr|/h[1-6]|/title|/pre|/table|/ul|/ol)[^>]*>", "\n"),
    (r"<[^>]*>", " "),
)
SPACE_RULES = (
    (r"[ \t\r\f\u00a0]+", " "),
    (r" ?\n[ \n]*", "\n"),
)
TITLE = r"(?is)<title[^>]*>(.*?)</title>"


def _decoded(texts: pa.Array) -> pa.Array:
    return pa.array([None if text is None else unescape(text) for text in texts.to_pylist()], pa.string())


def plain_text(html: Column) -> Column:
    """The visible text of a page: no markup, all references decoded, one space between words, one line break between
    blocks."""
    text = html
    for pattern, replacement in MARKUP_RULES:
        text = F.regexp_replace(text, pattern, replacement)
    text = F.arrow_udf(_decoded, "string")(text)
    for pattern, replacement in SPACE_RULES:
        text = F.regexp_replace(text, pattern, replacement)
    return F.trim(F.regexp_replace(text, r"^\n|\n$", ""))


def digest(block: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(block, 256))


def record_id(kind: str, *parts: Column) -> Column:
    """``<urn:uuid:...>`` from the digest of the parts, with the version and variant bits of a name-based UUID."""
    hashed = F.sha2(F.concat_ws("\n", F.lit(kind), *parts), 256)
    cut = lambda at, size: F.substring(hashed, at, size)
    uuid = F.concat_ws("-", cut(1, 8), cut(9, 4), F.concat(F.lit("8"), cut(14, 3)), F.concat(F.lit("a"), cut(18, 3)), cut(21, 12))
    return F.concat(F.lit("<urn:uuid:"), uuid, F.lit(">"))


def tagged(value: Column) -> Column:
    """A value that tells NULL, the empty text and the same text in a neighbouring field apart."""
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def one_line(value: Column) -> Column:
    """A header value whose line breaks cannot begin another field."""
    return F.replace(F.replace(value, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))


def header(kind: str, fields: dict[str, Column], block: Column) -> Column:
    """The record's header, without the empty line after it; fields that are NULL are left out."""
    lines = [F.lit("WARC/1.1"), F.lit(f"WARC-Type: {kind}")]
    lines += [F.concat(F.lit(f"{name}: "), value) for name, value in fields.items()]
    lines.append(F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string")))
    return F.concat_ws(CRLF, *lines)


def responses(pages: DataFrame) -> DataFrame:
    """page_id, url, date, http_header, payload and record_id of every capture (page_id, url, html)."""
    payload = F.coalesce("html", F.lit(""))
    http = F.concat(
        F.lit(CRLF.join(("HTTP/1.1 200 OK", "Content-Type: text/html; charset=utf-8", "Content-Length: "))),
        F.octet_length(payload).cast("string"),
    )
    return pages.select(
        "page_id", "url", F.lit(DATE).alias("date"), http.alias("http_header"), payload.alias("payload"),
        record_id("response", tagged(F.col("page_id").cast("string")), tagged(F.col("url")), payload).alias("record_id"),
    )


def derive(captures: DataFrame) -> DataFrame:
    """page_id, url, warc_type, record_id, refers_to, payload_digest, block_digest, header and block of the three
    records of every capture (the columns of ``responses``)."""
    text = plain_text(F.col("payload"))
    body = captures.withColumns({"_text": text, "_payload": digest(F.col("payload"))}).withColumns(
        {
            "_conversion": record_id("conversion", F.col("record_id"), F.col("_payload")),
            "_metadata": record_id("metadata", F.col("record_id"), F.col("_payload")),
        }
    )
    title = F.trim(F.regexp_replace(F.regexp_extract("payload", TITLE, 1), r"\s+", " "))
    facts = {
        "title": title, "source-status": F.substring_index(F.substring_index("http_header", CRLF, 1), " ", -2),
        "source-content-type": F.regexp_extract("http_header", r"(?i)content-type: ([^\r\n]*)", 1),
        "source-length": F.octet_length("payload").cast("string"),
        "text-length": F.octet_length("_text").cast("string"),
        "n-links": F.regexp_count("payload", F.lit(r"(?i)<a\s[^>]*href")).cast("string"),
        "conversion-id": F.col("_conversion"),
    }
    facts_block = F.concat_ws(CRLF, *(F.concat(F.lit(f"{name}: "), value) for name, value in facts.items()))
    linked = {
        "WARC-Refers-To": F.col("record_id"), "WARC-Refers-To-Target-URI": one_line(F.col("url")),
        "WARC-Refers-To-Date": F.col("date"),
    }

    def record(kind: str, own: Column, block: Column, content_type: str, more: dict[str, Column]) -> Column:
        fields = {
            "WARC-Record-ID": own, "WARC-Date": F.col("date"), "WARC-Target-URI": one_line(F.col("url")), **more,
            "WARC-Payload-Digest": F.col("_payload") if kind == "response" else None,
            "WARC-Source-Payload-Digest": F.col("_payload") if kind != "response" else None,
            "WARC-Block-Digest": digest(block), "Content-Type": F.lit(content_type),
        }
        fields = {name: value for name, value in fields.items() if value is not None}
        refers = F.lit(None).cast("string") if kind == "response" else F.col("record_id")
        return F.struct(
            F.lit(kind).alias("warc_type"), own.alias("own_id"), refers.alias("refers_to"),
            digest(block).alias("block_digest"), header(kind, fields, block).alias("header"), block.alias("block"),
        )

    response = F.concat("http_header", F.lit(CRLF + CRLF), "payload")
    records = F.array(
        record("response", F.col("record_id"), response, "application/http; msgtype=response", {}),
        record(
            "metadata", F.col("_metadata"), facts_block, "application/warc-fields",
            {**linked, "WARC-Concurrent-To": F.col("_conversion")},
        ),
        record("conversion", F.col("_conversion"), F.col("_text"), "text/plain; charset=utf-8", linked),
    )
    rows = body.select("page_id", "url", F.col("_payload").alias("payload_digest"), F.explode(records).alias("_record"))
    return rows.select(
        "page_id", "url", "_record.warc_type", F.col("_record.own_id").alias("record_id"), "_record.refers_to",
        "payload_digest", "_record.block_digest", "_record.header", "_record.block",
    )


def write_warc(records: DataFrame, path: str) -> None:
    """Write records as WARC files: header, empty line, block, and two line breaks, one record after the other."""
    lines = records.select(F.concat("header", F.lit(CRLF + CRLF), "block").alias("value"))
    lines.write.option("lineSep", CRLF + CRLF).text(path)


def read_warc(raw: bytes) -> list[tuple[dict[str, str], bytes]]:
    """Header fields and block of every record of one WARC file."""
    records, at = [], 0
    while at < len(raw):
        end = raw.index(b"\r\n\r\n", at)
        version, *lines = raw[at:end].decode().split(CRLF)
        fields = dict(line.split(": ", 1) for line in lines)
        fields["version"] = version
        begin = end + 4
        at = begin + int(fields["Content-Length"])
        records.append((fields, raw[begin:at]))
        at += 4
    return records
