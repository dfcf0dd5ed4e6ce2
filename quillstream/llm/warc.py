"""WARC derivative builder: metadata and plain-text conversion records from responses.

A response record is a row with its WARC headers and its block (HTTP head and payload).
``derive`` makes two linked records from each: a *metadata* record of fields about the
capture, and a *conversion* record with the plain text of an HTML payload.  Both name the
response in ``WARC-Refers-To``, keep its target, date and source headers, and carry digests
of their own blocks.  All steps up to the records are built-in functions; records never leave
their task.  Only the members of an archive file are compressed in Python.
"""

from __future__ import annotations

import gzip
from html.entities import html5, name2codepoint

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CRLF = "\r\n"
# Capture time given to pages that carry none.
DATE = "2024-01-01T00:00:00Z"
# Fixed value: the alphabet of base 32.
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

# What leaves a page with its content.  An element or tag that is never closed reaches to the end
# of the page, as in a browser, so no part of a page is searched twice.
DROPPED = (r"(?is)<!--.*?(?:-->|\z)|<script\b.*?(?:</script\s*>|\z)|<style\b.*?(?:</style\s*>|\z)"
           r"|<noscript\b.*?(?:</noscript\s*>|\z)|<template\b.*?(?:</template\s*>|\z)"
           r"|<title\b.*?(?:</title\s*>|\z)|<!doctype[^>]*(?:>|\z)")
BLOCKS = (r"(?i)</?(?:p|div|br|hr|h[1-6]|li|ul|ol|dl|dt|dd|tr|table|article|section|aside|header|footer|nav|main|form"
          r"|blockquote|pre|head|body|html)\b[^>]*(?:>|\z)")
TAGS = r"</?[A-Za-z][^>]*(?:>|\z)"
TITLE = r"(?is)<title\b[^>]*(?:>|\z)(.*?)(?:</title\s*>|\z)"
# Character references: decimal, hexadecimal or named, all closed by a semicolon.
REFERENCE = r"&(#0*[0-9]{1,7}|#[xX]0*[0-9A-Fa-f]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});"
# What a reference may stand for instead of its own number: the upper control characters are
# those of Windows-1252, a hard space is a space.
INSTEAD = {160: 32} | {n: ord(c) for n in range(0x80, 0xA0) if (c := bytes([n]).decode("cp1252", "ignore"))}
# The names of HTML 4 with the characters of HTML 5, which moved two of them.
NAMES = {name: html5[f"{name};"] for name in ("apos", *name2codepoint)} | {"nbsp": " "}
UNKNOWN = 0xFFFD


def _literal_map(pairs: dict) -> Column:
    return F.map_from_arrays(F.array(*map(F.lit, pairs)), F.array(*map(F.lit, pairs.values())))


def decoded(text: Column) -> Column:
    """``text`` with its character references decoded, once; unknown names stay as they are.

    Numbers that are no characters become U+FFFD.
    """
    found = F.regexp_extract_all(text, F.lit(REFERENCE), F.lit(1))

    def sign(ref: Column) -> Column:
        is_hex = F.lower(F.substring(ref, 2, 1)) == "x"
        number = F.when(is_hex, F.conv(F.substr(ref, F.lit(3)), 16, 10)).otherwise(F.substr(ref, F.lit(2))).cast("int")
        number = F.coalesce(F.try_element_at(_literal_map(INSTEAD), number), number)
        wrong = (number == 0) | number.between(0xD800, 0xDFFF) | (number > 0x10FFFF)
        code = F.when(wrong, F.lit(UNKNOWN)).otherwise(number)
        named = F.coalesce(F.try_element_at(_literal_map(NAMES), ref), F.concat(F.lit("&"), ref, F.lit(";")))
        return F.when(F.startswith(ref, F.lit("#")), F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")).otherwise(named)

    put = F.zip_with(F.split(text, REFERENCE, -1), F.transform(found, sign), lambda a, b: F.concat(a, F.coalesce(b, F.lit(""))))
    return F.when(text.contains("&"), F.array_join(put, "")).otherwise(text)


def base32_of(digits: Column) -> Column:
    """``sha1:`` and a stored hexadecimal SHA-1 in base 32, as archives write it."""
    groups = [F.conv(F.substring(digits, 1 + 5 * g, 5), 16, 10).cast("int") for g in range(8)]
    letters = [F.substring(F.lit(BASE32), F.shiftright(v, s).bitwiseAND(31) + 1, F.lit(1))
               for v in groups for s in (15, 10, 5, 0)]
    return F.concat(F.lit("sha1:"), *letters)


def record_id(*parts: Column) -> Column:
    """A stable ``<urn:uuid:...>`` from the parts."""
    h = F.md5(F.to_json(F.struct(*[p.cast("string").alias(f"p{i}") for i, p in enumerate(parts)]),
                        {"ignoreNullFields": "false"}))
    cut = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">"))


def responses(pages: DataFrame) -> DataFrame:
    """Response records of ``pages`` (page_id, url, html).

    A null html is an empty payload; a null url an empty target.  Repeated rows give
    repeated records with the same id.
    """
    html = F.coalesce("html", F.lit(""))
    head = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
                    F.octet_length(html).cast("string"), F.lit(CRLF + CRLF))
    return pages.select(
        "page_id", record_id(F.lit("response"), F.col("page_id"), F.col("url"), F.sha1(html)).alias("record_id"),
        F.coalesce("url", F.lit("")).alias("target_uri"), F.lit(DATE).alias("date"), head.alias("http_head"),
        html.alias("payload"))


def _spaced(text: Column) -> Column:
    return F.regexp_replace(text, r"[ \t\r\f\x0B]+", " ")


def stripped(html: Column) -> Column:
    """The text between the tags, blocks on lines of their own, references not yet decoded."""
    text = F.regexp_replace(html, DROPPED, "")
    return F.regexp_replace(F.regexp_replace(text, BLOCKS, "\n"), TAGS, "")


def collapsed(text: Column) -> Column:
    return F.btrim(F.regexp_replace(_spaced(text), r" ?\n[ \n]*", "\n"), F.lit(" \n"))


def derive(records: DataFrame) -> DataFrame:
    """Metadata and conversion records of response records, two rows for each.

    Other columns of the responses lead the rows.  An empty payload gives a conversion
    record with an empty block.  Both records name the response, and keep its headers
    (``source_headers``, without the status line) and the digest of its payload.
    """
    own = [c for c in records.columns if c not in
           ("record_id", "target_uri", "date", "http_head", "payload")]
    # Step by step: what a later step reads several times is computed once, before the rows double.
    read = records.withColumns({
        "_sha": F.sha1("payload"), "text": stripped(F.col("payload")),
        "title": F.regexp_extract("payload", TITLE, 1), "payload_length": F.octet_length("payload"),
        "head_line": F.split_part("http_head", F.lit(CRLF), F.lit(1))})
    read = read.withColumns({
        "text": collapsed(decoded(F.col("text"))),
        "title": F.btrim(F.regexp_replace(decoded(F.col("title")), r"[ \t\r\n\f\x0B]+", " ")),
        "source_headers": F.substring_index(F.substr("http_head", F.length("head_line") + 3), CRLF + CRLF, 1),
        "source_digest": base32_of(F.col("_sha"))})
    fields = [("title", F.col("title")), ("http-status", F.col("head_line")), ("payload-digest", F.col("source_digest")),
              ("payload-length", F.col("payload_length")), ("text-length", F.length("text"))]
    about = F.concat(*[F.concat(F.lit(f"{k}: "), v.cast("string"), F.lit(CRLF)) for k, v in fields],
                     F.regexp_replace("source_headers", "(?m)^", "source-"), F.lit(CRLF))
    read = read.withColumn("_about", about).withColumns({"_about_sha": F.sha1("_about"), "_text_sha": F.sha1("text")})

    def record(kind: str, content_type: str, block: str, sha: str) -> Column:
        return F.struct(F.lit(kind).alias("record_type"), F.lit(content_type).alias("content_type"),
                        F.col(block).alias("block"), F.col(sha).alias("sha"))

    both = read.select(*own, F.col("record_id").alias("refers_to"), "target_uri", "date", "source_digest", "source_headers", F.explode(
        F.array(record("metadata", "application/warc-fields", "_about", "_about_sha"),
                record("conversion", "text/plain; charset=utf-8", "text", "_text_sha"))).alias("_r"))
    return both.select(
        *own, "_r.record_type", record_id(F.col("_r.record_type"), F.col("refers_to")).alias("record_id"), "refers_to",
        "target_uri", "date", "_r.content_type", base32_of(F.col("_r.sha")).alias("block_digest"), "source_digest",
        "source_headers", F.octet_length("_r.block").cast("bigint").alias("content_length"), "_r.block")


def serialized(records: DataFrame) -> DataFrame:
    """One column ``value``: each derived record in archive form, without its final blank lines.

    The response's headers and payload digest stand in ``X-Source-`` lines.
    """
    lines = [("WARC-Type", "record_type"), ("WARC-Record-ID", "record_id"), ("WARC-Refers-To", "refers_to"),
             ("WARC-Target-URI", "target_uri"), ("WARC-Date", "date"), ("WARC-Block-Digest", "block_digest"),
             ("X-Source-Payload-Digest", "source_digest"), ("Content-Type", "content_type"), ("Content-Length", "content_length")]
    head = F.concat(F.lit(f"WARC/1.0{CRLF}"), *[
        F.concat(F.lit(f"{name}: "), F.col(c).cast("string"), F.lit(CRLF)) for name, c in lines])
    source = F.when(F.col("source_headers") == "", F.lit("")).otherwise(
        F.concat(F.regexp_replace("source_headers", "(?m)^", "X-Source-"), F.lit(CRLF)))
    return records.select(F.concat(head, source, F.lit(CRLF), F.col("block")).alias("value"))


def _member(record: bytes) -> bytes:
    """A record as gzip members without the zero byte that ends them.

    The last byte is the highest of the record's length, zero below 16 MB; a longer record is
    followed by an empty member, whose length is 0.
    """
    out = gzip.compress(record, mtime=0)
    return (out if out[-1] == 0 else out + gzip.compress(b"", mtime=0))[:-1]


def write_archive(records: DataFrame, path: str) -> None:
    """Archive files, one for each task, each record a gzip member of its own.

    The line separator of the text sink is the zero byte that ends every member, so Spark's
    committer writes whole archives and a repeated task leaves nothing behind.
    """
    def run(batches):
        for batch in batches:
            raw = batch.column(0).cast(pa.binary()).to_pylist()
            yield pa.RecordBatch.from_arrays([pa.array([_member(r + (CRLF + CRLF).encode()) for r in raw], pa.binary())], ["value"])

    members = serialized(records).mapInArrow(run, "value binary")
    members.select(F.col("value").cast("string").alias("value")).write.option("lineSep", "\0").text(path)
    # The text sink names files by its own codec only; the committed ones get the ending of what they hold.
    spark = records.sparkSession
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    for found in files.listStatus(folder):
        name = found.getPath().getName()
        if name.startswith("part-") and name.endswith(".txt"):
            files.rename(found.getPath(), spark._jvm.org.apache.hadoop.fs.Path(folder, f"{name[:-4]}.warc.gz"))


def derivatives(pages: DataFrame) -> DataFrame:
    """The derived records of all pages, their blocks given by digest and length."""
    return derive(responses(pages)).drop("block", "source_headers")
