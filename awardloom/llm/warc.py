"""WARC derivatives: a metadata and a plain-text conversion record for every response record.

A derived record names the response it was made from (WARC-Refers-To, with its target URI and date); the
metadata record's block lists the response's own WARC and HTTP headers and digests, the title and the
links. Digests are SHA-256, identifiers are derived from the response's. All of it is column expressions.

A WARC file is records of the form header, empty line, block, two line ends, so files are written by
Spark's text writer with that ending as the line separator, and recover from lost tasks as any table does.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import prepare

CRLF = "\r\n"
#: Elements whose content is no text, and elements that end a line (HTML's own; fixed values).
HIDDEN = ("script", "style", "noscript", "template", "svg")
BREAKS = (
    "address article aside blockquote body br dd div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html "
    "li main nav ol option p pre section table tbody td tfoot th thead title tr ul"
).split()
#: Named character references that are resolved (fixed values); numbered ones follow a rule.
NAMES = {
    "amp": "&", "lt": "<", "gt": ">", "quot": '"', "apos": "'", "nbsp": " ", "copy": "©", "reg": "®", "middot": "·", "bull": "•", "hellip": "…", "ndash": "–",
    "mdash": "—", "lsquo": "‘", "rsquo": "’", "ldquo": "“", "rdquo": "”", "laquo": "«", "raquo": "»", "euro": "€", "sect": "§", "deg": "°", "times": "×",
}
#: Longest name or number of a reference.
LONGEST = 8
UNSEEN = "(?is)<(?:!--.*?(?:-->|\\z)|" + "|".join(f"{e}\\b[^>]*>.*?(?:</{e}[^>]*>|\\z)" for e in HIDDEN) + ")"
BREAK = "(?i)</?(?:" + "|".join(BREAKS) + ")\\b[^>]*>"
TAG = "<[a-zA-Z/!?][^>]*(?:>|\\z)"
BLANKS, LINES = "[ \\t\\r\\f\\x{00A0}]+", " ?\\n[ \\n]*"
TITLE = "(?is)<title\\b[^>]*>(.*?)</title"
LINK = "(?is)<a\\b[^>]*?[ \\t\\r\\n]href[ \\t\\r\\n]*=[ \\t\\r\\n]*(\"[^\"]*\"|'[^']*'|[^ \\t\\r\\n>\"']+)"


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once a row, however often it is used."""
    return F.transform(F.array(value), use)[0]


def referred(name: Column) -> Column:
    """The character that a reference's name or number stands for, or null."""
    decimal, hexadecimal = name.rlike("^#[0-9]{1,7}$"), name.rlike("^#[xX][0-9a-fA-F]{1,6}$")
    code = F.when(decimal, F.substring(name, 2, 7).cast("int")).when(hexadecimal, F.conv(F.substring(name, 3, 6), 16, 10).cast("int"))
    char = lambda n: F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32")
    number = bound(code, lambda n: F.when(n.between(1, 0xD7FF) | n.between(0xE000, 0x10FFFF), char(n)))
    known = F.create_map(*[F.lit(x) for pair in NAMES.items() for x in pair])
    return F.when(name.startswith("#"), number).otherwise(F.try_element_at(known, name))


def resolved(text: Column) -> Column:
    """Character references replaced, each once: what a replaced one forms with the text after it is no reference."""

    def one(piece: Column, place: Column) -> Column:
        end = F.locate(";", piece)
        char = F.when(end.between(2, LONGEST + 1), referred(F.substring(piece, F.lit(1), end - 1)))
        rest = F.substring(piece, end + 1, F.length(piece))
        return F.when(place == 0, piece).otherwise(bound(char, lambda c: F.when(c.isNull(), F.concat(F.lit("&"), piece)).otherwise(F.concat(c, rest))))

    return bound(text, lambda t: F.when(t.contains("&"), F.array_join(F.transform(F.split(t, "&"), one), "")).otherwise(t))


def visible(html: Column) -> Column:
    """The page without comments and elements whose content is no text."""
    return F.regexp_replace(html, UNSEEN, "")


def one_line(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, "[ \\t\\r\\n\\f\\x{00A0}]+", " "))


def plain_text(seen: Column) -> Column:
    """Text of what is visible: one line a block element, blanks collapsed, references resolved."""
    text = F.regexp_replace(F.regexp_replace(F.replace(seen, F.lit("\n"), F.lit(" ")), BREAK, "\n"), TAG, "")
    text = F.regexp_replace(resolved(text), BLANKS, " ")
    return F.btrim(F.regexp_replace(text, LINES, "\n"), F.lit(" \n"))


def title(html: Column) -> Column:
    return one_line(resolved(F.regexp_extract(html, TITLE, 1)))


def links(seen: Column, base: Column) -> Column:
    """Targets of visible anchors in order, resolved against the page's address (dot segments stay)."""
    quoted = F.regexp_extract_all(seen, F.lit(LINK), F.lit(1))
    found = F.transform(quoted, lambda raw: F.trim(resolved(F.regexp_replace(raw, "^[\"']|[\"']\\z", ""))))
    part = lambda pattern, name: F.regexp_extract(base, pattern, 1).alias(name)
    parts = F.struct(
        part("^([a-zA-Z][a-zA-Z0-9+.-]*:)", "scheme"), part("^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)", "host"), part("^([^?#]*/)", "folder"),
        part("^([^?#]*)", "page"), part("^([^#]*)", "bare"),
    )

    def one(ref: Column, at: Column) -> Column:
        return (
            F.when(ref.rlike("^[a-zA-Z][a-zA-Z0-9+.-]*:"), ref)
            .when(ref.startswith("//"), F.concat(at["scheme"], ref))
            .when(ref.startswith("/"), F.concat(at["host"], ref))
            .when(ref.startswith("?") | (ref == ""), F.concat(at["page"], ref))
            .when(ref.startswith("#"), F.concat(at["bare"], ref))
            .otherwise(F.concat(F.when(F.length(at["folder"]) > F.length(at["host"]), at["folder"]).otherwise(F.concat(at["host"], F.lit("/"))), ref))
        )

    return bound(parts, lambda at: F.transform(found, lambda ref: one(ref, at)))


def record_id(seed: Column) -> Column:
    return F.regexp_replace(F.md5(seed), "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "<urn:uuid:$1-$2-$3-$4-$5>")


def digest(text: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(text, 256))


def responses(pages: DataFrame, date: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Response records of fetched pages: page_id, record_id, target_uri, date, http_headers, payload, payload_digest.

    A null address or page is an empty one. The identifier is derived from page id, address and payload.
    """
    url, html = (F.coalesce(F.col(c), F.lit("")) for c in (url_col, html_col))
    base = pages.select(F.col(id_col).alias("page_id"), url.alias("target_uri"), html.alias("payload"))
    head = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=UTF-8{CRLF}Content-Length: "), F.octet_length("payload").cast("string"))
    seed = F.concat_ws(" ", F.lit("response"), F.coalesce(F.col("page_id").cast("string"), F.lit("")), "target_uri", F.md5("payload"))
    return base.select(
        "page_id", record_id(seed).alias("record_id"), "target_uri", F.lit(date).alias("date"), head.alias("http_headers"), "payload",
        digest(F.col("payload")).alias("payload_digest"),
    )


def derive(source: DataFrame) -> DataFrame:
    """Two rows a response: warc_type, record_id, refers_to, target_uri, content_type, content_length, block_digest,
    source_digest, header, block, and the response's page_id.

    No row moves. Repeated responses give repeated records; an empty payload gives an empty conversion block.
    """
    body = bound(visible(F.col("payload")), lambda seen: F.struct(plain_text(seen).alias("text"), links(seen, F.col("target_uri")).alias("links")))
    made = source.select("*", title(F.col("payload")).alias("title"), body.alias("body")).select("*", "body.text", "body.links")
    fields = lambda *pairs: F.concat_ws(CRLF, *[F.concat(F.lit(f"{k}: "), v) for k, v in pairs])
    headers = F.transform(F.split("http_headers", CRLF), lambda line: F.concat(F.lit("source-http: "), line))
    out = F.transform("links", lambda to: F.concat(F.lit("outlink: "), to))
    described = fields(
        ("source-record-id", F.col("record_id")), ("source-target-uri", F.col("target_uri")), ("source-date", F.col("date")), ("source-payload-digest", F.col("payload_digest")),
    )
    metadata = F.concat(F.concat_ws(CRLF, described, headers, F.concat(F.lit("title: "), F.col("title")), out), F.lit(CRLF))
    kinds = (("metadata", "application/warc-fields", metadata), ("conversion", "text/plain; charset=UTF-8", F.col("text")))
    both = F.array(*[F.struct(F.lit(t).alias("warc_type"), F.lit(c).alias("content_type"), b.alias("block")) for t, c, b in kinds])
    rows = made.select("page_id", F.col("record_id").alias("refers_to"), "target_uri", "date", F.col("payload_digest").alias("source_digest"), F.explode(both).alias("r"))
    rows = rows.select("page_id", "r.warc_type", record_id(F.concat_ws(" ", "r.warc_type", "refers_to")).alias("record_id"), "refers_to", "target_uri", "date", "r.content_type", "source_digest", F.col("r.block").alias("block"))
    rows = rows.withColumn("content_length", F.octet_length("block").cast("long")).withColumn("block_digest", digest(F.col("block")))
    header = F.concat(
        F.lit(f"WARC/1.1{CRLF}"),
        fields(
            ("WARC-Type", F.col("warc_type")), ("WARC-Record-ID", F.col("record_id")), ("WARC-Date", F.col("date")), ("WARC-Target-URI", F.col("target_uri")),
            ("WARC-Refers-To", F.col("refers_to")), ("WARC-Refers-To-Target-URI", F.col("target_uri")), ("WARC-Refers-To-Date", F.col("date")),
            ("WARC-Source-Payload-Digest", F.col("source_digest")), ("WARC-Block-Digest", F.col("block_digest")), ("Content-Type", F.col("content_type")),
            ("Content-Length", F.col("content_length").cast("string")),
        ),
    )
    return rows.select("page_id", "warc_type", "record_id", "refers_to", "target_uri", "content_type", "content_length", "block_digest", "source_digest", header.alias("header"), "block")


def write_warc(records: DataFrame, path: str) -> None:
    """Write (header, block) records as WARC files, a folder of one file a task."""
    text = F.concat(F.col("header"), F.lit(CRLF * 2), F.col("block"))
    records.select(text.alias("value")).write.option("lineSep", CRLF * 2).text(path)


def parse_records(raw: bytes) -> Iterator[tuple[str, bytes]]:
    """(header, block) of the records of a WARC file, each block as long as its header says."""
    at = 0
    while at < len(raw):
        end = raw.index(b"\r\n\r\n", at)
        header = raw[at:end].decode("utf-8", "replace")
        size = next(int(v) for k, _, v in (line.partition(":") for line in header.split(CRLF)) if k.lower() == "content-length")
        yield header, raw[end + 4 : end + 4 + size]
        at = end + 4 + size + 4


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """header, block of all records under a path; a file (2 GB at most) is read by one task."""
    prepare(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for raw in batch.column(0):
                rows = list(parse_records(raw.as_py()))
                yield pa.record_batch([pa.array([h for h, _ in rows], pa.string()), pa.array([b for _, b in rows], pa.binary())], names=["header", "block"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    return files.mapInArrow(run, "header string, block binary")
