"""WARC derivatives: linked metadata and plain-text conversion records of HTTP responses.

Each response record gives one ``metadata`` record (its HTTP status and headers, title and
outlinks as warc-fields) and, when its content type is HTML or XHTML, one ``conversion`` record
with the plain text. Both carry WARC-Refers-To (the response's record id), its target URI and
date, the payload digest of the source, and digest and length of their own block. Record ids are
name-based, so a task that runs again gives the same records.

One response becomes an array of two records in its own row, so nothing is shuffled.

Defined cases: a NULL payload counts as empty and gives an empty conversion block; a NULL URI
or date leaves out its header line; a NULL header block counts as empty, so there is no
conversion. Repeated rows give equal records. Other columns are not passed on. An empty table
gives no records.
"""

from __future__ import annotations

from html.entities import html5

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CRLF = "\r\n"
# Elements without text for a reader, each to its end tag or the end of the page.
SKIPPED = "(?i)" + "|".join(
    rf"<{name}\b[^<]*+(?:<(?!/{name}\s*>)[^<]*+)*+(?:</{name}\s*>|\z)" for name in ("script", "style")
)
COMMENT = r"<!--[^-]*+(?:-(?!->)[^-]*+)*+(?:-->|\z)"
# To its end tag; where that is left out, over what may stand in a head: the rest is the body.
HEAD = (
    r"(?is)<head\b(?:[^<]*+(?:<(?!body\b|/head\s*>)[^<]*+)*+</head\s*>|[^>]*>(?:\s|<title\b[^>]*>.*?</title\s*>|"
    r"</?(?:meta|link|base|basefont|bgsound|noscript|noframes|template)\b[^>]*>)*+)"
)
BREAKS = (
    r"(?i)</?(?:p|div|li|ul|ol|h[1-6]|br|tr|table|td|th|article|section|nav|footer|header|"
    r"blockquote|pre|body)\b[^>]*>"
)
BLANKS = r"[ \t\x0B\f\r\x{A0}]+"
LINE_ENDS = r" \n[ \n]*|\n[ \n]+"  # one line end alone is what it should be
REFERENCE = r"^(?:#[0-9]+|#[xX][0-9a-fA-F]+|[A-Za-z][A-Za-z0-9]*)$"
OTHER = r"&(?=#|(?!amp;)[A-Za-z])"  # the start of a reference other than &amp;
USUAL = ("quot", "lt", "gt", "nbsp", "apos", "copy", "middot")  # looked up first
NAMED = {name.rstrip(";"): char for name, char in html5.items() if name.endswith(";")}
NAMED = {name: NAMED[name] for name in (*USUAL, *sorted(NAMED.keys() - set(USUAL)))}
# What HTML reads for the numbers 128 to 159.
HIGH = [bytes([n]).decode("cp1252", "ignore") or chr(n) for n in range(128, 160)]


def number_of(name: Column) -> Column:
    """The number of a numeric reference; a longer one than any character's is cut, and stays too large."""

    def digits(mark: str) -> Column:
        return F.concat(F.lit("0"), F.substring(F.regexp_replace(name, mark, ""), 1, 8))

    hexadecimal = name.rlike("^#[xX]")
    return F.when(hexadecimal, F.conv(digits("^#[xX]0*"), 16, 10)).otherwise(digits("^#0*|[^0-9]")).cast("long")


def decoded(text: Column) -> Column:
    """Character references that end with a semicolon, each read once; unknown names stay."""
    named = F.create_map(*(F.lit(x) for pair in NAMED.items() for x in pair))
    high = F.array(*(F.lit(x) for x in HIGH))

    def named_part(x: Column) -> Column:
        return F.struct(F.substring_index(x, ";", 1).alias("name"), x.alias("x"))

    def part(p: Column) -> Column:
        name, x = p["name"], p["x"]  # what stands before the first semicolon, and everything
        n = number_of(name)
        bad = (n == 0) | (n > 0x10FFFF) | n.between(0xD800, 0xDFFF)
        char = (
            F.when(~name.startswith("#"), F.try_element_at(named, name))
            .when(bad, F.lit("\ufffd"))
            .when(n.between(128, 159), F.get(high, (n - 128).cast("int")))
            .otherwise(F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32"))
        )
        is_name = (F.octet_length(name) < F.octet_length(x)) & name.rlike(REFERENCE)
        read = F.concat(char, ampersands(F.substring(x, F.length(name) + 2, F.length(x))))
        return F.coalesce(F.when(is_name, read), F.concat(F.lit("&"), ampersands(x)))

    def ampersands(x: Column) -> Column:
        return F.replace(x, F.lit("&amp;"), F.lit("&"))

    # By far the most references are &amp;, so the text is taken apart at the others only, and once.
    parts = F.transform(F.split(text, OTHER), named_part)
    read = F.transform(parts, lambda p, i: F.when(i == 0, ampersands(p["x"])).otherwise(part(p)))
    return F.when(F.contains(text, F.lit("&")), F.array_join(read, "")).otherwise(text)


def plain_text(html: Column) -> Column:
    """Text of a page: no comments, scripts or tags, a line per block, single spaces."""
    text = F.regexp_replace(html, COMMENT, "")
    text = F.regexp_replace(text, SKIPPED, "")
    text = F.regexp_replace(text, HEAD, "")
    text = F.regexp_replace(text, BREAKS, "\n")
    text = F.regexp_replace(text, r"</?[A-Za-z!?][^>]*>", "")
    text = decoded(text)
    text = F.regexp_replace(text, BLANKS, " ")
    text = F.regexp_replace(text, LINE_ENDS, "\n")
    return F.btrim(text, F.lit(" \n"))


def title_of(html: Column) -> Column:
    found = F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title", 1)
    return F.btrim(F.regexp_replace(found, r"\s+", " "), F.lit(" "))


def outlinks(html: Column) -> Column:
    pattern = r"""(?i)<a\s(?:[^>]*?[\s"'/])?href\s*=\s*("[^"]*"|'[^']*'|[^\s"'<>][^\s>]*)"""
    found = F.regexp_extract_all(html, F.lit(pattern), F.lit(1))
    return F.transform(found, lambda x: F.regexp_replace(x, r"""(?s)^(["'])(.*)\1$""", "$2"))


def name_uuid(*parts: Column) -> Column:
    """<urn:uuid:...> from a digest of the parts."""
    h = F.md5(F.concat_ws("\x1f", *(F.coalesce(p.cast("string"), F.lit("")) for p in parts)))
    pieces = [F.substring(h, at, n) for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *pieces), F.lit(">"))


def digest(block: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(block, 256))


def header(fields: list[tuple[str, Column]]) -> Column:
    """Named fields; a field whose value is NULL is left out."""
    lines = [F.concat(F.lit(f"{name}: "), value.cast("string")) for name, value in fields]
    return F.concat_ws(CRLF, F.lit("WARC/1.1"), *lines)


def pages_as_responses(pages: DataFrame, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Fetched pages (page_id, url, html) as response records."""
    body = F.coalesce(F.col("html"), F.lit(""))
    http = F.concat_ws(
        CRLF,
        F.lit("HTTP/1.1 200 OK"),
        F.lit("Content-Type: text/html; charset=utf-8"),
        F.concat(F.lit("Content-Length: "), F.octet_length(body).cast("string")),
    )
    return pages.select(
        F.col("page_id"),
        name_uuid(F.lit("response"), F.col("page_id"), F.col("url"), F.sha2(body, 256)).alias("record_id"),
        F.col("url").alias("target_uri"),
        F.lit(date).alias("warc_date"),
        http.alias("http_header"),
        body.alias("payload"),
        F.sha2(body, 256).alias("payload_sha256"),
    )


def derivatives(responses: DataFrame, key: str = "page_id") -> DataFrame:
    """Metadata and conversion records of responses.

    Input: ``key``, record_id, target_uri, warc_date, http_header, payload and, if it is known, the
    payload's digest as payload_sha256. Output: ``key``,
    warc_type, record_id, refers_to, target_uri, warc_date, content_type, content_length,
    block_digest, source_digest, warc_header, block.
    """
    payload = F.coalesce(F.col("payload"), F.lit(""))
    http = F.coalesce(F.col("http_header"), F.lit(""))
    lines = F.split(http, CRLF)
    named = F.slice(lines, 2, F.greatest(F.size(lines) - 1, F.lit(0)))
    status = F.regexp_extract(http, r"^HTTP/[0-9.]+ ([0-9]+)", 1)
    media = F.lower(F.regexp_extract(http, r"(?im)^content-type:[ \t]*([^;\s]+)", 1))
    fields = F.concat(
        F.array(
            F.concat(F.lit("http-status: "), status),
            F.concat(F.lit("title: "), title_of(payload)),
        ),
        F.transform(named, lambda x: F.concat(F.lit("http-header: "), x)),
        F.transform(outlinks(payload), lambda x: F.concat(F.lit("outlink: "), x, F.lit(" L a/@href"))),
    )
    metadata = F.concat(F.array_join(fields, CRLF), F.lit(CRLF))

    def record(kind: str, content_type: str, block: Column) -> Column:
        return F.struct(
            F.lit(kind).alias("warc_type"),
            F.lit(content_type).alias("content_type"),
            block.alias("block"),
        )

    known = "payload_sha256" in responses.columns
    source = F.concat(F.lit("sha256:"), F.col("payload_sha256")) if known else digest(payload)
    page = media.isin("text/html", "application/xhtml+xml")
    made = F.array(record("metadata", "application/warc-fields", metadata))
    text = F.array(record("conversion", "text/plain; charset=utf-8", plain_text(payload)))
    rows = responses.select(
        key,
        F.col("record_id").alias("refers_to"),
        "target_uri",
        "warc_date",
        source.alias("source_digest"),
        F.explode(F.when(page, F.concat(made, text)).otherwise(made)).alias("r"),
    ).select("*", "r.*").drop("r")
    rows = (
        rows.withColumn("record_id", name_uuid(F.col("warc_type"), F.col("refers_to")))
        .withColumn("content_length", F.octet_length("block").cast("long"))
        .withColumn("block_digest", digest(F.col("block")))
    )
    head = header(
        [
            ("WARC-Type", F.col("warc_type")),
            ("WARC-Record-ID", F.col("record_id")),
            ("WARC-Refers-To", F.col("refers_to")),
            ("WARC-Target-URI", F.col("target_uri")),
            ("WARC-Date", F.col("warc_date")),
            ("WARC-Source-Payload-Digest", F.col("source_digest")),
            ("WARC-Block-Digest", F.col("block_digest")),
            ("Content-Type", F.col("content_type")),
            ("Content-Length", F.col("content_length")),
        ]
    )
    return rows.withColumn("warc_header", head).select(
        key,
        "warc_type",
        "record_id",
        "refers_to",
        "target_uri",
        "warc_date",
        "content_type",
        "content_length",
        "block_digest",
        "source_digest",
        "warc_header",
        "block",
    )


def write_warc(records: DataFrame, path: str) -> None:
    """Records as WARC text files, gzipped; every record ends with two line breaks."""
    whole = F.concat(F.col("warc_header"), F.lit(CRLF * 2), F.col("block"), F.lit(CRLF))
    records.select(whole.alias("value")).write.option("lineSep", CRLF).option(
        "compression", "gzip"
    ).text(path)
