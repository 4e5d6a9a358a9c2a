"""WARC derivatives (DataFrame functions only).

From each response record come a metadata record (status, response headers, digests of
the source) and, for text, a conversion record with the plain text. Both refer to the
response by its identifier. Identifiers of derivatives are made from the response's,
so a repeated run, or a task run again, gives the same records.
"""

from __future__ import annotations

from html.entities import name2codepoint

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CRLF = "\r\n"
RECORD_END = CRLF + CRLF
# Elements whose content is not text, and those that start a line.
HIDDEN = "script|style|noscript|template"
LINES = (
    "address|article|aside|blockquote|br|dd|div|dl|dt|figcaption|figure|footer|form|h[1-6]|"
    "header|hr|li|main|nav|ol|p|pre|section|table|td|th|title|tr|ul"
)
BLANK = r"[ \t\r\n\f]"
# The rest of a tag: what is quoted after an equals sign may hold its end.
ATTRIBUTES = rf"""[^>=]*(?:=(?:{BLANK}*"[^"]*"|{BLANK}*'[^']*')?[^>=]*)*"""
# In this order; each is replaced everywhere. A hidden element ends at its own end tag.
STEPS = [
    (
        "(?is)" + "|".join(
            rf"<{name}(?:[/ \t\r\n\f]{ATTRIBUTES})?>.*?</{name}{BLANK}*>"
            for name in HIDDEN.split("|")
        ),
        " ",
    ),
    (r"(?s)<!--.*?-->", " "),
    (rf"(?is)</?({LINES})([/ \t\r\n\f]{ATTRIBUTES})?>", "\n"),
    (rf"(?s)</?[a-zA-Z!?]{ATTRIBUTES}>", ""),
    (r"[ \t\r\f\x0B]+", " "),
    (r" ?\n[ \n]*", "\n"),
    (r"\A[ \n]+|[ \n]+\z", ""),
]
# Decoded after the tags are gone, each once. A non-breaking space becomes a blank.
ENTITY = r"^(#[0-9]{1,8}|#[xX][0-9a-fA-F]{1,6}|[a-zA-Z][a-zA-Z0-9]{1,30});"
NAMES = {name: chr(code) for name, code in sorted(name2codepoint.items())} | {
    "apos": "'",
    "nbsp": " ",
}
REPLACEMENT = "\uFFFD"
COMMON = ("amp", "nbsp", "lt", "gt", "quot")  # looked up before the others
RECORD_COLUMNS = [
    "warc_type",
    "record_id",
    "refers_to",
    "target_uri",
    "date",
    "content_type",
    "content_length",
    "block_digest",
    "payload_digest",
    "block",
]


def plain_text(html: Column) -> Column:
    """Text of HTML: hidden elements and comments go, block tags become line ends.

    Numeric entities and those of HTML 4 by name are decoded; other names stay as they
    are, and a number that is no character becomes U+FFFD. A hidden element without its
    end tag, and a tag without its end, are text. Texts are taken whole.
    """
    for pattern, into in STEPS[:-1]:
        html = F.regexp_replace(html, pattern, into)
    # The last step; its pattern would be tried at every blank.
    html = F.trim(html, F.lit(" \n"))
    # The text has one use here: Spark would compute it anew for each. The name of each
    # entity is looked for once, then the number in it.
    parts = F.transform(
        F.split(html, "&"),
        lambda p, i: F.struct(
            p.alias("p"), i.alias("i"), F.regexp_extract(p, ENTITY, 1).alias("name")
        ),
    )
    numbered = F.transform(parts, lambda x: F.struct(x.alias("x"), _number(x["name"]).alias("n")))
    return F.array_join(
        F.transform(numbered, lambda y: F.when(y.x.i == 0, y.x.p).otherwise(_decoded(y.x, y.n))), ""
    )


def _number(name: Column) -> Column:
    """The number of a numeric entity; NULL for a name."""
    digits = F.when(
        F.lower(F.substring(name, 1, 2)) == "#x", F.conv(F.substring(name, 3, 6), 16, 10)
    ).otherwise(F.substring(name, 2, 8))
    return F.when(F.startswith(name, F.lit("#")), digits.cast("long"))


def _decoded(x: Column, n: Column) -> Column:
    """The piece ``p``, which an ampersand came before, with its entity as a character."""
    is_character = n.between(1, 0x10FFFF) & ~n.between(0xD800, 0xDFFF)
    character = F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32")
    common = [F.when(x["name"] == name, F.lit(NAMES[name])) for name in COMMON]
    named = F.create_map(*[F.lit(y) for pair in NAMES.items() for y in pair])
    into = (
        F.when(n.isNull(), F.coalesce(*common, named[x["name"]]))
        .when(n == 0xA0, " ")
        .when(is_character, character)
        .otherwise(REPLACEMENT)
    )
    rest = F.substring(x.p, F.length(x["name"]) + 2, F.length(x.p))
    kept = F.concat(F.lit("&"), x.p)
    return F.when(x["name"] == "", kept).otherwise(F.coalesce(F.concat(into, rest), kept))


def urn(*parts: Column) -> Column:
    """A version 8 UUID from the digest of ``parts``."""
    h = F.sha2(F.concat_ws(" ", *parts), 256)
    return F.concat(
        F.lit("urn:uuid:"),
        *[F.substring(h, 1, 8), F.lit("-"), F.substring(h, 9, 4), F.lit("-8")],
        *[F.substring(h, 13, 3), F.lit("-a"), F.substring(h, 16, 3), F.lit("-")],
        F.substring(h, 19, 12),
    )


def digest(text: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(text, 256))


def responses(pages: DataFrame, date: str) -> DataFrame:
    """Response records of ``pages`` (page_id, url, html): record_id, target_uri, date,
    block. NULL html is an empty body; a NULL url or page_id counts as empty."""
    html = F.coalesce("html", F.lit(""))
    head = F.concat(
        F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
        F.octet_length(html),
    )
    uri = F.coalesce("url", F.lit(""))
    number = F.coalesce(F.col("page_id").cast("string"), F.lit(""))
    return pages.select(
        urn(F.lit("response"), number, uri).alias("record_id"),
        uri.alias("target_uri"),
        F.lit(date).alias("date"),
        F.concat(head, F.lit(RECORD_END), html).alias("block"),
    )


def derivatives(records: DataFrame) -> DataFrame:
    """Metadata and conversion records of response ``records`` (record_id, target_uri,
    date, block): RECORD_COLUMNS, a metadata record each and a conversion record for
    HTML and plain text.

    ``block`` is the HTTP response: status line, headers, an empty line, the body;
    without an empty line all of it is the body. NULL fields count as empty. Equal
    records give equal derivatives; other columns are ignored; an empty table gives
    none. Rows are not shuffled.
    """
    block = F.coalesce("block", F.lit(""))
    cut = F.instr(block, RECORD_END)
    source = (
        records.select(
            *[F.coalesce(c, F.lit("")).alias(c) for c in ("record_id", "target_uri", "date")],
            block.alias("source"),
            F.when(cut > 0, F.substring(block, F.lit(1), cut - 1)).otherwise("").alias("head"),
            F.when(cut > 0, F.substring(block, cut + 4, F.length(block)))
            .otherwise(block)
            .alias("body"),
        )
        .withColumns(
            {
                "status": F.regexp_extract("head", r"^([^\r\n]*)", 1),
                "fields": F.regexp_extract("head", r"(?s)^[^\r\n]*\r\n(.*)$", 1),
                "type": F.lower(F.regexp_extract("head", r"(?i)\ncontent-type:[ \t]*([^;\r\n]*)", 1)),
                "conversion_id": urn(F.lit("conversion"), F.col("record_id")),
            }
        )
    )
    html = F.col("type").isin("text/html", "application/xhtml+xml", "")
    field = CRLF + "http-header: "
    metadata = F.concat(
        F.lit("http-status: "),
        "status",
        F.when(
            F.col("fields") != "",
            F.concat(F.lit(field), F.replace("fields", F.lit(CRLF), F.lit(field))),
        ).otherwise(""),
        F.lit(f"{CRLF}source-block-digest: "),
        digest(F.col("source")),
        F.lit(f"{CRLF}source-payload-digest: "),
        digest(F.col("body")),
        F.when(
            html | (F.col("type") == "text/plain"),
            F.concat(F.lit(f"{CRLF}conversion: <"), "conversion_id", F.lit(">")),
        ).otherwise(""),
        F.lit(CRLF),
    )
    both = source.select(
        "target_uri",
        "date",
        F.col("record_id").alias("refers_to"),
        F.explode(
            F.array(
                F.struct(
                    F.lit("metadata").alias("warc_type"),
                    urn(F.lit("metadata"), F.col("record_id")).alias("record_id"),
                    F.lit("application/warc-fields").alias("content_type"),
                    metadata.alias("block"),
                ),
                F.struct(
                    F.lit("conversion").alias("warc_type"),
                    F.col("conversion_id").alias("record_id"),
                    F.lit("text/plain; charset=utf-8").alias("content_type"),
                    F.when(html, plain_text(F.col("body")))
                    .when(F.col("type") == "text/plain", F.col("body"))
                    .alias("block"),
                ),
            )
        ).alias("made"),
        digest(F.col("body")).alias("source_digest"),
    ).where("made.block is not null")
    return both.select(
        "made.warc_type",
        "made.record_id",
        "refers_to",
        "target_uri",
        "date",
        "made.content_type",
        F.octet_length("made.block").cast("long").alias("content_length"),
        digest(F.col("made.block")).alias("block_digest"),
        F.col("source_digest").alias("payload_digest"),
        "made.block",
    )


def warc_text(records: DataFrame) -> DataFrame:
    """``value``: each record as WARC text, without the two line ends that follow it."""

    def bracketed(column: str) -> Column:
        return F.concat(F.lit("<"), column, F.lit(">"))

    lines = {
        "WARC-Type": F.col("warc_type"),
        "WARC-Record-ID": bracketed("record_id"),
        "WARC-Refers-To": bracketed("refers_to"),
        "WARC-Target-URI": F.col("target_uri"),
        "WARC-Date": F.col("date"),
        "WARC-Block-Digest": F.col("block_digest"),
        "WARC-Source-Payload-Digest": F.col("payload_digest"),
        "Content-Type": F.col("content_type"),
        "Content-Length": F.col("content_length").cast("string"),
    }
    head = [F.concat(F.lit(f"{name}: "), value) for name, value in lines.items()]
    return records.select(
        F.concat(
            F.lit(f"WARC/1.1{CRLF}"), F.concat_ws(CRLF, *head), F.lit(RECORD_END), "block"
        ).alias("value")
    )


def write_warc(records: DataFrame, path: str, compression: str = "none") -> None:
    """WARC files below ``path``, one for each partition; Spark's text writer ends each
    record with two line ends."""
    warc_text(records).write.option("lineSep", RECORD_END).option("compression", compression).text(
        path
    )
