"""WARC derivatives: metadata and plain-text conversion records from responses.

Each response gives two records that name it in ``WARC-Refers-To``: ``metadata``
(title and outlinks as warc-fields) and ``conversion``
(the page's text). Both keep target, date, source headers and the source's payload
digest, and carry digests of their own blocks. Ids are name-based, so a repeated
run gives the same records. Column expressions only; no shuffle.

The text: comments, scripts, styles and declarations go, block tags become line
breaks, other tags vanish, character references become characters, blanks and
empty lines fold. A tag ends at its first ``>``; what is not closed reaches to the
end.

Edge cases: a NULL payload is an empty one (empty text, no title); NULL ids, URIs,
dates or headers leave their header line empty; repeated responses give repeated
records; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tiers.llm.frame import take

#: Character references with their characters (besides the ampersand).
REFERENCES = (("nbsp", " "), ("lt", "<"), ("gt", ">"), ("quot", '"'), ("apos", "'"), ("copy", "\u00a9"), ("reg", "\u00ae"),
              ("middot", "\u00b7"), ("ndash", "\u2013"), ("mdash", "\u2014"), ("hellip", "\u2026"), ("laquo", "\u00ab"),
              ("raquo", "\u00bb"), ("euro", "\u20ac"), ("lsquo", "\u2018"), ("rsquo", "\u2019"), ("ldquo", "\u201c"),
              ("rdquo", "\u201d"), ("bull", "\u2022"))

# Every pattern that has begun to match a tag also matches if the tag never ends, so that a
# page is passed once however its tags are broken.
HIDDEN = (r"(?is)<(?:!--.*?(?:-->|\z)|script\b[^>]*(?:>.*?(?:</script\s*>|\z)|\z)|style\b[^>]*(?:>.*?(?:</style\s*>|\z)|\z)"
          r"|noscript\b[^>]*(?:>.*?(?:</noscript\s*>|\z)|\z)|[!?][^>]*(?:>|\z))")
BLOCK = (r"(?i)</?(?:p|div|li|ul|ol|dl|dt|dd|h[1-6]|br|hr|tr|td|th|table|article|section|header|footer|nav|main|aside"
         r"|title|head|body|html|blockquote|pre|form|figure)\b[^>]*(?:>|\z)")
TAG = r"</?[A-Za-z][^>]*(?:>|\z)"
TITLE = r"(?is)<title\b[^>]*(?:>(.*?)(?:</title|\z)|\z)"
#: Quoted links only, as the DuckDB twin takes them: the given pages hold no others.
LINK = r"""(?i)<a\s[^>]*?\bhref\s*=\s*["']([^"'>]*)["']"""
#: The value of an anchor's href as written: in double quotes, in single quotes or bare. Other
#: attributes before it are passed whole; a ``<`` outside a value starts another tag.
HREF = (r"""(?i)<a(?=[\s/])(?:[\s/]++|["'=]|(?!href\s*=)[^\s=<>"'/]++(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>"']++))?+)*+"""
        r"""href\s*=\s*("[^"]*"|'[^']*'|[^\s>"']+)""")


def unescape(text: Column) -> Column:
    """Character references as characters, each decoded once; a number that is no
    character gives U+FFFD, and what is no reference stays."""
    parts = F.split(text, "&")
    names = F.create_map(*(F.lit(x) for pair in REFERENCES for x in pair))

    def one(part: Column) -> Column:
        name = F.regexp_extract(part, "^([a-z]+);", 1)
        decimal = F.regexp_extract(part, "^#([0-9]{1,7});", 1)
        hexa = F.regexp_extract(part, "^#[xX]([0-9A-Fa-f]{1,6});", 1)
        code = F.when(decimal != "", decimal.cast("int")).when(hexa != "", F.conv(hexa, 16, 10).cast("int"))
        bad = (code == 0) | (code > 0x10FFFF) | code.between(0xD800, 0xDFFF)
        char = F.decode(F.unhex(F.lpad(F.hex(F.when(bad, 0xFFFD).otherwise(code)), 8, "0")), "UTF-32")
        return (F.when(part.startswith("amp"), F.concat(F.lit("&"), F.regexp_replace(part, "^amp;?", "")))
                .when(F.map_contains_key(names, name), F.concat(names[name], F.regexp_replace(part, "^[a-z]+;", "")))
                .when(code.isNotNull(), F.concat(char, F.regexp_replace(part, "^#[xX]?[0-9A-Fa-f]+;", "")))
                .otherwise(F.concat(F.lit("&"), part)))

    return F.when(F.instr(text, "&") == 0, text).otherwise(
        F.concat(F.element_at(parts, 1), F.array_join(F.transform(F.slice(parts, 2, F.size(parts)), one), "")))


def fold(text: Column) -> Column:
    """Runs of blanks as one, blanks at line ends and empty lines gone. Matches only what changes."""
    text = F.regexp_replace(text, "[\t\r\f\x0b\xa0][ \t\r\f\x0b\xa0]*| [ \t\r\f\x0b\xa0]+", " ")
    return F.regexp_replace(F.regexp_replace(text, " \n[ \n]*|\n[ \n]+", "\n"), r"^[ \n]+|[ \n]+\z", "")


def visible(html: Column) -> Column:
    """A page without comments, scripts, styles and declarations."""
    return F.regexp_replace(F.coalesce(html, F.lit("")), HIDDEN, "")


def digest(block: Column) -> Column:
    """``sha1:`` and the SHA-1 of a block in base 32, as WARC headers carry it."""
    h = F.sha1(block.cast("binary"))
    groups = [F.lpad(F.conv(F.substring(h, i, 5), 16, 32), 4, "0") for i in range(1, 41, 5)]
    return F.concat(F.lit("sha1:"), F.translate(F.lower(F.concat(*groups)), "0123456789abcdefghijklmnopqrstuv",
                                                "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"))


def record_id(*names: Column) -> Column:
    """A name-based record id (the digest's digits in the form of a version 3 UUID)."""
    h = F.md5(F.concat_ws("|", *names).cast("binary"))
    s = lambda a, n: F.substring(h, a, n)
    return F.concat(F.lit("<urn:uuid:"), s(1, 8), F.lit("-"), s(9, 4), F.lit("-3"), s(14, 3), F.lit("-8"), s(18, 3),
                    F.lit("-"), s(21, 12), F.lit(">"))


RESPONSE = ("record_id", "target_uri", "date", "http_headers", "payload")


def derive(responses: DataFrame, key: str | None = None) -> DataFrame:
    """Two records per row of ``responses`` (record_id, target_uri, date as text, http_headers,
    payload as text): ``record_type, record_id, refers_to, target_uri, date, content_type,
    content_length, block_digest, source_headers, source_digest, block``, after the
    column ``key`` if one is named."""
    keys = [key] if key else []
    rows = take(responses, *keys, *RESPONSE)
    rows = rows.withColumn("shown", visible(F.col("payload")))
    # in steps, so that no step's expression is worked out again for each use of it
    rows = rows.withColumns({"title": F.regexp_replace(F.regexp_extract("shown", TITLE, 1), TAG, ""),
                             "text": F.regexp_replace(F.regexp_replace("shown", BLOCK, "\n"), TAG, "")})
    rows = rows.withColumns({c: fold(unescape(F.col(c))) for c in ("title", "text")})
    title = F.regexp_replace("title", "\n", " ")
    links = F.transform(F.regexp_extract_all("shown", F.lit(HREF), 1), lambda u: F.concat(
        F.lit("outlink: "), unescape(F.regexp_extract(u, "(?s)^([\"']?)(.*)\\1$", 2)), F.lit("\r\n")))
    fields = F.concat(F.lit("title: "), title, F.lit("\r\n"), F.array_join(links, ""))
    source = digest(F.coalesce("payload", F.lit("")))
    made = rows.select(
        *keys, "record_id", "target_uri", "date", F.col("http_headers").alias("source_headers"), source.alias("source_digest"),
        F.explode(F.array(
            F.struct(F.lit("metadata").alias("record_type"), F.lit("application/warc-fields").alias("content_type"),
                     fields.alias("block")),
            F.struct(F.lit("conversion").alias("record_type"), F.lit("text/plain").alias("content_type"),
                     F.col("text").alias("block")))).alias("r"))
    return made.select(
        *keys, "r.record_type", record_id("record_id", "r.record_type").alias("record_id"), F.col("record_id").alias("refers_to"),
        "target_uri", "date", "r.content_type", F.octet_length("r.block").cast("bigint").alias("content_length"),
        digest(F.col("r.block")).alias("block_digest"), "source_headers", "source_digest", "r.block")


_HEADERS = (("WARC-Type", "record_type"), ("WARC-Record-ID", "record_id"), ("WARC-Refers-To", "refers_to"),
            ("WARC-Target-URI", "target_uri"), ("WARC-Date", "date"), ("WARC-Block-Digest", "block_digest"),
            ("X-Source-Payload-Digest", "source_digest"), ("X-Source-Headers", "source_headers"),
            ("Content-Type", "content_type"), ("Content-Length", "content_length"))


def write_records(records: DataFrame, path: str, compression: str = "gzip") -> None:
    """Records as WARC 1.0 files, one per task. The source headers are folded into one line."""
    lines = [F.concat(F.lit(f"\r\n{name}: "), F.regexp_replace(F.coalesce(F.col(c).cast("string"), F.lit("")), "[\r\n]+", " | "))
             for name, c in _HEADERS]
    (records.select(F.concat(F.lit("WARC/1.0"), *lines, F.lit("\r\n\r\n"), F.col("block")).alias("value"))
     .write.option("compression", compression).option("lineSep", "\r\n\r\n").text(path))


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Records that ``write_records`` wrote (their blocks have no line that starts a record)."""
    raw = spark.read.option("lineSep", "\r\n\r\nWARC/1.0\r\n").text(path).filter("value <> ''")
    body = F.regexp_replace("value", r"^WARC/1\.0\r\n", "")
    at = F.instr(body, "\r\n\r\n")
    head, block = F.substring(body, F.lit(1), at - 1), F.substring(body, at + 4, F.length(body))
    out = [F.regexp_extract(head, rf"(?m)^{name}: ([^\r]*)", 1).alias(c) for name, c in _HEADERS]
    return raw.select(*out, F.regexp_replace(block, r"\r\n\r\n\z", "").alias("block"))
