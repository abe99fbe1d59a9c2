"""WARC archives: write captures, read records back, assemble transactions.

A capture is a response (or a revisit of an earlier response with the same
payload), the request that led to it and metadata about it, each a WARC/1.1
record. Request and metadata name the response in ``WARC-Concurrent-To``;
assembly joins records along these identifiers into one nested row per capture.

Archives are gzip files written by Spark's text writer: every task writes a
whole file or none, to any store that Spark writes. A record ends with two line
ends, so that is the writer's line separator. The reader splits at the version line
``WARC/1.1`` that begins a record, which keeps memory to one record whatever the
size of a file. No payload may hold that line, alone or with the line end behind
it: one that does is sent in chunked transfer coding with a chunk border inside
each occurrence, and decoded again; in urls its slash becomes a percent code.
``Content-Length`` cuts the block of a record. In archives from elsewhere a
payload may hold the separator; the record's block is then shorter than stated
and ``complete`` is false.

Which of equal payloads is the response is decided by digest: one aggregate with
map-side combination finds the largest page id, only digests that occur twice
are joined back, and adaptive execution splits a digest that holds a large part
of all pages. Payloads do not move for that.

Edge cases: a null payload is empty; null urls are written as empty ones; empty
payloads are payloads like others, above ``least_bytes``; rows with equal page
ids are captures of their own, told apart by a row number within the id, the
first of them the response; null page ids become empty identifiers and null
again when read; records that name no known capture are rows with a null
``response``; an empty table gives an archive without records.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wearline.workspace import settle

VERSION = "WARC/1.1"
LINE = "\r\n"
RECORD_END = LINE * 2
# Begins a record. No part of it repeats its start, so a reader that meets half of it at the
# end of a buffer has nothing to go back for; with the line ends before it that would not be so.
SEPARATOR = f"{VERSION}{LINE}"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
# The alphabets of base 32 with digits first, and of RFC 4648.
_DIGITS, _BASE32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def sha1_base32(payload: Column) -> Column:
    """Upper-case base-32 SHA-1: 40 hexadecimal digits in groups of 5, each 4 signs of base 32."""
    hashed = F.sha1(payload)
    groups = [F.lpad(F.conv(F.substring(hashed, 5 * k + 1, 5), 16, 32), 4, "0") for k in range(8)]
    return F.translate(F.upper(F.concat(*groups)), _DIGITS, _BASE32)


# --- writing ---------------------------------------------------------------


def _headers(*pairs: tuple[str, Column | None]) -> Column:
    """Header lines; a line whose value is null is left out."""
    lines = [F.concat(F.lit(f"{name}: "), value) for name, value in pairs]
    return F.concat_ws(LINE, F.lit(VERSION), *lines)


def _record(headers: Column, block: Column) -> Column:
    length = F.concat(F.lit(f"{LINE}Content-Length: "), F.octet_length(block).cast("string"))
    return F.concat(headers, length, F.lit(RECORD_END), block)


def _chunk(data: Column) -> Column:
    size = F.lower(F.hex(F.octet_length(data)))
    return F.when(data == "", F.lit("")).otherwise(F.concat(size, F.lit(LINE), data, F.lit(LINE)))


def _chunked(payload: Column) -> Column:
    """Chunked transfer coding, cut inside every version line; at its end a payload meets a line end of the record."""
    head, tail = VERSION[:4], VERSION[4:].replace(".", "\\.")
    parts = F.split(payload, f"(?<={head})(?={tail}(?:\\r\\n|\\z))")
    return F.concat(F.array_join(F.transform(parts, _chunk), ""), F.lit(f"0{RECORD_END}"))


def _escaped(url: Column) -> Column:
    """A url without line ends and version marks: they, and then ``%`` too, become percent codes."""
    codes = F.replace(F.replace(F.replace(url, F.lit("%"), F.lit("%25")), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    codes = F.replace(codes, F.lit(VERSION), F.lit(VERSION.replace("/", "%2F")))
    return F.when(_needs_escape(url), codes).otherwise(url)


def _needs_escape(url: Column) -> Column:
    return F.contains(url, F.lit("\r")) | F.contains(url, F.lit("\n")) | F.contains(url, F.lit(VERSION))


def _unescaped(url: Column) -> Column:
    for code, sign in (("%0D", "\r"), ("%0A", "\n"), ("%2F", "/"), ("%25", "%")):
        url = F.replace(url, F.lit(code), F.lit(sign))
    return url


def captures(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Pages with digest, size, a name of their own (``own``) and that of the page with the same payload
    and the largest id (``first``, ``first_url``; null where no other page has the payload)."""
    known = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.coalesce("url", F.lit("")).alias("url"),
        F.coalesce("html", F.lit("")).alias("payload"),
    )
    # Only pages that share their id need more than it for a name: their digest, and a number within that.
    twins = known.groupBy(F.col("page_id").alias("twin")).count().filter("count > 1")
    twins = settle(twins.select("twin", F.lit(True).alias("shared")), "equal-page-ids")
    known = known.withColumns(
        {"digest": sha1_base32(F.col("payload")), "size": F.octet_length("payload").cast("long")}
    )
    joined = known.join(twins, F.col("page_id").eqNullSafe(F.col("twin")), "left")
    name = F.coalesce(F.col("page_id").cast("string"), F.lit(""))
    number = F.row_number().over(Window.partitionBy("page_id", "digest").orderBy("url"))
    single = joined.filter("shared is null").withColumn("own", F.concat(name, F.lit("-1")))
    several = joined.filter("shared").withColumn("number", number)
    several = several.withColumn("own", F.concat(name, F.lit("-"), "digest", F.lit("."), "number")).drop("number")
    rows = single.unionByName(several).drop("twin", "shared")
    repeated = (
        rows.filter(F.col("size") >= least_bytes)
        .groupBy("digest", "size")
        .agg(F.count(F.lit(1)).alias("n"), F.max(F.struct("page_id", "own", "url")).alias("from"))
        .filter("n > 1")
    )
    repeated = settle(
        repeated.select("digest", "size", F.col("from.own").alias("first"), F.col("from.url").alias("first_url")),
        "repeated-payloads",
    )
    return rows.join(repeated, ["digest", "size"], "left")


def records(pages: DataFrame, date: str = "2024-01-01T00:00:00Z", least_bytes: int = 0) -> DataFrame:
    """The text of all records, three per page: column ``value``."""
    rows = captures(pages, least_bytes)
    own, first = F.col("own"), F.col("first")
    name = F.coalesce(F.col("page_id").cast("string"), F.lit(""))
    url, escaped = _escaped(F.col("url")), F.when(_needs_escape(F.col("url")), "percent")

    def identifier(kind: str, of: Column) -> Column:
        return F.concat(F.lit(f"<urn:page:{kind}:"), of, F.lit(">"))

    is_revisit = F.coalesce(own != first, F.lit(False))
    response_id = identifier("capture", own)
    has_separator = F.instr(F.concat("payload", F.lit(LINE)), SEPARATOR) > 0
    digest = F.concat(F.lit("sha1:"), F.col("digest"))
    kind = F.when(is_revisit, "revisit").otherwise("response")
    coding = F.when(has_separator & ~is_revisit, "chunked")
    http = F.concat_ws(
        LINE,
        F.lit("HTTP/1.1 200 OK"),
        F.lit("Content-Type: text/html; charset=utf-8"),
        F.concat(F.lit("X-Payload-Length: "), F.col("size").cast("string")),
        F.concat(F.lit("Transfer-Encoding: "), coding),
    )
    body = F.when(is_revisit, "").when(has_separator, _chunked(F.col("payload"))).otherwise(F.col("payload"))
    response = _record(
        _headers(
            ("WARC-Type", kind),
            ("WARC-Record-ID", response_id),
            ("WARC-Date", F.lit(date)),
            ("WARC-Target-URI", url),
            ("X-URI-Escapes", escaped),
            ("WARC-Payload-Digest", digest),
            ("WARC-Profile", F.when(is_revisit, PROFILE)),
            ("WARC-Refers-To", F.when(is_revisit, identifier("capture", first))),
            ("WARC-Refers-To-Target-URI", F.when(is_revisit, _escaped(F.col("first_url")))),
            ("Content-Type", F.lit("application/http; msgtype=response")),
        ),
        F.concat(http, F.lit(RECORD_END), body),
    )
    path = F.regexp_extract(url, r"^[^:]*://[^/]*([^#]*)", 1)
    request = _record(
        _headers(
            ("WARC-Type", F.lit("request")),
            ("WARC-Record-ID", identifier("request", own)),
            ("WARC-Date", F.lit(date)),
            ("WARC-Target-URI", url),
            ("X-URI-Escapes", escaped),
            ("WARC-Concurrent-To", response_id),
            ("Content-Type", F.lit("application/http; msgtype=request")),
        ),
        F.concat(F.lit("GET "), path, F.lit(f" HTTP/1.1{RECORD_END}")),
    )
    metadata = _record(
        _headers(
            ("WARC-Type", F.lit("metadata")),
            ("WARC-Record-ID", identifier("metadata", own)),
            ("WARC-Date", F.lit(date)),
            ("WARC-Target-URI", url),
            ("X-URI-Escapes", escaped),
            ("WARC-Concurrent-To", response_id),
            ("Content-Type", F.lit("application/warc-fields")),
        ),
        F.concat(F.lit("page-id: "), name, F.lit(LINE)),
    )
    return rows.select(F.explode(F.array(request, response, metadata)).alias("value"))


def write_archives(pages: DataFrame, folder: str, least_bytes: int = 0) -> None:
    written = records(pages, least_bytes=least_bytes).write
    written.option("lineSep", RECORD_END).option("compression", "gzip").text(folder)


# --- reading ---------------------------------------------------------------


def _header(name: str, source: str = "head") -> Column:
    found = F.regexp_extract(F.col(source), rf"(?i)(?:^|\r\n){name}:[ \t]*([^\r\n]*)", 1)
    return F.when(found != "", F.rtrim(found))


def _all_headers(name: str) -> Column:
    return F.regexp_extract_all(F.col("head"), F.lit(rf"(?i)(?:^|\r\n){name}:[ \t]*([^\r\n]*[^\s])"), 1)


def read_records(spark: SparkSession, folder: str) -> DataFrame:
    """One row per record, with its headers and its block as bytes."""
    lines = spark.read.option("lineSep", SEPARATOR).text(folder)
    split = F.instr(F.col("text"), RECORD_END)
    parts = lines.select(F.col("value").alias("text")).filter("text <> ''").select(
        F.when(split > 0, F.expr("substring(text, 1, instr(text, '\r\n\r\n') - 1)")).otherwise(F.col("text")).alias("head"),
        F.when(split > 0, F.expr("substring(text, instr(text, '\r\n\r\n') + 4)")).otherwise("").alias("rest"),
    )
    length = F.expr(r"try_cast(regexp_extract(head, '(?i)(?:^|\r\n)Content-Length:[ \t]*([0-9]+)', 1) as int)")
    block = F.col("rest").cast("binary")
    return parts.select(
        _header("WARC-Record-ID").alias("record_id"),
        _header("WARC-Type").alias("record_type"),
        _header("WARC-Date").alias("date"),
        F.when(_header("X-URI-Escapes") == "percent", _unescaped(_header("WARC-Target-URI")))
        .otherwise(_header("WARC-Target-URI")).alias("target_uri"),
        _all_headers("WARC-Concurrent-To").alias("concurrent_to"),
        _header("WARC-Refers-To").alias("refers_to"),
        F.regexp_replace(_header("WARC-Payload-Digest"), "^[a-z0-9]+:", "").alias("payload_digest"),
        F.substring(block, F.lit(1), F.coalesce(length, F.octet_length("rest"))).alias("block"),
        F.coalesce(F.octet_length("rest") >= length, F.lit(False)).alias("complete"),
    )


def _joined_chunks(body: Column) -> Column:
    """Decode chunked coding; one step per chunk, each taking its stated number of bytes."""
    state = F.struct(F.lit("").cast("binary").alias("done"), body.cast("binary").alias("rest"))

    def step(s: Column, _: Column) -> Column:
        line = F.substring_index(s["rest"].cast("string"), LINE, 1)
        size = F.coalesce(F.conv(line, 16, 10).cast("int"), F.lit(0))
        start = F.octet_length(line) + 3
        return F.struct(
            F.concat(s["done"], F.substring(s["rest"], start, size)).alias("done"),
            F.substring(s["rest"], start + size + 2, F.octet_length(s["rest"])).alias("rest"),
        )

    # At most one chunk starts per line, so the number of lines bounds the steps.
    steps = F.sequence(F.lit(1), F.size(F.split(body.cast("string"), f"{VERSION[4:]}{LINE}".replace(".", "\\."))))
    return F.aggregate(steps, state, step)["done"]


def with_payload(found: DataFrame) -> DataFrame:
    """Add ``payload`` (bytes, null for records without one) and ``payload_bytes``, the full size.

    A revisit has no payload; its size is that of the response, as its HTTP
    header states.
    """
    http = F.col("record_type").isin("response", "revisit", "request")
    text = F.col("block").cast("string")
    cut = found.withColumns(
        {
            "http": F.when(http, F.substring_index(text, RECORD_END, 1)),
            "body": F.when(
                F.col("record_type") == "response",
                F.expr("substring(block, octet_length(substring_index(cast(block as string), '\r\n\r\n', 1)) + 5)"),
            ),
        }
    )
    chunked = F.lower(_header("Transfer-Encoding", "http")) == "chunked"
    payload = F.when(F.coalesce(chunked, F.lit(False)), _joined_chunks(F.col("body"))).otherwise(F.col("body"))
    stated = F.expr(r"try_cast(regexp_extract(http, '(?i)\r\nX-Payload-Length:[ \t]*([0-9]+)', 1) as long)")
    cut = cut.withColumn("payload", payload)
    return cut.withColumn("payload_bytes", F.coalesce(F.octet_length("payload").cast("long"), stated)).drop("http", "body")


_DETAILS = ("record_id", "date", "target_uri", "block")


def assemble(found: DataFrame) -> DataFrame:
    """One nested row per capture: ``capture_id``, ``response``, ``requests``, ``metadata``.

    A request or metadata record belongs to the response or revisit that it
    names, or that names it, or that a record which it names belongs to. Archives
    are read twice: once for identifiers and small records, which are written, and
    once for the responses, of which only the columns move that are asked for.
    """
    is_anchor = F.coalesce(F.col("record_type").isin("response", "revisit"), F.lit(False))
    details = F.struct(*_DETAILS)
    narrow = found.filter(F.coalesce(F.col("record_type") != "warcinfo", F.lit(True))).select(
        "record_id", "record_type", "concurrent_to", is_anchor.alias("is_anchor"), F.when(~is_anchor, details).alias("details")
    )
    narrow = settle(narrow, "warc-links")
    heads, others = narrow.filter("is_anchor"), narrow.filter("not is_anchor")
    anchor_ids = heads.select(F.col("record_id").alias("anchor")).distinct()
    named = others.select("record_id", F.explode("concurrent_to").alias("anchor"))
    naming = heads.select(F.explode("concurrent_to").alias("record_id"), F.col("record_id").alias("anchor"))
    direct = named.join(anchor_ids, "anchor", "left_semi").select("record_id", "anchor").unionByName(naming)
    # A record with several names belongs to the first, in order of the identifiers.
    direct = settle(direct.groupBy("record_id").agg(F.min("anchor").alias("capture_id")), "direct-links")
    rest = named.join(anchor_ids, "anchor", "left_anti").withColumnRenamed("anchor", "via")
    through = rest.join(direct.withColumnRenamed("record_id", "via"), "via").groupBy("record_id")
    through = through.agg(F.min("capture_id").alias("capture_id"))
    links = direct.unionByName(through).groupBy("record_id").agg(F.min("capture_id").alias("capture_id"))
    attached = (
        others.join(links, "record_id", "left")
        .groupBy(F.coalesce("capture_id", "record_id").alias("capture_id"))
        .agg(
            F.sort_array(F.collect_list(F.when(F.col("record_type") == "request", F.col("details")))).alias("requests"),
            F.sort_array(F.collect_list(F.when(F.col("record_type") == "metadata", F.col("details")))).alias("metadata"),
        )
    )
    attached = settle(attached, "attached-records")
    fields = [c for c in found.columns if c != "concurrent_to"]
    # The nested row is made after the join, so that columns nobody reads do not move.
    anchors = found.filter(is_anchor)
    whole = anchors.join(attached, anchors["record_id"] == attached["capture_id"], "left")
    whole = whole.select(
        anchors["record_id"].alias("capture_id"),
        F.struct(*(anchors[c] for c in fields)).alias("response"),
        *(F.coalesce(attached[c], F.array().cast(attached.schema[c].dataType)).alias(c) for c in ("requests", "metadata")),
    )
    alone = attached.join(anchor_ids, F.col("capture_id") == F.col("anchor"), "left_anti")
    alone = alone.select(
        "capture_id", F.lit(None).cast(whole.schema["response"].dataType).alias("response"), "requests", "metadata"
    )
    return whole.unionByName(alone)
