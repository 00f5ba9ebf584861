"""Web archives: writing captures as WARC records, and assembling records to captures.

A capture is a transaction: a response (or a revisit of an equal payload), its
request and its metadata, linked by WARC-Concurrent-To. Usually the latter two
name the first. Where a record names several, or one that names another in turn,
whatever is linked is one capture, in whichever direction.

Records are text, so Spark's text files carry them: the end of a record is the
end of a line. Reading splits at the end of a record followed by the start of
the next, a record at a time, and plain archives in parallel. What
was written never holds that separator: a payload that holds its second half is
sent in chunks that cut it. Foreign archives are checked by Content-Length, and
one that breaks the rule stops the read.

A null payload is empty, a null page id is written as an empty field. Identical
rows are one capture. Control characters in a url are percent-coded. Payloads are
read as the bytes they are, whether or not they are UTF-8; header lines that
aren't are read with replacement characters.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeflow.llm.components import components
from tradeflow.workspace import new_folder, settled

END = "\r\n\r\n"
VERSION = "WARC/1.1\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_BYTES = "ISO-8859-1"  # one character a byte
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32_sha1(data: Column) -> Column:
    """The SHA-1 of bytes as 32 letters."""
    def letters(group: Column) -> Column:
        """Five hexadecimal digits, 20 bits, are four letters."""
        number = F.conv(group, 16, 10).cast("int")
        values = [F.shiftright(number, 15 - 5 * i).bitwiseAND(F.lit(31)) for i in range(4)]
        return F.concat(*[F.substr(F.lit(_BASE32), value + 1, F.lit(1)) for value in values])

    digests = F.transform(F.array(F.sha1(data)), lambda d: F.array_join(
        F.transform(F.sequence(F.lit(0), F.lit(7)), lambda i: letters(F.substr(d, i * 5 + 1, F.lit(5)))), ""))
    return F.get(digests, F.lit(0))


def _record_id(*parts: Column) -> Column:
    hashed = F.md5(F.concat_ws(" ", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]))
    return F.concat(F.lit("<urn:uuid:"), F.regexp_replace(hashed, "^(.{8})(.{4})(.{4})(.{4})", "$1-$2-$3-$4-"), F.lit(">"))


def _record(headers: list[tuple[str, Column]], block: Column) -> Column:
    lines = [F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")) for name, value in headers]
    size = F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string"), F.lit(END))
    return F.concat(F.lit(VERSION), *[F.coalesce(line, F.lit("")) for line in lines], size, block)


def _chunked(payload: Column) -> Column:
    """HTTP chunks that cut each start of a record in two."""
    head, tail = VERSION[:4], VERSION[4:]
    parts = F.split(payload, r"WARC/1\.1\r\n")
    whole = F.transform(parts, lambda part, i: F.concat(
        F.when(i > 0, F.lit(tail)).otherwise(F.lit("")), part,
        F.when(i < F.size(parts) - 1, F.lit(head)).otherwise(F.lit(""))))
    coded = F.transform(whole, lambda c: F.concat(F.lower(F.hex(F.octet_length(c))), F.lit("\r\n"), c, F.lit("\r\n")))
    return F.concat(F.array_join(coded, ""), F.lit("0\r\n\r\n"))


def _unchunked(block: Column) -> Column:
    """The bytes that HTTP chunks hold."""
    def step(s: Column, _: Column) -> Column:
        line = F.instr(F.decode(s["rest"], _BYTES), "\r\n")
        size = F.conv(F.decode(F.substring(s["rest"], F.lit(1), line - 1), _BYTES), 16, 10).cast("int")
        more = F.struct(F.substring(s["rest"], line + 2 + size + 2, F.length(s["rest"])).alias("rest"),
                        F.concat(s["out"], F.substring(s["rest"], line + 2, size)).alias("out"))
        return F.when(F.length(s["rest"]) > 0, more).otherwise(s)

    most = F.regexp_count(F.decode(block, _BYTES), F.lit("\r\n"))
    none = F.lit(b"")
    return F.aggregate(F.sequence(F.lit(0), most), F.struct(block.alias("rest"), none.alias("out")), step, lambda s: s["out"])


def captures_to_write(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
                      least_bytes: int = 0, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """``record``: three per row of ``pages``.

    Of rows with equal payloads of ``least_bytes`` or more, that with the largest
    id is the response and the others revisit it.
    """
    payload = F.coalesce(F.col(payload_col), F.lit(""))
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), payload.alias("payload")).withColumn(
        "digest", base32_sha1(F.encode("payload", "UTF-8"))).withColumn("bytes", F.octet_length("payload"))
    # What decides is small; payloads meet the decision by the row's own id, which no group shares.
    keys = settled(rows.select("id", "url", "digest", "bytes"), new_folder(pages.sparkSession, "payload-keys"))
    first = keys.where((F.col("bytes") >= least_bytes) & F.col("id").isNotNull()).groupBy("digest", "bytes").agg(
        F.max(F.struct("id", "url")).alias("first"))
    again = keys.join(first, ["digest", "bytes"]).where("id < first.id or id is null").select(
        F.col("id").alias("again_id"), F.col("digest").alias("again_digest"), F.col("first.id").alias("first_id"),
        F.col("first.url").alias("first_url")).distinct()
    told = rows.join(again, rows["id"].eqNullSafe(again["again_id"]) & (rows["digest"] == again["again_digest"]), "left")

    def coded(column: str) -> Column:
        return F.regexp_replace(F.coalesce(F.col(column), F.lit("")), r"[\x00-\x20\x7F]", "%20")

    url = coded("url")
    own = _record_id(F.lit("capture"), F.col("id"), F.col("url"), F.col("digest"))
    shared = [("WARC-Target-URI", url), ("WARC-Date", F.lit(date))]
    about = [("WARC-Concurrent-To", own), *shared]
    cut = F.col("payload").contains(VERSION)
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"),
        F.when(cut & F.col("first_id").isNull(), F.lit("Transfer-Encoding: chunked\r\n")).otherwise(
            F.concat(F.lit("Content-Length: "), F.col("bytes").cast("string"), F.lit("\r\n"))), F.lit("\r\n"))
    digest = ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest")))
    response = _record(
        [("WARC-Type", F.lit("response")), ("WARC-Record-ID", own), *shared, digest,
         ("Content-Type", F.lit("application/http;msgtype=response"))],
        F.concat(http, F.when(cut, _chunked(F.col("payload"))).otherwise(F.col("payload"))))
    revisit = _record(
        [("WARC-Type", F.lit("revisit")), ("WARC-Record-ID", own), *shared, digest, ("WARC-Profile", F.lit(PROFILE)),
         ("WARC-Refers-To", _record_id(F.lit("capture"), F.col("first_id"), F.col("first_url"), F.col("digest"))),
         ("WARC-Refers-To-Target-URI", coded("first_url")), ("WARC-Refers-To-Date", F.lit(date)), ("WARC-Refers-To-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
         ("X-Refers-To-Page", F.col("first_id").cast("string")), ("Content-Type", F.lit("application/http;msgtype=response"))],
        http)
    request = _record(
        [("WARC-Type", F.lit("request")), ("WARC-Record-ID", _record_id(F.lit("request"), own)), *about,
         ("Content-Type", F.lit("application/http;msgtype=request"))],
        F.concat(F.lit("GET "), url, F.lit(" HTTP/1.1\r\n\r\n")))
    metadata = _record(
        [("WARC-Type", F.lit("metadata")), ("WARC-Record-ID", _record_id(F.lit("metadata"), own)), *about,
         ("Content-Type", F.lit("application/warc-fields"))],
        F.concat(F.lit("page-id: "), F.coalesce(F.col("id").cast("string"), F.lit("")), F.lit("\r\n")))
    answer = F.when(F.col("first_id").isNull(), response).otherwise(revisit)
    return told.select(F.explode(F.array(request, answer, metadata)).alias("record"))


def write_archive(records: DataFrame, folder: str, compression: str = "gzip") -> None:
    """Archives below ``folder``, one a task; each record is ended as the format asks."""
    records.write.mode("overwrite").options(lineSep=END, compression=compression).text(folder)


def read_records(spark: SparkSession, folder: str) -> DataFrame:
    """One row per record: ``type, record_id, concurrent_to, uri, date, refers_to_record, refers_to, http, payload, payload_bytes, payload_digest``.

    ``concurrent_to`` lists the records named; ``refers_to`` is the page, where the writer said so.
    """
    rows = spark.read.option("lineSep", END + VERSION).text(folder).where(F.length("value") > 0)
    # Header, then for HTTP its header, then what is left: only the first two ends are looked for.
    rows = rows.withColumn("parts", F.split("value", END, 3)).withColumn("head", F.get("parts", F.lit(0)))

    def header(block: Column, name: str) -> Column:
        found = F.regexp_extract(F.concat(F.lit("\r\n"), block, F.lit("\r\n")), rf"(?i)\r\n{name}:[ \t]*([^\r\n]*?)[ \t]*\r\n", 1)
        return F.when(found != "", found)

    head = F.col("head")
    rows = rows.withColumn("size", F.coalesce(header(head, "Content-Length").cast("int"), F.lit(0))).withColumn(
        "http", F.when(header(head, "Content-Type").startswith("application/http"), F.get("parts", F.lit(1))))
    before = F.octet_length("head") + 4
    inner = F.coalesce(F.octet_length("http") + 4, F.lit(0))
    body = F.substring(F.col("value").cast("binary"), before + inner + 1, F.greatest(F.col("size") - inner, F.lit(0)))
    whole = F.when(F.octet_length("value") >= before + F.col("size"), body).otherwise(
        F.raise_error(F.concat(F.lit("a record is cut short: "), head)))
    chunked = F.lower(F.coalesce(header(F.col("http"), "Transfer-Encoding"), F.lit(""))) == "chunked"
    rows = rows.select("head", "http", whole.alias("body")).withColumn(
        "payload", F.when(chunked, _unchunked(F.col("body"))).otherwise(F.col("body"))).withColumn("type", header(head, "WARC-Type"))
    revisit = F.col("type") == "revisit"
    told = F.regexp_replace(header(head, "WARC-Payload-Digest"), "^sha1:", "")
    return rows.select(
        "type", header(head, "WARC-Record-ID").alias("record_id"),
        F.array_distinct(F.regexp_extract_all(F.concat(head, F.lit("\r\n")), F.lit(r"(?i)\r\nWARC-Concurrent-To:[ \t]*([^\r\n]*?)[ \t]*(?=\r\n)"))).alias("concurrent_to"),
        header(head, "WARC-Target-URI").alias("uri"), header(head, "WARC-Date").alias("date"),
        header(head, "WARC-Refers-To").alias("refers_to_record"), header(head, "X-Refers-To-Page").alias("refers_to"), "http", "payload",
        F.when(revisit, header(F.col("http"), "Content-Length").cast("bigint")).otherwise(F.length("payload").cast("bigint")).alias("payload_bytes"),
        F.when(revisit, told).otherwise(base32_sha1(F.col("payload"))).alias("payload_digest"))


_TOLD = ["type", "record_id", "uri", "date", "refers_to_record", "refers_to", "http", "payload_bytes", "payload_digest"]


def _with_capture(records: DataFrame) -> DataFrame:
    """``records``, a written table, with the ``capture_id`` of each."""
    named = F.get("concurrent_to", F.lit(0))
    linked = records.where("size(concurrent_to) > 0").select("record_id", "concurrent_to")
    chained = linked.where("size(concurrent_to) > 1").select("record_id").union(
        linked.select(named.alias("record_id")).join(linked.select("record_id"), "record_id", "left_semi"))
    if not chained.limit(1).count():
        return records.withColumn("capture_id", F.coalesce(named, "record_id"))
    edges = linked.select(F.col("record_id").alias("a"), F.explode("concurrent_to").alias("b"))
    found = settled(components(edges), new_folder(records.sparkSession, "transactions"))
    known = records.join(found.select(F.col("node").alias("record_id"), "component"), "record_id", "left")
    known = known.withColumn("component", F.coalesce("component", "record_id"))
    # As in the usual case, a capture goes by its answer's id.
    answers = known.where(_ANSWER).groupBy("component").agg(F.min("record_id").alias("_answer"))
    return known.join(answers, "component", "left").withColumn("capture_id", F.coalesce("_answer", "component")).drop("_answer", "component")


_ANSWER = "type in ('response', 'revisit', 'resource')"


def assembled(records: DataFrame, payloads: bool = True) -> DataFrame:
    """One row per capture: ``capture_id`` and the nested ``response``, ``request`` and ``metadata``.

    A record that nothing belongs to is a capture of its own, with nulls for
    what it lacks: a response of nulls, no request or no metadata. Records told
    twice count once. The archive is read once, and what is small of each record
    written; with ``payloads`` it is read again for those, which meet their capture
    by record id.
    """
    small = records.select("concurrent_to", *_TOLD, F.when(F.col("type") == "metadata", F.col("payload").cast("string")).alias("fields"))
    keyed = _with_capture(settled(small, new_folder(records.sparkSession, "archive-records")))
    answers = keyed.where(_ANSWER).dropDuplicates(["capture_id", "record_id"]).select("capture_id", *_TOLD)
    if payloads:
        bodies = records.where(_ANSWER).repartition("record_id").dropDuplicates(["record_id"])
        answers = answers.join(bodies.select("record_id", "payload"), "record_id", "left")
    asked = keyed.where("type = 'request'").groupBy("capture_id").agg(
        F.min(F.struct("record_id", "uri", F.col("http"))).alias("request"))
    about = keyed.where("type = 'metadata'").groupBy("capture_id").agg(F.min(F.struct("record_id", "fields")).alias("metadata"))
    joined = answers.join(asked, "capture_id", "full_outer").join(about, "capture_id", "full_outer")
    return joined.select("capture_id", F.struct(*_TOLD, *["payload"] * payloads).alias("response"), "request", "metadata")


def metadata_field(fields: Column, name: str) -> Column:
    found = F.regexp_extract(fields, rf"(?m)^{name}:[ \t]*([^\r\n]*)", 1)
    return F.when(found != "", found)
