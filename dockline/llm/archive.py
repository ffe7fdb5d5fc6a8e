"""ARC archives and their conversion to WARC.

``export_arc`` writes records as ARC files, ``convert`` reads ARC files of version 1 or 2 (the
version is in the first record's body, the number of header fields follows from it) by their declared
lengths and writes WARC/1.1 files, ``read_warc`` reads those. All files go through
Spark's readers and writers: the ``text`` writer with the format's own record end
as line end, the ``binaryFile`` reader for whole files, which the writers keep to about ``FILE_BYTES``
of records, one record at least.

Conversion: ``WARC-Record-ID`` is a UUID made from the archive's name and the record's
offset, URL and date, so a rerun gives the same; ``WARC-Date`` is the ARC date in ISO form;
digests are SHA-256. A record whose body is no HTTP message (``dns:``) becomes a ``resource`` of its own
type, the record that describes the archive a ``warcinfo``. Of responses with equal payloads of at least ``MIN_REVISIT`` bytes, the first in
order of page id is the response, and the others become ``revisit`` records that refer to it and
carry the HTTP header only.

Defined cases: a null payload is an empty one, a null or blank URL becomes
``urn:page:<id>``, blanks in URLs are percent-encoded; a null page id sorts last and is read
back as null; an ARC record whose header can't be parsed is skipped up to the
next line that is a header, and one that the file's end cuts off is dropped; an
empty table gives files without records and an empty result.
"""
from __future__ import annotations

import gzip
import hashlib
import re
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C

FILE_BYTES = 4 << 20
MIN_REVISIT = 100
# Fixed by the formats: header fields of a URL record by ARC version, and record ends.
ARC_FIELDS = {
    "1": ["url", "ip", "date", "mime", "length"],
    "2": ["url", "ip", "date", "mime", "status", "checksum", "location", "offset", "filename", "length"],
}
ARC_NAMES = {
    "1": "URL IP-address Archive-date Content-type Archive-length",
    "2": "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
WARC_END = "\r\n\r\n"
PAGE_FIELD = "X-Page-Id"
FIRST_DATE = 1_600_000_000         # the pages carry no date of their own; theirs follow from their id


def export_arc(pages: DataFrame, path: str, version: str | None = None) -> None:
    """Write page_id, url, html as gzipped ARC files, of ``version`` or of either in turn. A task packs its pages
    into archives where they are; a row of the result is a whole archive and becomes a file, so nothing is shuffled."""
    from pyspark import TaskContext

    def archives(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        task, made, out, held = TaskContext.get().partitionId(), 0, [], 0
        date = "20200913122640"

        def begun() -> tuple[str, str]:
            v = version or "12"[(task + made) % 2]
            name = f"pages-{task:06d}-{made:06d}.arc"
            head = f"{v} 0 dockline\n{ARC_NAMES[v]}\n"
            more = "" if v == "1" else f"200 - - 0 {name} "
            out.append(f"filedesc://{name} 0.0.0.0 {date} text/plain {more}{len(head)}\n{head}")
            return v, name

        v, name = begun()
        for pdf in batches:
            for page, url, html in zip(pdf["page_id"].astype("Int64"), pdf["url"], pdf["html"]):
                if held >= FILE_BYTES:
                    yield pd.DataFrame({"value": ["\n".join(out)]})
                    made, out, held = made + 1, [], 0
                    v, name = begun()
                html, known = html or "", page is not pd.NA
                size = len(html.encode("utf-8", "surrogatepass"))
                url = re.sub(r"\s", lambda m: "".join(f"%{b:02X}" for b in m[0].encode()), (url or "").strip()) or f"urn:page:{page if known else ''}"
                when = pd.Timestamp(FIRST_DATE + (int(page) % 10 ** 8 if known else 0), unit="s").strftime("%Y%m%d%H%M%S")
                front = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n" + (f"{PAGE_FIELD}: {page}\r\n" if known else "") \
                    + f"Content-Length: {size}\r\n\r\n"
                n = len(front) + size
                line = f"{url} 0.0.0.0 {when} text/html {n}" if v == "1" else f"{url} 0.0.0.0 {when} text/html 200 - - 0 {name} {n}"
                out.append(f"{line}\n{front}{html}")
                held += n
        yield pd.DataFrame({"value": ["\n".join(out)]})

    (pages.select("page_id", "url", "html").mapInPandas(archives, "value string")
     .write.option("maxRecordsPerFile", 1).option("lineSep", "\n").option("compression", "gzip")
     .option("zlib.compress.level", "BEST_SPEED").text(path))


def _unpacked(content: bytes) -> bytes:
    return gzip.decompress(content) if content[:2] == b"\x1f\x8b" else bytes(content)


def arc_records(data: bytes, info: bool = False) -> Iterator[tuple[dict, bytes]]:
    """(header fields with ``at``, the record's offset, and ``archive``; body) of each URL record, with ``info``
    of the records that describe the archive, too."""
    fields, archive, at = ARC_FIELDS["1"], "", 0
    while at < len(data):
        end = data.find(b"\n", at)
        if end < 0:
            return
        line = data[at:end].rstrip(b"\r").decode("utf-8", "replace")
        wide = [ARC_FIELDS["2"], ARC_FIELDS["1"]] if line.startswith("filedesc://") else [fields]
        # a URL may hold blanks, the other fields don't: count from the right
        got = next((dict(zip(w, p)) for w in wide if len(p := line.rsplit(" ", len(w) - 1)) == len(w)
                    and re.fullmatch(r"\d{14}", p[2]) and p[-1].isdigit()), None)
        if got is None:
            at = end + 1
            continue
        size = int(got["length"])
        if end + 1 + size > len(data):
            return
        body = data[end + 1:end + 1 + size]
        if got["url"].startswith("filedesc://"):
            archive = got["url"][len("filedesc://"):]
            fields = ARC_FIELDS.get(body[:1].decode("ascii", "replace"), fields)
        if info or not got["url"].startswith("filedesc://"):
            yield got | {"at": at, "archive": archive}, body
        at = end + 1 + size


def http_parts(block: bytes) -> tuple[bytes, bytes, dict]:
    """Header with its blank line, payload, and the header's fields by lower-case name."""
    cut = block.find(b"\r\n\r\n")
    if not block.startswith(b"HTTP/") or cut < 0:
        return b"", block, {}
    head = block[:cut + 4]
    pairs = (x.split(":", 1) for x in head.decode("latin-1").split("\r\n")[1:] if ":" in x)
    return head, block[cut + 4:], {k.strip().lower(): v.strip() for k, v in pairs}


PARSED = ("record_id string, page_id long, url string, ip string, date string, head binary, payload binary, "
          "n long, digest string, kind string, mime string")


def _parse_arc(batches: Iterator[pd.DataFrame], body_too: bool = True) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        for content in pdf["content"]:
            out = []
            for h, body in arc_records(_unpacked(content), info=True):
                if h["url"].startswith("filedesc://"):
                    body = f"software: dockline\r\nformat: WARC File Format 1.1\r\ndescription: from ARC version {body[:1].decode('ascii', 'replace')}\r\n".encode()
                    kind, head, payload, http = "warcinfo", b"", body, {}
                else:
                    head, payload, http = http_parts(body)
                    kind = "response" if head else "resource"
                d = h["date"]
                page = http.get(PAGE_FIELD.lower(), "")
                rid = uuid.UUID(bytes=hashlib.sha256(f"{h['archive']} {h['at']} {h['url']} {d}".encode()).digest()[:16], version=4)
                out.append((f"<urn:uuid:{rid}>", int(page) if page.lstrip("-").isdigit() else None, h["url"], h["ip"],
                            f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:]}Z", head if body_too else None,
                            payload if body_too else None, len(payload),
                            hashlib.sha256(payload).hexdigest(), kind, h["archive"] if kind == "warcinfo" else h["mime"]))
            yield pd.DataFrame(out, columns=[x.split()[0] for x in PARSED.split(", ")]).astype({"page_id": "Int64"})


def files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select("content")


def convert(spark: SparkSession, arc: str, warc: str) -> None:
    """Convert the ARC files under ``arc`` to gzipped WARC files under ``warc``."""
    def heads(batches):
        return _parse_arc(batches, body_too=False)

    who = files(spark, arc).mapInPandas(heads, PARSED).select("record_id", "page_id", "url", "date", "n", "digest", "kind")
    total = who.agg(F.sum("n")).first()[0] or 0
    # dealt by the key of the join below, so that payloads are shuffled once
    parsed = files(spark, arc).mapInPandas(_parse_arc, PARSED).repartition(int(total // FILE_BYTES) + 1, "record_id")
    alike = who.filter((F.col("n") >= MIN_REVISIT) & (F.col("kind") == "response"))
    first = (alike.groupBy(F.col("digest").alias("_g"))
             .agg(F.min(F.struct(F.col("page_id").isNull().alias("none"), "page_id", "record_id", "url", "date")).alias("first")))
    told = (alike.join(first, F.col("digest") == F.col("_g"))
            .filter(F.col("record_id") != F.col("first.record_id"))
            .select(F.col("record_id").alias("_r"), "first"))
    rows = parsed.join(told, F.col("record_id") == F.col("_r"), "left")
    again = F.col("first").isNotNull()
    block = F.when(again, F.col("head")).otherwise(F.concat("head", "payload"))
    crlf = F.lit("\r\n")
    line = lambda k, v: F.concat(F.lit(k + ": "), v, crlf)
    info = F.col("kind") == "warcinfo"
    header = F.concat(
        F.lit("WARC/1.1\r\n"), line("WARC-Type", F.when(again, "revisit").otherwise(F.col("kind"))),
        line("WARC-Record-ID", F.col("record_id")), line("WARC-Date", F.col("date")),
        F.when(info, line("WARC-Filename", F.col("mime"))).otherwise(F.concat(
            line("WARC-Target-URI", F.col("url")), line("WARC-IP-Address", F.col("ip")),
            line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), "digest")))),
        line("WARC-Block-Digest", F.concat(F.lit("sha256:"), F.when(F.length("head") > 0, F.sha2(block, 256)).otherwise(F.col("digest")))),
        F.when(again, F.concat(
            F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\n"),
            line("WARC-Refers-To", F.col("first.record_id")), line("WARC-Refers-To-Target-URI", F.col("first.url")),
            line("WARC-Refers-To-Date", F.col("first.date")))).otherwise(""),
        line("Content-Type", F.when(info, "application/warc-fields").when(F.col("kind") == "resource", F.col("mime"))
             .otherwise("application/http; msgtype=response")),
        line("Content-Length", F.octet_length(block).cast("string")), crlf)
    # as bytes: a payload needn't be valid text
    (rows.select(F.concat(header.cast("binary"), block).cast("string").alias("value")).write.option("lineSep", WARC_END)
     .option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED").text(warc))


def warc_records(data: bytes) -> Iterator[tuple[dict, bytes]]:
    """(header fields by lower-case name, block) of each record."""
    at = 0
    while (at := data.find(b"WARC/1.", at)) >= 0:
        cut = data.find(b"\r\n\r\n", at)
        if cut < 0:
            return
        pairs = (x.split(":", 1) for x in data[at:cut].decode("utf-8", "replace").split("\r\n")[1:] if ":" in x)
        got = {k.strip().lower(): v.strip() for k, v in pairs}
        size = int(got["content-length"])
        yield got, data[cut + 4:cut + 4 + size]
        at = cut + 4 + size + len(WARC_END)


READ = ("record_id string, record_type string, date string, url string, page_id long, payload_bytes long, "
        "payload_digest string, intact boolean, refers_to_id string, payload binary")


def read_warc(spark: SparkSession, path: str, info: bool = False, payloads: bool = True) -> DataFrame:
    """One row per record, with ``info`` warcinfo records too; payloads are checked, and returned where
    ``payloads``. A revisit's payload is null, its size is that of the HTTP header;
    ``intact`` tells whether block and payload agree with the digests."""
    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for content in pdf["content"]:
                out = []
                for h, block in warc_records(_unpacked(content)):
                    if h["warc-type"] == "warcinfo" and not info:
                        continue
                    _, payload, http = http_parts(block)
                    again = h["warc-type"] == "revisit"
                    digest, page = h.get("warc-payload-digest", h["warc-block-digest"]).removeprefix("sha256:"), http.get(PAGE_FIELD.lower(), "")
                    intact = hashlib.sha256(block).hexdigest() == h["warc-block-digest"].removeprefix("sha256:") \
                        and (again or hashlib.sha256(payload).hexdigest() == digest)
                    out.append((h["warc-record-id"], h["warc-type"], h["warc-date"], h.get("warc-target-uri"),
                                int(page) if page.lstrip("-").isdigit() else None,
                                int(http.get("content-length", 0)) if again else len(payload), digest, intact,
                                h.get("warc-refers-to"), None if again or not payloads else payload))
                yield pd.DataFrame(out, columns=[x.split()[0] for x in READ.split(", ")]).astype({"page_id": "Int64"})

    return files(spark, path).mapInPandas(parse, READ)


def round_trip(pages: DataFrame, folder: str) -> DataFrame:
    """pages -> ARC -> WARC under ``folder``, read back: page_id, payload_bytes, payload_digest, record_type, refers_to."""
    spark = pages.sparkSession
    export_arc(pages, f"{folder}/arc")
    convert(spark, f"{folder}/arc", f"{folder}/warc")
    # read once: the answer and the ids that it refers to come from the same rows
    got = C.materialize(read_warc(spark, f"{folder}/warc", payloads=False).drop("payload"), "warc-records")
    ids = got.filter("record_type = 'response'").select(F.col("record_id").alias("_r"), F.col("page_id").alias("refers_to"))
    return (got.join(ids, F.col("refers_to_id") == F.col("_r"), "left")
            .select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "intact"))


ORACLE = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h, octet_length(encode(coalesce(html, ''))) AS n FROM pages),
f AS (SELECT sha256(h) AS g, min(page_id) AS first FROM p WHERE n >= 100 GROUP BY 1)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, sha256(h) AS payload_digest,
       CASE WHEN n >= 100 AND first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 100 AND first <> page_id THEN first END AS refers_to, true AS intact
FROM p LEFT JOIN f ON sha256(p.h) = f.g
"""
