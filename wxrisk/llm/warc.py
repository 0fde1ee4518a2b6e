"""WARC archives as a chunked record table.

A payload longer than a chunk is rows of (record, chunk number); on disk these are the standard's
segmented records (``continuation``), so no task needs a whole record's block in one piece. Archives
are written by Spark's text writer with the record separator as line separator and gzip, into
files of a bounded size, and are read back as a stream of chunks that carry the SHA-1 on.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wxrisk.llm import common

#: Code points of a payload in one chunk.
CHUNK_CHARS = 65_536
#: Records of an archive file at most.
ARCHIVE_RECORDS = 2_000
#: Equal payloads of at least this many bytes are written once.
LEAST_REVISIT_BYTES = 0

# The format's names, and the two base-32 alphabets.
END = "\r\n\r\n"
CRLF = "\r\n"
HEX_32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
BASE_32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
DATE = "2024-01-01T00:00:00Z"

CHUNKS = "record string, segment int, last boolean, kind string, page_id long, digest string, payload_bytes long, refers_to long, data binary"


def base32_sha1(payload: Column) -> Column:
    """Upper-case base-32 SHA-1: 40 bits are ten hexadecimal digits and eight letters."""
    digits = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(digits, 1 + 10 * k, 10), 16, 32), 8, "0") for k in range(4)]
    return F.translate(F.concat(*parts), HEX_32, BASE_32)


def decided(pages: DataFrame, stage, least_bytes: int = LEAST_REVISIT_BYTES) -> DataFrame:
    """(page_id, url, html, digest, payload_bytes, copy, kind, refers_to) for every row of ``pages``.

    The response is the row with the smallest page_id (nulls last), then url, of its payload; equal
    rows are told apart by ``copy``. The decisions are taken over digests and keys alone, where a
    payload shared by a third of all pages is one group; then one payload per digest is moved, and
    revisits have an empty html.
    """
    plain = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html"))
    keyed = plain.withColumn("digest", base32_sha1(F.col("html").cast("binary"))).withColumn("payload_bytes", F.octet_length("html").cast("long"))
    rows = keyed.groupBy("page_id", "url", "digest", "payload_bytes").agg(F.count("*").cast("int").alias("copies"))
    first = keyed.groupBy("digest").agg(F.min(F.struct(
        F.col("page_id").isNull().alias("no_id"), "page_id", F.col("url").isNull().alias("no_url"), "url")).alias("first"))
    joined = rows.join(first, "digest").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    leads = F.col("page_id").eqNullSafe(F.col("first.page_id")) & F.col("url").eqNullSafe(F.col("first.url")) & (F.col("copy") == 1)
    kind = F.when((F.col("payload_bytes") < least_bytes) | leads, "response").otherwise("revisit")
    known = stage(joined.select("page_id", "url", "digest", "payload_bytes", "copy", kind.alias("kind"),
                                F.when(kind == "revisit", F.col("first.page_id")).alias("refers_to")), "decisions")
    payloads = keyed.groupBy("digest").agg(F.first("html").alias("html"))
    return known.where("kind = 'response'").join(payloads, "digest").unionByName(
        known.where("kind = 'revisit'").withColumn("html", F.lit("")))


def chunk_table(rows: DataFrame, chunk: int = CHUNK_CHARS) -> DataFrame:
    """``rows`` as (record, segment, last, data) chunks from segment 1; a revisit is one chunk without data."""
    key = F.md5(F.concat_ws("\x1f", *[F.coalesce(F.col(c).cast("string"), F.lit("\x00")) for c in ("page_id", "url", "digest", "copy")]).cast("binary"))
    uuid = F.concat_ws("-", *[F.substring(key, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])
    body = F.when(F.col("kind") == "response", F.col("html")).otherwise("")
    count = F.greatest(F.lit(1), F.ceil(F.char_length(body) / F.lit(chunk)).cast("int"))
    # One pass from begin to end; the generator then hands on one piece after the other, without the payload.
    pieces = F.when(count == 1, F.array(body)).otherwise(F.regexp_extract_all(body, F.lit(f"(?s).{{1,{chunk}}}"), F.lit(0)))
    kept = [c for c in rows.columns if c != "html"]
    cut = rows.select(*kept, uuid.alias("record"), count.alias("segments"), F.posexplode(pieces).alias("place", "data"))
    return cut.withColumn("segment", F.col("place") + 1).withColumn("last", F.col("segment") == F.col("segments")).drop("place")


def record_text(chunks: DataFrame) -> Column:
    """A chunk as the text of a WARC record, without the closing separator."""
    first, whole = F.col("segment") == 1, (F.col("segment") == 1) & F.col("last")
    http = F.concat(F.lit("HTTP/1.1 200 OK" + CRLF + "Content-Type: text/html; charset=utf-8" + CRLF + "Content-Length: "), F.col("payload_bytes"), F.lit(END))
    block = F.when(first, F.concat(http, "data")).otherwise(F.col("data"))
    ident = F.when(first, F.col("record")).otherwise(F.concat("record", F.lit("-"), "segment"))

    def line(name: str, value: Column, when: Column | None = None) -> Column:
        made = F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))
        return made if when is None else F.when(when, made).otherwise("")

    return F.concat(
        F.lit("WARC/1.1" + CRLF),
        line("WARC-Type", F.when(first, F.col("kind")).otherwise("continuation")),
        line("WARC-Record-ID", F.concat(F.lit("<urn:uuid:"), ident, F.lit(">"))),
        line("WARC-Date", F.lit(DATE)),
        line("WARC-Target-URI", F.regexp_replace(F.coalesce("url", F.lit("")), r"[\x00-\x20]", "%20"), F.coalesce(F.col("url") != "", F.lit(False))),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest")), first),
        line("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), first & (F.col("kind") == "revisit")),
        line("X-Page-ID", F.col("page_id").cast("string"), first & F.col("page_id").isNotNull()),
        line("X-Refers-To-Page-ID", F.col("refers_to").cast("string"), first & F.col("refers_to").isNotNull()),
        line("WARC-Segment-Number", F.col("segment").cast("string"), ~whole),
        line("WARC-Segment-Origin-ID", F.concat(F.lit("<urn:uuid:"), F.col("record"), F.lit(">")), ~first),
        line("WARC-Segment-Total-Length", F.col("payload_bytes").cast("string"), F.col("last") & ~first),
        F.lit("Content-Type: application/http; msgtype=response" + CRLF + "Content-Length: "), F.octet_length(block), F.lit(END), block,
    )


def write_archives(pages: DataFrame, path: str, least_bytes: int = LEAST_REVISIT_BYTES, chunk: int = CHUNK_CHARS,
                   records: int = ARCHIVE_RECORDS) -> None:
    """Writes one WARC record per row of ``pages`` (page_id, url, html), as gzip files below ``path``.

    A file has at most ``records`` records, each of at most a chunk, so a huge payload does not make
    a huge file; its segments may lie in several.
    """
    chunks = chunk_table(decided(pages, common.stages(pages, "warc"), least_bytes), chunk)
    rows = chunks.select(record_text(chunks).alias("value"))
    rows.write.option("lineSep", END).option("compression", "gzip").option("maxRecordsPerFile", records).text(path)


def parsed(archive: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of each record of a gzip archive, unpacked piece by piece."""
    unpack, buffer = zlib.decompressobj(31), bytearray()
    pieces = iter(range(0, len(archive), 1 << 20))

    def more() -> bool:
        nonlocal unpack
        at = next(pieces, None)
        if at is None:
            return False
        rest = archive[at:at + (1 << 20)]
        while rest:
            buffer.extend(unpack.decompress(rest))
            rest = unpack.unused_data
            if rest:  # the next gzip member
                unpack = zlib.decompressobj(31)
        return True

    while True:
        while (end := buffer.find(END.encode())) < 0:
            if not more():
                if buffer.strip():
                    raise ValueError("archive ends inside a header")
                return
        head = bytes(buffer[:end]).decode("utf-8", "replace").split(CRLF)
        if not head[0].startswith("WARC/"):
            raise ValueError(f"no record at {head[0][:40]!r}")
        headers = {k.lower(): v for k, _, v in (line.partition(": ") for line in head[1:])}
        stop = end + 4 + int(headers["content-length"])
        while len(buffer) < stop + 4:
            if not more():
                raise ValueError("archive ends inside a block")
        yield headers, bytes(buffer[end + 4:stop])
        del buffer[:stop + 4]


def base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def read_chunks(spark: SparkSession, path: str) -> DataFrame:
    """The chunk table of the archives below ``path``; whole records come with their digest and no data."""
    def number(headers: dict, name: str) -> int | None:
        return int(headers[name]) if name in headers else None

    def rows(batches):
        kinds = (pa.string(), pa.int32(), pa.bool_(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary())
        names = ["record", "segment", "last", "kind", "page_id", "digest", "payload_bytes", "refers_to", "data"]

        def batch_of(out):
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names)

        for batch in batches:
            for content in batch.column(0):
                out, held = [], 0
                for headers, block in parsed(content.as_buffer().to_pybytes()):
                    kind, segment = headers["warc-type"], number(headers, "warc-segment-number")
                    record = headers.get("warc-segment-origin-id", headers["warc-record-id"])
                    total = number(headers, "warc-segment-total-length")
                    digest = headers.get("warc-payload-digest", "").removeprefix("sha1:") or None
                    if kind != "continuation":
                        http, _, block = block.partition(END.encode())
                        total = int(http.rpartition(b"Content-Length: ")[2])
                    if kind == "response" and segment is None and base32(hashlib.sha1(block).digest()) != digest:
                        raise ValueError(f"payload of {record} does not have its digest")
                    if kind == "response" and segment is None and len(block) != total:
                        raise ValueError(f"payload of {record} does not have its length")
                    last = segment is None or (kind == "continuation" and "warc-segment-total-length" in headers)
                    data = block if segment is not None else None
                    out.append((record, segment or 1, last, kind if kind != "continuation" else None, number(headers, "x-page-id"),
                                digest, total, number(headers, "x-refers-to-page-id"), data))
                    held += len(data or b"") + 200
                    if held > common.CHUNK_BYTES:
                        yield batch_of(out)
                        out, held = [], 0
                if out:
                    yield batch_of(out)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")
    return files.mapInArrow(rows, CHUNKS)


def read_back(spark: SparkSession, path: str) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) per record of the archives.

    Segments are brought together in order and the SHA-1 is carried from one to the next; a missing
    segment or a wrong digest is an error. Only segments of long payloads take their bytes along.
    """
    def rows(batches):
        state = None
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                if r["segment"] == 1:
                    if state:
                        raise ValueError(f"record {state[0]['record']} is not complete")
                    state = (r, hashlib.sha1(), 0)
                lead, sha, done = state if state else ({"record": None}, None, 0)
                if lead["record"] != r["record"] or (r["data"] is not None and r["segment"] != done + 1):
                    raise ValueError(f"segment {r['segment']} of {r['record']} has no predecessor")
                if r["data"] is not None:
                    sha.update(r["data"])
                    state = (lead, sha, done + 1)
                if r["last"]:
                    if r["data"] is not None and base32(sha.digest()) != lead["digest"]:
                        raise ValueError(f"payload of {r['record']} does not have its digest")
                    out.append((lead["page_id"], lead["payload_bytes"], lead["digest"], lead["kind"], lead["refers_to"]))
                    state = None
            columns = zip(*out, strict=True) if out else [[]] * 5
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                                             ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])
        if state:
            raise ValueError(f"record {state[0]['record']} is not complete")

    ordered = read_chunks(spark, path).repartition("record").sortWithinPartitions("record", "segment")
    return ordered.mapInArrow(rows, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")


def round_trip(pages: DataFrame) -> DataFrame:
    """Writes the pages as archives into the shared folder and reads them back.

    Null html counts as empty, a null url gives a record without target, a null page_id stays null
    (it comes last among equal payloads). Of equal rows one is the response. Extra columns are ignored.
    """
    path = f"{common.stages(pages, 'warc').root}/archives"
    write_archives(pages, path)
    return read_back(pages.sparkSession, path)
