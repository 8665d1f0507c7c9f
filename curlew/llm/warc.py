"""WARC archives as a chunked record table.

``chunks`` turns payloads into rows (record id, chunk number, bytes) of at most
``chunk_bytes``, each with the SHA-1 of the payload up to its end, which a running
hash gives without a second buffer. ``write_archives`` writes every chunk as a
WARC record: the first as ``response`` (or ``revisit``, without payload), the
others as ``continuation`` with segment numbers, as the WARC standard has it for
oversized payloads. ``read_archives`` streams the records back as the same rows,
and ``records`` joins the chunks: a record of one chunk is checked where it is
read; only longer ones are brought together, chunk by chunk in order, through one
running hash, so no reading task ever holds a whole oversized record. A writing task
holds a payload once, as Spark hands it over, and copies only its chunks.

The archives are written and read by Spark's own text source with the records'
end as line separator, so they live in any store that Spark knows and a lost
executor's files are written anew by the commit protocol. A chunk is cut wherever
its payload holds ``WARC/1.1``, so that no payload can be taken for the start of
a record.

Revisits: of records with equal payloads (SHA-1 and length) of at least
``revisit_min_bytes``, the one with the smallest id is the response and the others
refer to it. The links are found on (id, digest, length) rows alone.

Defined results: a null payload is empty; rows that repeat an id are records of
their own, told apart only by their place; a null id is the last in order and is
never referred to; a null url leaves out the target header; line ends in a url are
percent-encoded; an empty table gives an empty archive.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from curlew.llm.common import stored

VERSION = "WARC/1.1"
END = "\r\n\r\n"
_MARK = re.compile(re.escape(VERSION.encode()))
_RFC4648, _HEX32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", "0123456789ABCDEFGHIJKLMNOPQRSTUV"
_HEADERS = "row string, kind string, segment int, segments int, length long, total long, digest string, prefix string, refers string, uri string"


def base32_sha1(payload: Column) -> Column:
    """Upper-case base32 of the SHA-1, in JVM expressions: ten hex digits are eight
    base32 digits."""
    digest = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(digest, i, 10), 16, 32), 8, "0") for i in (1, 11, 21, 31)]
    return F.translate(F.upper(F.concat(*parts)), _HEX32, _RFC4648)


def cuts(payload: memoryview, chunk_bytes: int, text: bool) -> Iterator[tuple[int, int]]:
    """Bounds of the chunks: at most ``chunk_bytes`` each, none with the version
    mark inside, and no character of a text is split. One empty chunk for an empty payload."""
    at, found = 0, _MARK.search(payload)
    while True:
        end = min(len(payload), at + chunk_bytes)
        if found and found.start() < end:
            end = found.start() + 4
            found = _MARK.search(payload, end)
        elif text:
            while at + 4 < end < len(payload) and payload[end] & 0xC0 == 0x80:
                end -= 1
        yield at, end
        at = end
        if at >= len(payload):
            return


def _b32(sha) -> str:
    return base64.b32encode(sha.digest()).decode()


def _writer(chunk_bytes: int, date: str):
    def run(batches):
        for batch in batches:
            out: list[bytes] = []
            held = 0
            cols = [batch.column(i) for i in range(batch.num_columns)]
            for row, url, payload, kind, refers, digest, total in zip(*cols, strict=True):
                row, url, kind, refers, digest, total = (x.as_py() for x in (row, url, kind, refers, digest, total))
                name = "" if row is None else str(row)
                # the batch's own bytes, not a copy
                view = memoryview(b"" if kind == "revisit" or not payload.is_valid else payload.as_buffer()).cast("B")
                sha = hashlib.sha1()
                bounds = list(cuts(view, chunk_bytes, True))
                base = f"curlew:{name}:{digest}"
                for k, (a, b) in enumerate(bounds):
                    sha.update(view[a:b])
                    head = [VERSION, f"WARC-Type: {kind if k == 0 else 'continuation'}", f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{base}:{k}')}>", f"WARC-Date: {date}"]
                    if url is not None:
                        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
                    if len(bounds) > 1:
                        head += [f"WARC-Segment-Number: {k + 1}", f"X-Segments: {len(bounds)}"]
                        if k:
                            head.append(f"WARC-Segment-Origin-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{base}:0')}>")
                    if refers is not None:
                        head += [f"WARC-Refers-To: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'curlew:{refers}:{digest}:0')}>", f"X-Refers-To-Row: {refers}",
                                 "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
                    head += [f"WARC-Payload-Digest: sha1:{digest}", f"X-Prefix-Digest: sha1:{_b32(sha)}", f"X-Payload-Length: {total}", f"X-Row: {name}",
                             "Content-Type: text/html", f"Content-Length: {b - a}", "", ""]
                    out.append("\r\n".join(head).encode() + view[a:b])
                    held += b - a
                    if held >= 4 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])
                        out, held = [], 0
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])
    return run


def link_revisits(pages: DataFrame, id_col: str, payload_col: str, revisit_min_bytes: int = 0) -> DataFrame:
    """(id, refers) of the revisits alone, stored: groups of equal payloads are
    counted by partial sums; only the small rows of repeated digests meet."""
    body = F.coalesce(F.col(payload_col), F.lit("")).cast("binary")
    small = stored(pages.select(F.col(id_col).alias("id"), F.unhex(F.sha1(body)).alias("sha"), F.octet_length(body).alias("n")), "warc-digests")
    first = small.where((F.col("n") >= revisit_min_bytes) & F.col("id").isNotNull()).groupBy("sha", "n").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("rows"))
    many = first.where("rows > 1").drop("rows")
    return stored(small.join(many, ["sha", "n"]).where("id <> first").select("id", F.col("first").alias("refers")).distinct(), "warc-revisits")


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
                   revisit_min_bytes: int = 0, chunk_bytes: int = 1 << 20, date: str = "1970-01-01T00:00:00Z",
                   compression: str = "gzip") -> None:
    """Write one archive file for each partition of ``pages``."""
    body = F.coalesce(F.col(payload_col), F.lit("")).cast("binary")
    links = link_revisits(pages, id_col, payload_col, revisit_min_bytes)
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"), body.alias("payload")).join(links, "id", "left")
    rows = rows.select("id", "url", "payload", F.when(F.col("refers").isNull(), "response").otherwise("revisit").alias("kind"),
                       "refers", base32_sha1(F.col("payload")).alias("digest"), F.octet_length("payload").cast("long").alias("total"))
    rows.mapInArrow(_writer(chunk_bytes, date), "value binary").select(F.col("value").cast("string").alias("value")) \
        .write.option("lineSep", END).option("compression", compression).text(path)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """The chunk rows: row, kind, segment, segments, length, total, digest, prefix,
    refers, uri and the chunk's bytes. Raises if a record is shorter than it says."""
    raw = spark.read.option("lineSep", END + VERSION + "\r\n").schema("value string").text(path)
    at = F.instr("value", END)
    head = F.substring(F.col("value"), F.lit(1), at)

    def field(name: str) -> Column:
        got = F.regexp_extract(head, rf"(?:^|\n){name}: ([^\r\n]*)", 1)
        return F.when(got != "", got)

    length = field("Content-Length").cast("long")
    data = F.col("value").cast("binary")
    body = F.expr("substring(bytes, octet_length(head) + 4, cast(length as int))")
    rows = raw.where(at > 0).select(
        data.alias("bytes"), head.alias("head"), field("X-Row").alias("row"), field("WARC-Type").alias("kind"),
        F.coalesce(field("WARC-Segment-Number").cast("int"), F.lit(1)).alias("segment"), F.coalesce(field("X-Segments").cast("int"), F.lit(1)).alias("segments"),
        length.alias("length"), field("X-Payload-Length").cast("long").alias("total"), F.substring_index(field("WARC-Payload-Digest"), ":", -1).alias("digest"),
        F.substring_index(field("X-Prefix-Digest"), ":", -1).alias("prefix"), field("X-Refers-To-Row").alias("refers"), field("WARC-Target-URI").alias("uri"))
    rows = rows.withColumn("chunk", body)
    wrong = F.octet_length("chunk") != F.col("length")
    return rows.withColumn("chunk", F.when(wrong, F.raise_error(F.lit("WARC record is shorter than its Content-Length")).cast("binary")).otherwise(F.col("chunk"))).drop("bytes", "head")


def _joined(batches):
    """Chunks in order, through one running hash: a row for each record."""
    key, sha, size, want = None, None, 0, 0
    for batch in batches:
        out = []
        for x, chunk in zip(batch.drop_columns(["chunk"]).to_pylist(), batch.column("chunk"), strict=True):
            if x["segment"] == 1:
                key, sha, size, want = (x["row"], x["digest"]), hashlib.sha1(), 0, 1
            if key != (x["row"], x["digest"]) or x["segment"] != want:
                raise ValueError(f"WARC record {x['row']}: segment {x['segment']} where {want} is due")
            sha.update(chunk.as_buffer())
            size, want = size + x["length"], want + 1
            if _b32(sha) != x["prefix"]:
                raise ValueError(f"WARC record {x['row']}: digest differs at segment {x['segment']}")
            if x["segment"] == x["segments"]:
                out.append({"row": x["row"], "payload_bytes": size, "payload_digest": _b32(sha), "kind": "response", "refers": None})
        yield pa.RecordBatch.from_pylist(out, pa.schema([("row", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("kind", pa.string()), ("refers", pa.string())]))


def records(chunks: DataFrame) -> DataFrame:
    """row, payload_bytes, payload_digest, kind, refers: one row for each record.
    Records that repeat row and payload in several chunks cannot be told apart by
    their headers; they are counted by their first chunk."""
    out = "row string, payload_bytes long, payload_digest string, kind string, refers string"
    one = chunks.where("segments = 1").select(
        "row", F.when(F.col("kind") == "revisit", F.col("total")).otherwise(F.col("length")).alias("payload_bytes"),
        F.when(F.col("kind") == "revisit", F.col("digest")).otherwise(base32_sha1(F.col("chunk"))).alias("payload_digest"), "kind", "refers")
    many = chunks.where("segments > 1")
    copies = many.where("segment = 1").groupBy("row", "digest").agg(F.count(F.lit(1)).alias("copies"))
    whole = many.select("row", "digest", "segment", "segments", "length", "prefix", "chunk").dropDuplicates(["row", "digest", "segment"]) \
        .repartition("row", "digest").sortWithinPartitions("row", "digest", "segment").mapInArrow(_joined, out)
    whole = whole.alias("w").join(copies.alias("c"), F.expr("w.row <=> c.row AND w.payload_digest = c.digest")) \
        .withColumn("copies", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("w.*")
    return one.unionByName(whole)
