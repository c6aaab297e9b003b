"""WARC archives of pages: written as records, read back, and assembled into one row per capture.

A capture that is written has three records: the response (or a revisit, if a later page has the same payload), the
request and metadata, both of which name the first one in WARC-Concurrent-To. Archives are gzipped files in the shared
folder, written by Spark's text sink with the two line ends that close a record as its separator; files are bounded by
bytes, as each is read whole. Reading goes by Content-Length, so payloads may hold anything.

Archives of others may name any record of a capture from any other, several times: records meet in the connected parts
of these links, and a capture has arrays of its requests and metadata. Digests may be in hexadecimal or base 32. What
can't be read is reported in ``problem`` and stops nothing but its own record, or the rest of its file.

Of records with equal payloads of at least ``least_bytes`` the one with the largest page_id is the response and the
others refer to it; smaller payloads are all responses.

Defined results: a null payload is empty; a null url leaves the target out. Rows that repeat a page_id and a payload are
one capture; a page_id with several payloads has one capture for each. Rows without a page_id are captures too
(one for each payload), with a null page_id, and refer or are referred to like the smallest id. Other columns are
ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .graph import components
from .storage import broadcast_up_to, shared_folder, stored

END = "\r\n"
SMALL_ROWS = 50_000  # up to here the table of revisits (100 bytes a row) is broadcast
FILE_BYTES = 128 << 20  # of payload in an archive, or one page
SIZES = [1 << 16, 1 << 20, 1 << 24, FILE_BYTES]  # pages up to these sizes are written to files of their own
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def record_id(page: Column, digest: Column) -> Column:
    """A URN that a page and its payload always get."""
    h = F.md5(F.concat_ws("/", F.coalesce(page.cast("string"), F.lit("none")), digest))
    return F.concat(F.lit("urn:uuid:"), F.regexp_replace(h, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5"))


def _record(kind: str, headers: list[tuple[str, Column | None]], block: Column) -> Column:
    lines = [F.lit(f"WARC/1.1{END}WARC-Type: {kind}{END}")]
    for name, value in headers:
        lines.append(F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(END)), F.lit("")))
    length = F.octet_length(block).cast("string")
    return F.concat(*lines, F.lit("Content-Length: "), length, F.lit(END + END), block)


def write_archives(
    pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", text_col: str = "html",
    least_bytes: int = 1000, date: str = "2000-01-01T00:00:00Z",
) -> None:
    rows = pages.select(
        F.col(id_col).cast("long").alias("page"),
        # a header is one line
        F.regexp_replace(F.col(url_col).cast("string"), r"[\x00-\x20]", "%20").alias("url"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("payload"),
    ).withColumn("digest", F.sha1(F.col("payload").cast("binary")))
    bytes_ = F.octet_length("payload")
    equal = rows.where(bytes_ >= least_bytes).select("page", "digest").groupBy("digest")
    heads = equal.agg(F.max("page").alias("head"), F.min("page").alias("least"), F.count_if(F.col("page").isNull()).alias("nulls"))
    heads = heads.where("least < head or (nulls > 0 and head is not null)").select("digest", "head")
    revisits = rows.where(bytes_ >= least_bytes).select("page", "digest").join(heads, "digest").where("not page <=> head").distinct()
    revisits = revisits.select(F.col("page").alias("r_page"), F.col("digest").alias("r_digest"), "head")
    rows = rows.join(broadcast_up_to(revisits, SMALL_ROWS), F.col("page").eqNullSafe(F.col("r_page")) & (F.col("digest") == F.col("r_digest")), "left")

    own = record_id(F.col("page"), F.col("digest"))
    wrapped = lambda c: F.concat(F.lit("<"), c, F.lit(">"))
    date_, target = F.lit(date), F.col("url")
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{END}Content-Type: text/html; charset=utf-8{END}Content-Length: "), bytes_.cast("string"), F.lit(END + END)
    )
    common = [("WARC-Record-ID", wrapped(own)), ("WARC-Date", date_), ("WARC-Target-URI", target)]
    digest = ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest")))
    kind = ("Content-Type", F.lit("application/http; msgtype=response"))
    refers = ("WARC-Refers-To", wrapped(record_id(F.col("head"), F.col("digest"))))
    response = _record("response", [*common, digest, kind], F.concat(http, F.col("payload")))
    revisit = _record("revisit", [*common, digest, ("WARC-Profile", F.lit(PROFILE)), refers, kind], http)

    def beside(name: str, what: str, block: Column) -> Column:
        mine = F.concat(F.lit("urn:uuid:"), F.substring_index(own, ":", -1), F.lit(f"-{name}"))
        return _record(
            name,
            [("WARC-Record-ID", wrapped(mine)), ("WARC-Date", date_), ("WARC-Target-URI", target), ("WARC-Concurrent-To", wrapped(own)), ("Content-Type", F.lit(what))],
            block,
        )

    path = F.coalesce(F.regexp_extract(target, r"^[a-z]+://[^/]*(/.*)$", 1), F.lit(""))
    host = F.coalesce(F.regexp_extract(target, r"^[a-z]+://([^/]*)", 1), F.lit(""))
    request = F.concat(F.lit("GET "), F.when(path == "", "/").otherwise(path), F.lit(f" HTTP/1.1{END}Host: "), host, F.lit(END + END))
    fields = F.concat(F.coalesce(F.concat(F.lit("page-id: "), F.col("page").cast("string"), F.lit(END)), F.lit("")), F.lit(f"fetch: complete{END}"))
    three = F.concat(
        beside("request", "application/http; msgtype=request", request), F.lit(END + END),
        F.when(F.col("r_digest").isNull(), response).otherwise(revisit), F.lit(END + END),
        beside("metadata", "application/warc-fields", fields),
    )
    size = F.lit(len(SIZES))
    for i in reversed(range(len(SIZES))):
        size = F.when(bytes_ <= SIZES[i], i).otherwise(size)
    there = [r.size for r in pages.select(F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("payload")).select(size.alias("size")).distinct().collect()]
    for i in sorted(there) or [0]:
        most = max(1, FILE_BYTES // SIZES[i]) if i < len(SIZES) else 1
        own = rows if len(there) < 2 else rows.where(size == i)
        own.select(three.alias("value")).write.mode("append").option("lineSep", END + END).option("compression", "gzip").option("maxRecordsPerFile", most).text(folder)


class _Stream:
    """Bytes of a gzipped file (also of several members), read in pieces."""

    def __init__(self, data: memoryview, step: int = 1 << 20):
        self.data, self.at, self.step, self.buffer = data, 0, step, bytearray()
        self.inflate = zlib.decompressobj(31)

    def more(self) -> bool:
        if self.at >= len(self.data):
            return False
        piece = self.data[self.at : self.at + self.step]
        self.at += len(piece)
        while piece:
            self.buffer += self.inflate.decompress(piece)
            piece = self.inflate.unused_data
            if self.inflate.eof:
                self.inflate = zlib.decompressobj(31)
        return True

    def until(self, mark: bytes) -> bytes | None:
        seen = 0
        while (found := self.buffer.find(mark, max(0, seen - len(mark)))) < 0:
            seen = len(self.buffer)
            if not self.more():
                return None
        return self.take(found + len(mark))

    def take(self, n: int) -> bytes:
        while len(self.buffer) < n and self.more():
            pass
        if len(self.buffer) < n:
            raise ValueError("the archive ends inside a record")
        out = bytes(self.buffer[:n])
        del self.buffer[:n]
        return out


def records(data: bytes) -> Iterator[tuple[dict[str, list[str]], bytes]]:
    """(values of each header by its name in lower case, block) of each record of an archive."""
    stream = _Stream(memoryview(data))
    while (head := stream.until(b"\r\n\r\n")) is not None:
        lines = head.decode().strip().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError("no record where one should start")
        headers: dict[str, list[str]] = {}
        for name, _, value in (x.partition(":") for x in lines[1:]):
            headers.setdefault(name.strip().lower(), []).append(value.strip())
        if "content-length" not in headers:
            raise ValueError("a record without its length")
        block = stream.take(int(headers["content-length"][0]))
        if stream.take(4) != b"\r\n\r\n":
            raise ValueError("a record does not end where its length says")
        yield headers, block


RECORDS = (
    "kind string, record_id string, concurrent_to array<string>, refers_to string, target string, date string, digest string, "
    "payload_bytes long, payload binary, block string, problem string"
)


def _parsed(with_payload: bool):
    import base64
    import hashlib

    names = [x.split()[0] for x in RECORDS.split(", ")]
    special = {"payload_bytes": pa.int64(), "payload": pa.binary(), "concurrent_to": pa.list_(pa.string())}
    types = [special.get(n, pa.string()) for n in names]

    def batch(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    def hexadecimal(digest: str | None) -> str | None:
        """A SHA-1 in hexadecimal; other digests as they are."""
        kind, _, value = (digest or "").rpartition(":")
        if kind.lower() not in ("sha1", "sha-1"):
            return digest
        try:
            return base64.b32decode(value.upper()).hex() if len(value) == 32 else value.lower()
        except ValueError:
            return digest

    def row(head: dict[str, list[str]], block: bytes) -> tuple:
        one = lambda name: head.get(name, [None])[0]
        bare = lambda x: x and x.strip("<>")
        kind, payload, size, text, problem = one("warc-type"), None, None, None, None
        digest = hexadecimal(one("warc-payload-digest"))
        if kind in ("response", "revisit", "resource"):
            http, _, payload = block.partition(b"\r\n\r\n") if kind != "resource" else (b"", b"", block)
            if kind == "revisit":
                said = [x[15:] for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")]
                size, payload = int(said[0]) if said and said[0].strip().isdigit() else None, None
            else:
                size, own = len(payload), hashlib.sha1(payload).hexdigest()
                if digest is None:
                    digest = own
                elif ":" not in digest and digest != own:
                    problem = "payload and digest differ"
        else:
            text = block.decode(errors="replace")
        to = [bare(x) for x in head.get("warc-concurrent-to", [])]
        keep = payload if with_payload else None
        return kind, bare(one("warc-record-id")), to, bare(one("warc-refers-to")), bare(one("warc-target-uri")), one("warc-date"), digest, size, keep, text, problem

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            for data in part.column("content"):
                rows, held = [], 0
                try:
                    for head, block in records(data.as_buffer()):
                        rows.append(row(head, block))
                        held += len(block)
                        if held > 1 << 22:
                            yield batch(rows)
                            rows, held = [], 0
                except (ValueError, zlib.error) as error:
                    rows.append((*[None] * (len(names) - 1), str(error)))
                if rows:
                    yield batch(rows)

    return run


def read_archives(spark, folder: str, with_payload: bool = True) -> DataFrame:
    """All records of the archives below ``folder``; payloads are checked against their digests on the way.

    ``problem`` says what is wrong with a record; where a file can't be read on, a row of nulls has it alone.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(folder).select("content")
    return files.mapInArrow(_parsed(with_payload), RECORDS)


_MAIN = ("response", "revisit", "resource")


def capture_ids(found: DataFrame) -> DataFrame | None:
    """(record_id, capture_id) of records that more than their own first link ties to a capture; None if there is none.

    The usual record names its response and that is all; then the name is the capture. Else records are joined over all links.
    """
    main = F.col("kind").isin(*_MAIN)
    several = found.where((main & (F.size("concurrent_to") > 0)) | (F.size("concurrent_to") > 1)).limit(1).count() > 0
    named = found.where(~main & (F.size("concurrent_to") > 0)).select(F.col("concurrent_to")[0].alias("record_id")).distinct()
    if not several and named.join(found.where(main), "record_id", "left_anti").limit(1).count() == 0:
        return None
    number = found.where("record_id is not null").select("record_id").distinct()
    links = found.select("record_id", F.explode("concurrent_to").alias("other")).where("record_id is not null")
    # a response's id stands for its capture, the smallest if there are several
    parts = components(links.select(F.col("record_id").alias("u"), F.col("other").alias("v")))
    heads = found.where(main).select(F.col("record_id").alias("node")).join(parts, "node").groupBy("component").agg(F.min("node").alias("head"))
    placed = parts.join(heads, "component", "left").select(F.col("node").alias("record_id"), F.coalesce("head", "component").alias("capture_id"))
    return placed.join(number, "record_id", "left_semi")


def captures(found: DataFrame) -> DataFrame:
    """(capture_id, page_id, target, date, requests, response, metadata), one nested row per capture.

    ``found`` is stored, or cheap to read twice. Records meet over their concurrent-to links, whichever end names the
    other. Requests and metadata are in order of their record ids; equal records count once.
    """
    found = found.where("kind is not null")
    ids = capture_ids(found)
    if ids is None:
        placed = found.withColumn("capture_id", F.coalesce(F.get("concurrent_to", F.lit(0)), "record_id"))
    else:
        placed = found.join(ids, "record_id", "left").withColumn("capture_id", F.coalesce("capture_id", "record_id"))
    main = F.col("kind").isin(*_MAIN)
    first = F.min(F.when(main, F.struct("record_id", "target", "date", "kind", "refers_to", "digest", "payload_bytes", "payload", "problem"))).alias("m")
    blocks = lambda kind: F.transform(
        F.array_sort(F.collect_set(F.when(F.col("kind") == kind, F.struct("record_id", "block")))), lambda r: r["block"]
    )
    by = placed.groupBy("capture_id").agg(first, blocks("request").alias("requests"), blocks("metadata").alias("metadata"))
    return by.select(
        "capture_id",
        F.expr(r"cast(nullif(regexp_extract(array_join(metadata, '\n'), '(?m)^page-id: (-?[0-9]+)', 1), '') as long)").alias("page_id"),
        "m.target",
        "m.date",
        "requests",
        F.when(F.col("m").isNotNull(), F.struct("m.kind", "m.refers_to", "m.digest", "m.payload_bytes", "m.payload", "m.problem")).alias("response"),
        "metadata",
    )


def round_trip(pages: DataFrame, with_payload: bool = True, **columns) -> DataFrame:
    """Captures of pages that were written to archives in the shared folder and read back.

    Adds ``refers_to_page``, the page_id of the response that a revisit refers to.
    """
    spark = pages.sparkSession
    folder = shared_folder(spark, "warc")
    write_archives(pages, folder, **columns)
    light = stored(captures(stored(read_archives(spark, folder, False), "records")), "captures")
    heads = light.where("response.kind = 'response'").select(F.col("capture_id").alias("head_id"), F.col("page_id").alias("refers_to_page"))
    named = light.where("response.kind = 'revisit'").select(F.col("response.refers_to").alias("head_id")).distinct().join(heads, "head_id")
    found = captures(stored(read_archives(spark, folder), "records")) if with_payload else light
    return found.join(named, F.col("response.refers_to") == F.col("head_id"), "left").drop("head_id")
