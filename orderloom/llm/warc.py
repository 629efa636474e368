"""WARC archives: writing with segments and revisits, and reassembly on reading."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from orderloom.llm.stages import attach, stage

#: Payloads below this size are always written in full.
REVISIT_BYTES = 1000
#: Largest block of one record; longer ones go on in continuation records.
SEGMENT_BYTES = 8192
CHUNK_BYTES = 4096
#: Records per file; with the segment size it bounds what one read holds.
FILE_RECORDS = 2000
#: Bytes of a file that are decompressed at a time.
READ_BYTES = 4096
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
_PARSED = (
    "origin string, type string, number bigint, total bigint, refers_to string, digest string, block binary"
)
_MEASURED = f"{_PARSED}, size bigint, sha1 string"
_WHOLE = "origin string, type string, digest string, block binary"
_WHOLE_TYPES = [pa.string(), pa.string(), pa.string(), pa.binary()]


def chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    parts = []
    for at in range(0, len(payload), size):
        piece = payload[at : at + size]
        parts += [b"%x\r\n" % len(piece), piece, b"\r\n"]
    return b"".join([*parts, b"0\r\n\r\n"])


def dechunked(body: bytes) -> bytes:
    """The payload of a chunked body; chunk extensions and trailers are skipped."""
    parts, at = [], 0
    while True:
        end = body.index(b"\r\n", at)
        size = int(body[at:end].split(b";")[0], 16)
        if not size:
            return b"".join(parts)
        if body[end + 2 + size : end + 4 + size] != b"\r\n":
            raise ValueError("a chunk does not end where its size says")
        parts.append(body[end + 2 : end + 2 + size])
        at = end + 4 + size


def _record(block: bytes, **fields) -> bytes:
    """Header, block and the two line ends of one record."""
    named = {k.replace("_", "-"): v for k, v in fields.items() if v is not None}
    lines = [b"WARC/1.1", *(f"{k}: {v}".encode() for k, v in named.items()), b"Content-Length: %d" % len(block)]
    return b"\r\n".join(lines) + b"\r\n\r\n" + block + b"\r\n\r\n"


def _member(record: bytes) -> bytes:
    """A record as a gzip member of its own, without the last byte.

    That byte is the highest of the record's size, zero below 16 MB. A text file whose
    lines end in a zero byte supplies it, so the lines of Spark's text writer are members.
    """
    if len(record) >= 1 << 24:
        raise ValueError("a record of 16 MB or more; write smaller segments")
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return (packer.compress(record) + packer.flush())[:-1]


def inflated(data: bytes) -> bytes:
    """The contents of a file: all gzip members of it, one after another, or itself if it has none."""
    if data[:2] != b"\x1f\x8b":
        return data
    parts, view, at = [], memoryview(data), 0
    while view[at : at + 2] == b"\x1f\x8b":
        member = zlib.decompressobj(31)
        # What is left over behind a member is copied, so a member is not given the whole rest.
        while not member.eof:
            if at >= len(view):
                raise ValueError("a gzip member does not end")
            piece = view[at : at + READ_BYTES]
            parts.append(member.decompress(piece))
            at += len(piece) - len(member.unused_data)
    if bytes(view[at:]).strip(b"\0"):
        raise ValueError("other data behind gzip members")
    return b"".join(parts)


def _records(batches: Iterator[pa.RecordBatch], segment: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out: list[bytes] = []
        for own, url, digest, target, payload in zip(*(c.to_pylist() for c in batch.columns)):
            common = {"WARC_Date": DATE, "WARC_Target_URI": None if url is None else "".join(url.split())}
            if target is not None:
                out.append(_record(
                    _HTTP, WARC_Type="revisit", WARC_Record_ID=own, WARC_Profile=PROFILE, WARC_Refers_To=target,
                    WARC_Payload_Digest=f"sha1:{digest}", Content_Type="application/http; msgtype=response", **common,
                ))
                continue
            block = _HTTP + chunked(payload)
            many = len(block) > segment
            for number, at in enumerate(range(0, len(block), segment), 1):
                piece = block[at : at + segment]
                last = many and at + segment >= len(block)
                first = number == 1
                out.append(_record(
                    piece, WARC_Type="response" if first else "continuation",
                    WARC_Record_ID=own if first else f"{own[:-1]}:{number}>",
                    WARC_Segment_Number=number if many else None, WARC_Segment_Origin_ID=None if first else own,
                    WARC_Segment_Total_Length=len(block) if last else None,
                    WARC_Payload_Digest=f"sha1:{digest}" if first else None,
                    Content_Type="application/http; msgtype=response" if first else None, **common,
                ))
        for at in range(0, len(out), 4096):
            yield pa.RecordBatch.from_arrays([pa.array([_member(r) for r in out[at : at + 4096]], pa.binary())], ["record"])


def write_archives(
    pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", body_col: str = "html",
    revisit_bytes: int = REVISIT_BYTES, segment_bytes: int = SEGMENT_BYTES, file_records: int = FILE_RECORDS,
) -> None:
    """Write one record per page, and its continuations, as WARC files in ``path``, a gzip member per record.

    Of equal payloads of ``revisit_bytes`` or more a row with the largest id is written,
    the others revisit it. Payloads (null: empty) are framed as chunked HTTP and cut at
    ``segment_bytes``. A null id is written without a number and counts as the smallest.
    Rows that repeat an id and payload are records of their own, with a number in the
    record's id; such rows go to a table without their payloads first, so that the numbers
    stay when a task runs again. Spark's text writer writes the files, so any store works;
    their names end in ``.txt`` for that reason. Segments must be shorter than 16 MB.
    """
    payload = F.coalesce(F.col(body_col), F.lit("")).cast("binary")
    own = F.concat(F.lit("<urn:page:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit(":"), F.sha1(payload), F.lit(">"))
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), payload.alias("payload"), F.sha1(payload).alias("digest"), own.alias("own"))
    large = F.octet_length("payload") >= revisit_bytes
    keys = stage(rows.groupBy("id", "digest", "own", large.alias("large")).agg(F.count("*").alias("times")), "payloads")
    # No id is the smallest.
    groups = stage(keys.where("large").groupBy("digest").agg(F.max(F.struct("id", "own"))["own"].alias("target"), F.count("*").alias("n")), "groups")
    revisits = attach(keys.where("large"), groups, "digest", "n").where("own <> target").select("own", "target")
    odd = keys.join(revisits, "own", "left").where("target IS NOT NULL OR times > 1").select(F.col("own").alias("odd_own"), "target", "large", "times")
    odd = stage(odd, "decided")
    # A revisit carries no payload.
    lean = F.when(F.col("target").isNull(), F.col("payload"))
    known = rows.join(odd, F.col("own") == F.col("odd_own"), "left")
    once = known.where(F.coalesce("times", F.lit(1)) == 1).select("own", "url", "digest", "target", lean.alias("payload"))
    records = once.unionByName(_repeats(rows, odd)).mapInArrow(lambda batches: _records(batches, segment_bytes), "record binary")
    (
        records.select(F.col("record").cast("string")).write.option("lineSep", "\0")
        .option("compression", "none").option("maxRecordsPerFile", file_records).text(path)
    )


def _repeats(rows: DataFrame, odd: DataFrame) -> DataFrame:
    """(own, url, digest, target, payload) of rows that repeat an id and payload, each with an own record id.

    Small ones are responses. Of large ones the first keeps the plain record id, as a
    response or revisit like a row that does not repeat; the others revisit what it does,
    or else it.
    """
    again = odd.where("times > 1")
    none = odd.sparkSession.createDataFrame([], "own string, url string, digest string, target string, payload binary")
    if again.isEmpty():
        return none
    small = F.when(~F.col("large"), F.col("payload"))
    copies = stage(
        attach(rows, again.withColumnRenamed("odd_own", "own"), "own", "times").select("own", "url", "digest", "target", "large", small.alias("payload"))
        .withColumn("number", F.monotonically_increasing_id()),
        "repeats",
    )
    firsts = stage(copies.groupBy("own").agg(F.min("number").alias("first"), F.count("*").alias("n")), "firsts")
    met = attach(copies, firsts, "own", "n")
    first = F.col("number") == F.col("first")
    numbered = F.concat(F.expr("substring(own, 1, length(own) - 1)"), F.lit(":"), F.col("number").cast("string"), F.lit(">"))
    target = F.when(F.col("large"), F.coalesce("target", F.when(~first, F.col("own"))))
    rest = met.where(~(first & F.col("large") & F.col("target").isNull())).select(
        F.when(first, F.col("own")).otherwise(numbered).alias("own"), "url", "digest", target.alias("target"), "payload"
    )
    # The payload of each large response comes once, from any of its rows: they are equal.
    heads = met.where(first & F.col("large") & F.col("target").isNull()).select("own", "url", "digest")
    bodies = rows.select("own", "payload").join(heads.select("own"), "own", "left_semi").dropDuplicates(["own"])
    return rest.unionByName(heads.join(bodies, "own").select("own", "url", "digest", F.lit(None).cast("string").alias("target"), "payload"))


def parse(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields in lower case, block) of every record in a WARC file's bytes."""
    at = 0
    while at < len(data):
        head = data.index(b"\r\n\r\n", at)
        version, *lines = data[at:head].decode("utf-8", "replace").split("\r\n")
        if not version.startswith("WARC/"):
            raise ValueError("no WARC record where one should start")
        fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
        size = int(fields["content-length"])
        block = data[head + 4 : head + 4 + size]
        if len(block) < size or data[head + 4 + size : head + 8 + size] != b"\r\n\r\n":
            raise ValueError("a record does not end where its length says")
        yield fields, block
        at = head + 8 + size


def _joined(rows: Iterator[tuple]) -> Iterator[tuple]:
    """Parsed rows, with segments that follow each other and are all there put together.

    Others, such as those of a record that goes on in the next file, stay as they are.
    """
    held: list[tuple] = []
    for row in rows:
        origin, kind, number, total, *_ = row
        if held and (origin != held[0][0] or number != len(held) + 1):
            yield from held
            held = []
        if not held and (number != 1 or kind == "continuation"):
            yield row
            continue
        held.append(row)
        if total is None:
            continue
        if sum(len(r[6]) for r in held) == total:
            yield origin, held[0][1], None, None, None, next((r[5] for r in held if r[5]), None), b"".join(r[6] for r in held)
        else:
            yield from held
        held = []
    yield from held


def _parsed(batches: Iterator[pa.RecordBatch], measured: bool = False) -> Iterator[pa.RecordBatch]:
    """Rows of the records in each file; ``measured`` has size and digest of a whole response, not its block."""
    number = lambda v: None if v is None else int(v)
    schema = _MEASURED if measured else _PARSED
    fields = [(c.split()[0], {"string": pa.string(), "bigint": pa.int64(), "binary": pa.binary()}[c.split()[1]]) for c in schema.split(", ")]
    for batch in batches:
        for content in batch.column(0):
            data = inflated(content.as_py())
            rows = _joined(
                (
                    f.get("warc-segment-origin-id", f["warc-record-id"]), f["warc-type"], number(f.get("warc-segment-number")),
                    number(f.get("warc-segment-total-length")), f.get("warc-refers-to"),
                    f.get("warc-payload-digest", "").removeprefix("sha1:") or None, block,
                )
                for f, block in parse(data)
            )
            rows = [_measure(row) for row in rows] if measured else list(rows)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, (_, t) in zip(zip(*rows) if rows else [[]] * len(fields), fields)], [name for name, _ in fields]
            )


def _measure(row: tuple) -> tuple:
    *known, block = row
    if known[2] is not None:
        return *known, block, None, None
    if known[1] != "response":
        return *known, None, None, None
    payload = _payload(block)
    return *known, None, len(payload), hashlib.sha1(payload).hexdigest()


def _payload(block: bytes) -> bytes:
    head, _, body = block.partition(b"\r\n\r\n")
    return dechunked(body) if b"transfer-encoding: chunked" in head.lower() else body


def _digested(block: Column) -> Column:
    @F.pandas_udf("size bigint, sha1 string")
    def of(blocks: pd.Series) -> pd.DataFrame:
        payloads = [_payload(b) for b in blocks]
        return pd.DataFrame({"size": [len(p) for p in payloads], "sha1": [hashlib.sha1(p).hexdigest() for p in payloads]})

    return of(block)


def _decoded(block: Column) -> Column:
    @F.pandas_udf("binary")
    def of(blocks: pd.Series) -> pd.Series:
        return pd.Series([_payload(b) for b in blocks])

    return of(block)


def _assembled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments that come sorted by origin and number, put together one record at a time."""
    names = [c.split()[0] for c in _WHOLE.split(", ")]

    def done(origin: str, kind: str | None, digest: str | None, total: int | None, pieces: list[bytes], numbers: list[int]) -> pa.RecordBatch:
        if kind is None or numbers != list(range(1, len(numbers) + 1)) or sum(map(len, pieces)) != total:
            raise ValueError(f"incomplete segments of {origin}")
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip((origin, kind, digest, b"".join(pieces)), _WHOLE_TYPES)], names)

    own = None
    for batch in batches:
        for origin, kind, number, total, digest, piece in zip(*batch.columns):
            if own is None or origin.as_py() != own[0]:
                if own is not None:
                    yield done(*own)
                own = [origin.as_py(), None, None, None, [], []]
            if kind.as_py() != "continuation":
                own[1] = kind.as_py()
            own[2], own[3] = own[2] or digest.as_py(), total.as_py() if total.as_py() is not None else own[3]
            own[4].append(piece.as_py())
            own[5].append(number.as_py())
    if own is not None:
        yield done(*own)


def read_records(spark, path: str) -> DataFrame:
    """(origin, type, refers_to, digest, block) of every record, its segments put together.

    Segments that follow each other in a file are put together there. The others are
    dealt out by the id of the record they continue, sorted by number, and
    streamed: a task holds the record it puts together and the batch it reads. None may be
    missing, and their lengths must give the stated total; else an error is raised. Records
    without segments are not shuffled. Files may be plain, or of any number of gzip members.
    """
    found = _files(spark, path).mapInArrow(_parsed, _PARSED)
    whole = found.where(F.col("number").isNull()).select("origin", "type", "refers_to", "digest", "block")
    joined = _gathered(found)
    return whole.unionByName(joined.select("origin", "type", F.lit(None).cast("string").alias("refers_to"), "digest", "block"))


def _files(spark, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("content")


def _gathered(found: DataFrame) -> DataFrame:
    """(origin, type, digest, block) of the records whose segments are still apart."""
    parts = found.where(F.col("number").isNotNull()).select("origin", "type", "number", "total", "digest", "block")
    return parts.repartition("origin").sortWithinPartitions("origin", "number").mapInArrow(_assembled, _WHOLE)


def payloads(records: DataFrame) -> DataFrame:
    """(origin, payload) of all responses, HTTP framing taken off."""
    return records.where("type = 'response'").select("origin", _decoded(F.col("block")).alias("payload"))


def page_records(spark, path: str) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to), read from archives.

    Size and digest are those of the decoded payload; a revisit has those of the response
    that it refers to, which must agree with the digest it states. Files are parsed once:
    whole responses are measured where they are read, and only segments that are still
    apart keep their bytes.
    """
    number = lambda c: F.regexp_extract(c, r"^<urn:page:(-?[0-9]*):", 1).try_cast("bigint")
    found = stage(_files(spark, path).mapInArrow(lambda batches: _parsed(batches, measured=True), _MEASURED), "records")
    whole, gathered = found.where("number IS NULL"), stage(_gathered(found), "gathered")
    apart = gathered.where("type = 'response'").select("origin", _digested(F.col("block")).alias("d")).select("origin", "d.size", "d.sha1")
    responses = stage(
        whole.where("type = 'response'").select("origin", "size", "sha1").unionByName(apart)
        .withColumnsRenamed({"size": "payload_bytes", "sha1": "payload_digest"}), "responses",
    )
    revisits = whole.where("type = 'revisit'").select("origin", F.col("refers_to").alias("target"), "digest").unionByName(
        gathered.where("type = 'revisit'").select("origin", F.lit(None).cast("string").alias("target"), "digest")
    )
    counted = revisits.groupBy("target").agg(F.count("*").alias("n"))
    targets = stage(responses.withColumnRenamed("origin", "target").join(counted, "target"), "targets")
    met = attach(revisits, targets, "target", "n")
    agreed = F.when(F.col("digest") == F.col("payload_digest"), F.col("payload_digest")).otherwise(
        F.raise_error(F.concat(F.lit("digests differ in "), F.col("origin")))
    )
    return responses.select(
        number("origin").alias("page_id"), "payload_bytes", "payload_digest",
        F.lit("response").alias("record_type"), F.lit(None).cast("bigint").alias("refers_to"),
    ).unionByName(met.select(
        number("origin").alias("page_id"), "payload_bytes", agreed.alias("payload_digest"),
        F.lit("revisit").alias("record_type"), number("target").alias("refers_to"),
    ))
