"""Legacy ARC archives as WARC archives, with equal payloads as revisits.

Archives are plain files, gzip or not, that Spark's own sinks write and its
binary reader reads, so any store that Spark reaches will do.  Records are cut
by their declared lengths, one at a time, and never by what is in them.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from leadpipe.llm import words as W
from leadpipe.operators.relational import same_key
from leadpipe.session import scratch_path

# Records of an archive that `write_arc` writes, its version block aside.
ARC_RECORDS = 1000
# Smaller payloads are never told to repeat another one.
LEAST_REVISIT = 100
FLUSH_BYTES = 1 << 20

# Fixed values of the formats: URL-record definitions by version, and the revisit profile.
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

INDEX = (
    "archive string, place long, error string, record_id string, url string, date string, mime string, "
    "payload_bytes long, digest string, sort_key string"
)
RECORDS = (
    "archive string, place long, error string, record_type string, record_id string, url string, date string, "
    "refers_to string, stated_digest string, payload_bytes long, digest string, sort_key string"
)


# --- writing ARC ---------------------------------------------------------------


def http_response(body: Column, headers: dict[str, Column]) -> Column:
    """An HTTP response with a UTF-8 body as one text."""
    lines = [F.concat(F.lit(f"{name}: "), F.coalesce(value.cast("string"), F.lit(""))) for name, value in headers.items()]
    return F.concat_ws(
        "\r\n",
        F.lit("HTTP/1.1 200 OK"),
        F.lit("Content-Type: text/html; charset=utf-8"),
        F.concat(F.lit("Content-Length: "), F.octet_length(body).cast("string")),
        *lines,
        F.lit(""),
        body,
    )


def write_arc(rows: DataFrame, path: str, date: str = "20170331000000", records: int = ARC_RECORDS) -> None:
    """Write `url` and `document` (the network document, a text) as ARC files.

    Every `records` rows start a new file, which begins with its version block;
    files are of version 1 and 2 in turn.  Blanks in an URL are encoded, a null
    one is `unknown:`.  Each task writes its own rows, nothing is shuffled.
    """
    nth = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    version = (F.floor(nth / records) % 2 + 1).cast("int")
    url = F.regexp_replace(F.coalesce(F.col("url").cast("string"), F.lit("unknown:")), r"[\s\x00]", "%20")
    size = F.octet_length("document").cast("string")
    line = F.when(
        version == 1, F.concat_ws(" ", url, F.lit("0.0.0.0"), F.lit(date), F.lit("text/html"), size)
    ).otherwise(
        F.concat_ws(
            " ", url, F.lit("0.0.0.0"), F.lit(date), F.lit("text/html"), F.lit("200"), F.lit("-"), F.lit("-"),
            F.lit("0"), F.lit("-"), size,
        )
    )
    blocks = {v: f"{v} 0 leadpipe\n{fields}\n" for v, fields in ARC_FIELDS.items()}
    heads = {
        1: f"filedesc:archive.arc 0.0.0.0 {date} text/plain {len(blocks[1])}\n{blocks[1]}\n",
        2: f"filedesc:archive.arc 0.0.0.0 {date} text/plain 200 - - 0 archive.arc {len(blocks[2])}\n{blocks[2]}\n",
    }
    head = F.when(nth % records != 0, "").when(version == 1, heads[1]).otherwise(heads[2])
    value = F.concat(head, line, F.lit("\n"), F.col("document"))
    rows.select(value.alias("value")).write.option("maxRecordsPerFile", records).option("lineSep", "\n").option(
        "compression", "gzip"
    ).text(path)


# --- reading -------------------------------------------------------------------


class Malformed(Exception):
    pass


def opened(content: bytes) -> io.BufferedReader:
    raw = io.BytesIO(content)
    return gzip.GzipFile(fileobj=raw) if content[:2] == b"\x1f\x8b" else io.BufferedReader(raw)


def exactly(stream, size: int) -> bytes:
    data = stream.read(size)
    if len(data) < size:
        raise Malformed(f"{size} bytes declared, {len(data)} found")
    return data


def arc_records(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields, by the names the archive's version block defines, and the document of
    each record, the version block first."""
    stream = opened(content)
    fields = None
    while line := stream.readline():
        if not line.strip(b"\r\n"):
            continue
        text = line.decode("utf-8", "replace").rstrip("\r\n")
        # Until the version block is read its own line tells how many fields it has.
        names = fields or ARC_FIELDS[1 if len(text.split(" ")) == 5 else 2].split(" ")
        values = text.rsplit(" ", len(names) - 1)
        if len(values) < len(names) or not values[-1].isdigit():
            raise Malformed(f"no ARC header line: {text[:80]}")
        header = dict(zip(names, values, strict=True))
        document = exactly(stream, int(values[-1]))
        if fields is None:
            lines = document.decode("utf-8", "replace").split("\n")
            if not header["URL"].startswith("filedesc:") or len(lines) < 2 or " Archive-length" not in lines[1]:
                raise Malformed("the archive does not begin with a version block")
            fields = lines[1].strip().split(" ")
        yield header, document


def warc_records(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields, names in small letters, and the block of each record."""
    stream = opened(content)
    while line := stream.readline():
        if not line.strip(b"\r\n"):
            continue
        if not line.startswith(b"WARC/"):
            raise Malformed(f"no WARC version line: {line[:80]!r}")
        header = {}
        while (line := stream.readline()).strip(b"\r\n"):
            name, _, value = line.decode("utf-8", "replace").partition(":")
            header[name.strip().lower()] = value.strip()
        if not header.get("content-length", "").isdigit():
            raise Malformed("a record without a length")
        yield header, exactly(stream, int(header["content-length"]))


def http_parts(document: bytes) -> tuple[dict[str, str], int]:
    """Headers of an HTTP response, names in small letters, and where its body starts; 0 for
    anything else."""
    end = document.find(b"\r\n\r\n")
    if not document.startswith(b"HTTP/") or end < 0:
        return {}, 0
    lines = document[:end].decode("utf-8", "replace").split("\r\n")[1:]
    pairs = (line.partition(":") for line in lines)
    return {name.strip().lower(): value.strip() for name, _, value in pairs}, end + 4


def identifier(*parts: str) -> str:
    """A record id that depends on nothing but what is given."""
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.sha256(chr(0).join(parts).encode()).digest()[:16], version=4)}>"


def timestamp(date: str) -> str:
    """A 14-digit ARC date as a WARC date; shorter ones are filled with the earliest time."""
    digits = date + "00000101000000"[len(date) :] if date.isdigit() and 4 <= len(date) <= 14 else "19700101000000"
    y, m, d, h, i, s = digits[:4], *(digits[k : k + 2] for k in range(4, 14, 2))
    return f"{y}-{m}-{d}T{h}:{i}:{s}Z"


def archives(spark: SparkSession, path: str) -> DataFrame:
    """The files below a path as `archive`, the name, and `content`."""
    files = spark.read.format("binaryFile").load(path)
    return files.select(F.element_at(F.split("path", "/"), -1).alias("archive"), "content")


def _rows(files: DataFrame, function, schema: str) -> DataFrame:
    """What `function` yields for each file's columns, in batches of bounded bytes."""
    fields = T.StructType.fromDDL(schema)
    arrow = to_arrow_schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            waiting, size = [], 0
            for i in range(batch.num_rows):
                for row in function(*(column[i].as_py() for column in batch.columns)):
                    waiting.append(row)
                    size += 200 + sum(len(v) for v in row.values() if isinstance(v, bytes))
                    if size >= FLUSH_BYTES:
                        yield pa.RecordBatch.from_pylist(waiting, schema=arrow)
                        waiting, size = [], 0
            yield pa.RecordBatch.from_pylist(waiting, schema=arrow)

    W.bound_batches(files.sparkSession)
    return files.mapInArrow(run, fields)


def index(files: DataFrame, sort_header: str = "x-page-id") -> DataFrame:
    """One row per record of ARC files: place in the file, id, URL, date, type, payload size and
    digest, and the HTTP header that orders equal payloads.

    The payload is the body of an HTTP response, else the document.  What is no
    ARC record ends a file with a row that holds an `error`, and nothing behind
    it is converted.
    """
    wanted = sort_header.lower()

    def rows(archive: str, content: bytes):
        place = 0
        try:
            for place, (header, document) in enumerate(arc_records(content)):
                if place == 0:
                    continue
                fields, start = http_parts(document)
                yield {
                    "archive": archive,
                    "place": place,
                    "record_id": identifier(archive, str(place), header["URL"], header["Archive-date"]),
                    "url": header["URL"],
                    "date": timestamp(header["Archive-date"]),
                    "mime": header["Content-type"],
                    "payload_bytes": len(document) - start,
                    "digest": hashlib.sha256(memoryview(document)[start:]).hexdigest(),
                    "sort_key": fields.get(wanted),
                }
        except (Malformed, OSError, EOFError) as error:
            yield {"archive": archive, "place": place + 1, "error": str(error)}

    return _rows(files, rows, INDEX)


def revisits(listed: DataFrame, least: int = LEAST_REVISIT) -> DataFrame:
    """Per archive its records that repeat a payload, each with the record it repeats.

    Of equal payloads of at least `least` bytes the one with the smallest sort
    key stands for all, numbers before other keys and no key last; then by
    archive and place.  A payload in a third of all records is aggregated before
    the shuffle, and its partition is split in the join, which moves no payload.
    """
    number = F.try_to_number("sort_key", F.lit("S9999999999999999999"))
    place = F.struct(
        F.col("sort_key").isNull().alias("none"),
        number.isNull().alias("text"),
        number.alias("number"),
        F.col("sort_key").alias("key"),
        "archive",
        "place",
    )
    large = listed.where(F.col("error").isNull() & (F.col("payload_bytes") >= least)).withColumn("order", place)
    first = F.min_by(F.struct("record_id", "url", "date"), "order")
    groups = large.groupBy(F.col("digest").alias("shared")).agg(first.alias("first"), F.count("*").alias("n"))
    others = large.join(groups.where("n > 1"), same_key(F.col("digest"), F.col("shared"))).where(
        F.col("record_id") != F.col("first.record_id")
    )
    return others.groupBy(F.col("archive").alias("repeating")).agg(
        F.collect_list(F.struct("place", "first.*")).alias("repeats")
    )


def warc_text(header: list[tuple[str, str]], block: bytes) -> bytes:
    lines = [f"{name}: {value}" for name, value in [*header, ("Content-Length", str(len(block)))]]
    return "\r\n".join(["WARC/1.1", *lines, "", ""]).encode() + block


def _converted(archive: str, content: bytes, repeats: list[dict] | None):
    """WARC records of an ARC file, up to what is no ARC record."""
    repeated = {r["place"]: r for r in repeats or ()}
    try:
        for place, (header, document) in enumerate(arc_records(content)):
            date = timestamp(header["Archive-date"])
            name = identifier(archive, str(place), header["URL"], header["Archive-date"])
            common = [("WARC-Record-ID", name), ("WARC-Date", date)]
            if place == 0:
                fields = f"software: leadpipe\r\nformat: WARC File Format 1.1\r\nsource: {archive}\r\n".encode()
                kind = [("WARC-Type", "warcinfo"), *common, ("Content-Type", "application/warc-fields")]
                yield {"record": warc_text(kind, fields)}
                continue
            _, start = http_parts(document)
            digest = "sha256:" + hashlib.sha256(memoryview(document)[start:]).hexdigest()
            block = document
            kind, mime = ("response", "application/http; msgtype=response") if start else ("resource", header["Content-type"])
            common += [("WARC-Target-URI", header["URL"]), ("WARC-Payload-Digest", digest)]
            if header["IP-address"] not in ("0.0.0.0", "-", ""):
                common.append(("WARC-IP-Address", header["IP-address"]))
            if place in repeated:
                first, kind, block = repeated[place], "revisit", document[:start]
                common += [
                    ("WARC-Profile", PROFILE),
                    ("WARC-Refers-To", first["record_id"]),
                    ("WARC-Refers-To-Target-URI", first["url"]),
                    ("WARC-Refers-To-Date", first["date"]),
                ]
            common.append(("WARC-Block-Digest", "sha256:" + hashlib.sha256(block).hexdigest()))
            yield {"record": warc_text([("WARC-Type", kind), *common, ("Content-Type", mime)], block)}
    except (Malformed, OSError, EOFError):
        return


def convert(spark: SparkSession, source: str, target: str, sort_header: str = "x-page-id", least: int = LEAST_REVISIT) -> DataFrame:
    """Convert the ARC files below `source` to WARC files below `target`; the index, errors included.

    Each file becomes a `warcinfo` record and one record per ARC record, in
    order: `response` for HTTP, `resource` for anything else, `revisit` with the
    HTTP headers alone for a repeated payload.  Ids come from the archive's name,
    place, URL and date, so converting again gives the same.  Files are read
    twice, for the index and for the records, so only the compressed files meet
    the lists of their repeats, and a task holds one file and one record of it.
    """
    files = archives(spark, source)
    path = scratch_path(spark, "arc-index")
    index(files, sort_header).write.parquet(path)
    listed = spark.read.parquet(path)
    joined = files.join(revisits(listed, least), F.col("archive") == F.col("repeating"), "left")
    records = _rows(joined.select("archive", "content", "repeats"), _converted, "record binary")
    # The text sink ends each line, here a record, with what ends a WARC record.
    records.select(F.col("record").cast("string")).write.option("lineSep", "\r\n\r\n").option(
        "compression", "gzip"
    ).text(target)
    return listed


def read_warc(spark: SparkSession, path: str, sort_header: str = "x-page-id") -> DataFrame:
    """One row per record of WARC files, `warcinfo` aside: the header, and size and digest of the
    payload as it is in the file.

    For a revisit, whose payload is elsewhere, both are null and `stated_digest`
    is what its header says.  What is no WARC record ends a file with a row that
    holds an `error`.
    """
    wanted = sort_header.lower()

    def rows(archive: str, content: bytes):
        place = 0
        try:
            for place, (header, block) in enumerate(warc_records(content)):
                kind = header.get("warc-type")
                if kind == "warcinfo":
                    continue
                fields, start = http_parts(block)
                whole = kind != "revisit"
                yield {
                    "archive": archive,
                    "place": place,
                    "record_type": kind,
                    "record_id": header.get("warc-record-id"),
                    "url": header.get("warc-target-uri"),
                    "date": header.get("warc-date"),
                    "refers_to": header.get("warc-refers-to"),
                    "stated_digest": header.get("warc-payload-digest", "").removeprefix("sha256:") or None,
                    "payload_bytes": len(block) - start if whole else None,
                    "digest": hashlib.sha256(memoryview(block)[start:]).hexdigest() if whole else None,
                    "sort_key": fields.get(wanted),
                }
        except (Malformed, OSError, EOFError) as error:
            yield {"archive": archive, "place": place + 1, "error": str(error)}

    return _rows(archives(spark, path), rows, RECORDS)


def resolve(records: DataFrame) -> DataFrame:
    """The records with the payload size and digest of what they refer to, and its sort key as
    `refers_to_key`, where they are revisits."""
    held = records.where("record_type = 'response' OR record_type = 'resource'").select(
        F.col("record_id").alias("held_id"),
        F.col("payload_bytes").alias("held_bytes"),
        F.col("digest").alias("held_digest"),
        F.col("sort_key").alias("held_key"),
    )
    rest = records.where("record_type = 'revisit'")
    found = rest.join(held, same_key(F.col("refers_to"), F.col("held_id")), "left").select(
        *[c for c in records.columns if c not in ("payload_bytes", "digest")],
        F.col("held_bytes").alias("payload_bytes"),
        F.col("held_digest").alias("digest"),
        F.col("held_key").alias("refers_to_key"),
    )
    own = records.where("record_type IS NULL OR record_type <> 'revisit'")
    return own.withColumn("refers_to_key", F.lit(None).cast("string")).unionByName(found)


def pages_as_warc(pages: DataFrame, id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Pages written as ARC, converted to WARC and read back: one row per page.

    `id`, `payload_bytes`, `payload_digest`, `record_type` and `refers_to`, the id
    of the response a revisit repeats.  A null html is an empty payload, a null
    URL `unknown:`; rows of the same id and payload are one response and
    revisits of it; rows without an id keep a null one.  An empty table gives an
    empty one; other columns are left out.
    """
    spark = pages.sparkSession
    arc, target, found = (scratch_path(spark, name) for name in ("arc", "warc", "warc-records"))
    body = F.coalesce(F.col(html).cast("string"), F.lit(""))
    write_arc(pages.select(F.col(url).alias("url"), http_response(body, {"X-Page-Id": F.col(id)}).alias("document")), arc)
    convert(spark, arc, target)
    read_warc(spark, target).write.parquet(found)
    kind = pages.schema[id].dataType
    as_id = lambda c: F.when(F.col(c) != "", F.col(c)).cast(kind)
    return resolve(spark.read.parquet(found)).select(
        as_id("sort_key").alias(id),
        "payload_bytes",
        F.col("digest").alias("payload_digest"),
        "record_type",
        as_id("refers_to_key").alias("refers_to"),
        "record_id",
    )
