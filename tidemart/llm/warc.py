"""WARC archives: a writer with revisit records, and a reader that salvages damaged files.

Archives are written by Spark's text writer with the record separator as line separator, so they go to any store that
Spark can write to. The reader checks each record (version line, header, length, digest, end mark). After a failed
check it searches for the next version line, or the next gzip member, that begins a valid record, whichever comes first,
goes on there and reports the bytes between as a gap.
"""

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemart.llm.text import pick
from tidemart.sources.scratch import materialise

_HEX32, _BASE32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
END = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
#: Records and bytes of a file. A larger record has a file of its own.
RECORDS_PER_FILE, FILE_BYTES = 2000, 128 << 20


def base32_sha1(payload: Column) -> Column:
    """The SHA-1 of a binary column in upper-case base32. Five hex digits are four base32 digits."""
    digest = F.sha1(payload)
    quads = [F.lpad(F.conv(F.substring(digest, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*quads), _HEX32, _BASE32)


def _urn(page_id: Column, digest: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("")), F.lit(":"), digest, F.lit(">"))


def _header(name: str, value: Column) -> Column:
    """A header line; none for NULL. Control characters and spaces of the value are percent-encoded."""
    clean = F.regexp_replace(value, "[\\x00-\\x20\\x7F]+", "%20")
    return F.coalesce(F.concat(F.lit(f"{name}: "), clean, F.lit("\r\n")), F.lit(""))


def records(
    pages: DataFrame, min_bytes: int = 0, date: str = "2024-01-01T00:00:00Z",
    id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
) -> DataFrame:
    """One text column `value`: the WARC record of each page, without its end mark.

    Of pages with equal payloads of at least `min_bytes`, those with the largest id are responses, the others revisit
    it. NULL payloads are empty. A NULL id or url leaves its place empty. Rows that repeat the largest id are all
    responses. The payloads of a group are never brought together: only digests are grouped.
    """
    payload = F.coalesce(F.col(f"`{html_col}`"), F.lit(""))
    rows = pick(pages, id_col, url_col, html_col).select(
        F.col(f"`{id_col}`").alias("id"), F.col(f"`{url_col}`").alias("url"), payload.alias("payload")
    ).withColumns({"digest": base32_sha1(F.col("payload").cast("binary")), "bytes": F.octet_length("payload")})
    groups = rows.where(F.col("bytes") >= min_bytes).groupBy("digest").agg(
        F.max("id").alias("first_id"), F.count("*").alias("n")
    )
    # written first, so that its size is known and payloads are moved to it only if it is large
    groups = materialise(groups.where("n > 1").drop("n"), "payload-groups")
    rows = rows.join(groups, "digest", "left")
    revisit = (F.col("bytes") >= min_bytes) & F.col("first_id").isNotNull() & ~F.col("id").eqNullSafe(F.col("first_id"))
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: "),
        F.col("bytes").cast("string"), F.lit(END),
    )
    block = F.when(revisit, http).otherwise(F.concat(http, "payload"))
    return rows.select(F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: "), F.when(revisit, "revisit").otherwise("response"), F.lit("\r\n"),
        _header("WARC-Record-ID", _urn(F.col("id"), F.col("digest"))),
        _header("WARC-Target-URI", F.col("url")),
        F.lit(f"WARC-Date: {date}\r\n"),
        _header("WARC-Refers-To", F.when(revisit, _urn(F.col("first_id"), F.col("digest")))),
        _header("WARC-Profile", F.when(revisit, F.lit(PROFILE))),
        F.lit("WARC-Payload-Digest: sha1:"), F.col("digest"), F.lit("\r\n"),
        F.lit("WARC-Block-Digest: sha1:"), base32_sha1(block.cast("binary")), F.lit("\r\n"),
        F.lit("Content-Type: application/http; msgtype=response\r\nContent-Length: "),
        F.octet_length(block).cast("string"), F.lit(END), block,
    ).alias("value"))


def _archive(value: Column, per_file: int, file_bytes: int) -> Column:
    """A name for the file of a record: its level of length, and how many files the rows before it in the task fill.

    A file holds records of one level among as many consecutive rows as fit at the level's upper length.
    """
    row = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))  # the row's number in its task
    names, most = [], max(1, file_bytes // per_file)
    while most < file_bytes:
        file = F.floor(row / F.lit(file_bytes // most)).cast("string")
        names.append(F.when(F.octet_length(value) <= most, F.concat(F.lit(f"{len(names)}-"), file)))
        most *= 8
    return F.coalesce(*names, F.concat(F.lit(f"{len(names)}-"), row.cast("string")))


def write_archives(
    pages: DataFrame, path: str, per_file: int = RECORDS_PER_FILE, file_bytes: int = FILE_BYTES,
    html_col: str = "html", **options,
) -> None:
    """Write the records of `pages` as uncompressed WARC files to a new folder.

    A file has at most `per_file` records and about `file_bytes` bytes, however long the payloads are. Payloads of which
    `per_file` fit into a file go to files in the folder itself; longer ones are counted by their lengths and go to
    subfolders. Equal payloads are equally long, so each half has its revisits and responses together. An empty table
    gives a folder without records.
    """
    size = F.coalesce(F.octet_length(F.col(f"`{html_col}`")), F.lit(0))
    usual = max(1, file_bytes // per_file)

    def writer(rows: DataFrame):
        return rows.write.mode("append").option("lineSep", END).option("compression", "none")

    short = records(pages.where(size <= usual), html_col=html_col, **options)
    writer(short).option("maxRecordsPerFile", per_file).text(path)
    long = records(pages.where(size > usual), html_col=html_col, **options)
    writer(long.withColumn("archive", _archive(F.col("value"), per_file, file_bytes))).partitionBy("archive").text(path)


_VERSION = re.compile(rb"WARC/1\.[01]\r?\n")
_GZIP = b"\x1f\x8b\x08"


def _sha1(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def _record(data: bytes, at: int) -> tuple[dict[str, str], bytes, int] | str:
    """Headers, block and end of the record at `at`, or what is wrong with it."""
    version = _VERSION.match(data, at)
    if not version:
        return "no version line"
    end = data.find(b"\r\n\r\n", version.end())
    if end < 0:
        return "header does not end"
    headers = {}
    for line in data[version.end():end].split(b"\r\n"):
        name, colon, value = line.partition(b":")
        if not colon:
            return "bad header line"
        headers[name.strip().decode("utf-8", "replace").lower()] = value.strip().decode("utf-8", "replace")
    length = headers.get("content-length", "")
    if not (length.isascii() and length.isdigit()):
        return "no length"
    stop = end + 4 + int(length)
    if stop > len(data):
        return "cut off"
    block = data[end + 4:stop]
    if data[stop:stop + 4] != b"\r\n\r\n":
        return "no end mark"
    if headers.get("warc-block-digest", _sha1(block)) != _sha1(block):
        return "digest differs"
    return headers, block, stop + 4


Part = tuple[int, int, str, dict[str, str], bytes]


def _plain(data: bytes, base: int, fixed: int | None = None) -> Iterator[Part]:
    """Records and gaps of plain data: offset, length, what is wrong (empty for a record), headers, block.

    `fixed` is the offset to report for data that lies compressed at one place.
    """
    at, bad, why = 0, None, ""
    where = lambda offset: base + offset if fixed is None else fixed
    while at < len(data):
        found = _record(data, at)
        if isinstance(found, str):
            if bad is None:
                bad, why = at, found
            after = _VERSION.search(data, at + 1)
            at = after.start() if after else len(data)
            continue
        if bad is not None:
            yield where(bad), at - bad, why, {}, b""
            bad = None
        headers, block, end = found
        yield where(at), end - at, "", headers, block
        at = end
    if bad is not None:
        yield where(bad), len(data) - bad, why, {}, b""


def _member(data: bytes, at: int) -> tuple[bytes, int] | None:
    """The content and the end of the gzip member at `at`; None if it is damaged or cut off."""
    reader = zlib.decompressobj(31)
    try:
        content = reader.decompress(memoryview(data)[at:])
    except zlib.error:
        return None
    return (content, len(data) - len(reader.unused_data)) if reader.eof else None


def _holds_record(content: bytes) -> bool:
    return any(not why for _, _, why, _, _ in _plain(content, 0))


def salvage(data: bytes) -> Iterator[Part]:
    """Records and gaps of one archive, of plain records and gzip members in any order."""
    at, bad, why = 0, None, ""
    version = member = -1  # the next places where a record can begin, at or after `at`
    while at < len(data):
        zipped = data[at:at + 3] == _GZIP
        found = _member(data, at) if zipped else _record(data, at)
        # after a failed check a member must hold a record: payloads have members of their own
        if found is None or isinstance(found, str) or (zipped and bad is not None and not _holds_record(found[0])):
            if bad is None:
                bad, why = at, found if isinstance(found, str) else "damaged member"
            if version <= at:
                after = _VERSION.search(data, at + 1)
                version = after.start() if after else len(data)
            if member <= at:
                member = data.find(_GZIP, at + 1)
                member = len(data) if member < 0 else member
            at = min(version, member)
            continue
        if bad is not None:
            yield bad, at - bad, why, {}, b""
            bad = None
        end = found[-1]
        if zipped:
            for _, length, fault, headers, block in _plain(found[0], 0, fixed=at):
                yield at, end - at if not fault else length, fault, headers, block
        else:
            yield at, end - at, "", found[0], found[1]
        at = end
    if bad is not None:
        yield bad, len(data) - bad, why, {}, b""


READ = (
    "path string, offset long, length long, gap string, record_type string, record_id string, refers_to string, "
    "payload_bytes long, payload_digest string, payload binary"
)


def _payload(block: bytes) -> bytes:
    return block.partition(b"\r\n\r\n")[2]


def _http_length(block: bytes) -> int | None:
    found = re.search(rb"(?im)^content-length:[ \t]*(\d+)", block.partition(b"\r\n\r\n")[0])
    return int(found[1]) if found else None


def _reader(keep_payload: bool):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                rows = []
                for offset, length, gap, headers, block in salvage(bytes(content)):
                    kind = headers.get("warc-type")
                    size = digest = payload = None
                    if kind == "response":
                        payload = _payload(block)
                        size, digest = len(payload), _sha1(payload)
                    elif kind == "revisit":
                        size, digest = _http_length(block), headers.get("warc-payload-digest")
                    rows.append((
                        path, offset, length, gap or None, kind, headers.get("warc-record-id"),
                        headers.get("warc-refers-to"), size, digest, payload if keep_payload else None,
                    ))
                out = pd.DataFrame(rows, columns=[c.split()[0] for c in READ.split(", ")])
                yield out.astype({"payload_bytes": "Int64"})

    return run


def read_archives(spark: SparkSession, path: str, keep_payload: bool = False) -> DataFrame:
    """One row per record, and per gap (`gap` says what failed; `offset` and `length` are the quarantined bytes).

    Records have type, id, the id they refer to, and size and base32 SHA-1 of the full payload: of the block for
    responses, as recorded for revisits. One file is one task's work, so archives stay at usual sizes. Subfolders are read
    too. An empty folder gives no rows.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "content")
    return files.mapInPandas(_reader(keep_payload), READ)


def page_id(urn: Column) -> Column:
    """The page id in a record id; NULL if it has none."""
    return F.nullif(F.regexp_extract(urn, "^<urn:page:([^:]*):", 1), F.lit("")).cast("long")
