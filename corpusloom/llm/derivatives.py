"""Web-archive derivatives: metadata and plain-text conversion records from responses.

Each response yields a metadata record, with the source's headers, digest and
outgoing links, and a conversion record with its plain text.  Both name the
response they come from, its address and its time, and carry digests of their
own blocks.  Every response is handled where it lies; nothing is shuffled.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import html
import re
import uuid
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from corpusloom.llm.common import ready, record

RECORDS = (
    "{}record_id string, record_type string, refers_to string, target_uri string, date string, content_type string, "
    "content_length bigint, block_digest string, source_digest string, headers string, block string")
END = object()
GZIP = b"\x1f\x8b\x08"
PART_BYTES, HEADER_BYTES, OUT_BYTES = 1 << 18, 1 << 20, 16 << 20
NAMESPACE = uuid.uuid5(uuid.NAMESPACE_URL, "warc-derivative")

UNSEEN = re.compile(r"<!--.*?-->|<(script|style|noscript|template|head)\b[^>]*>.*?</\1\s*>", re.S | re.I)
TITLE = re.compile(r"<title\b[^>]*>(.*?)</title\s*>", re.S | re.I)
LINE = re.compile(
    r"</?(?:address|article|aside|blockquote|br|dd|div|dl|dt|fieldset|figure|footer|form|h[1-6]|header|hr|li|main|nav|ol|p"
    r"|pre|section|table|td|th|tr|ul)\b[^>]*>", re.I)
TAG = re.compile(r"</?[A-Za-z!?][^>]*>")
LINK = re.compile(r"<(a|area|img|link|script|iframe)\b[^>]*?\s(href|src)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I | re.S)
BLANKS = re.compile(r"[^\S\n]+")
CHARSET = re.compile(r"charset\s*=\s*[\"']?([A-Za-z0-9_.:-]+)", re.I)


def digest(block: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode()


def decode(payload: bytes, content_type: str | None) -> str:
    """Text of a payload in the charset that its type or its first bytes name, else UTF-8."""
    named = CHARSET.search(content_type or "") or CHARSET.search(payload[:1024].decode("latin-1"))
    try:
        return payload.decode(named[1] if named else "utf-8", errors="replace")
    except LookupError:
        return payload.decode("utf-8", errors="replace")


def plain_text(page: str) -> str:
    """The visible text of a page, one line per block, without blank lines."""
    shown = UNSEEN.sub(" ", page)
    shown = TAG.sub("", LINE.sub("\n", BLANKS.sub(" ", shown.replace("\r", "\n").replace("\n", " "))))
    lines = (BLANKS.sub(" ", line).strip() for line in html.unescape(shown).split("\n"))
    return "\n".join(line for line in lines if line)


def outlinks(page: str) -> list[str]:
    """``address element/@attribute`` of every link, in order, repeats left out."""
    found = (f"{html.unescape(a or b or c).strip()} {tag.lower()}/@{name.lower()}"
             for tag, name, a, b, c in LINK.findall(page))
    return list(dict.fromkeys(link.replace("\n", " ") for link in found))


def split_http(block: bytes) -> tuple[str, bytes]:
    """Header text and payload of an HTTP message; a block without a header is all payload."""
    if not block.startswith(b"HTTP/"):
        return "", block
    head, _, payload = block.partition(b"\r\n\r\n")
    return head.decode("utf-8", errors="replace"), payload


def warc_header(pairs: list[tuple[str, str | None]]) -> str:
    return "".join(f"{name}: {value}\r\n" for name, value in pairs if value)


def derive(response: dict) -> list[dict]:
    """The metadata and the conversion record of one response.

    ``response`` has ``record_id, target_uri, date, block`` and may have
    ``payload_digest`` and ``warc_headers``.  A digest that is missing is
    computed.  A null block is empty: its text is empty and it has no links.
    """
    source, block = response["record_id"] or "", response["block"] or b""
    uri, date = response["target_uri"], response["date"]
    head, payload = split_http(block)
    status, *fields = head.split("\r\n")
    kind = next((f.partition(":")[2].strip() for f in fields if f.lower().startswith("content-type:")), None)
    page = decode(payload, kind)
    source_digest = response.get("payload_digest") or digest(payload)
    facts = [("source-status", status), *[("source-header", f) for f in fields if f.strip()],
             *[("source-warc-header", f) for f in (response.get("warc_headers") or "").split("\r\n") if f.strip()],
             ("source-payload-digest", source_digest), ("source-length", str(len(payload))),
             ("title", " ".join(html.unescape("".join(TITLE.findall(page)[:1])).split())),
             *[("outlink", link) for link in outlinks(page)]]
    made = []
    for name, content_type, text in (
        ("metadata", "application/warc-fields", warc_header(facts)), ("conversion", "text/plain", plain_text(page)),
    ):
        body = text.encode("utf-8", errors="replace")
        record_id = f"<urn:uuid:{uuid.uuid5(NAMESPACE, f'{name} {source} {uri} {date}')}>"
        own = digest(body)
        headers = "WARC/1.1\r\n" + warc_header([
            ("WARC-Type", name), ("WARC-Record-ID", record_id), ("WARC-Date", date), ("WARC-Target-URI", uri),
            ("WARC-Refers-To", source), ("WARC-Refers-To-Target-URI", uri), ("WARC-Refers-To-Date", date),
            ("WARC-Block-Digest", own), ("Content-Type", content_type), ("Content-Length", str(len(body)))])
        made.append({
            "record_id": record_id, "record_type": name, "refers_to": source or None, "target_uri": uri, "date": date,
            "content_type": content_type, "content_length": len(body), "block_digest": own,
            "source_digest": source_digest, "headers": headers, "block": text})
    return made


def build_derivatives(responses: DataFrame, *keep: str) -> DataFrame:
    """Two records per response, and the ``keep`` columns of the response.

    ``responses`` has string ``record_id, target_uri, date`` and binary
    ``block``; ``payload_digest`` and ``warc_headers`` are used if there.
    Repeated responses are derived each time, nulls are handled as
    :func:`derive` says, other columns are left out.  No rows give no rows.
    """
    ready(responses.sparkSession)
    used = [c for c in ("record_id", "target_uri", "date", "block", "payload_digest", "warc_headers")
            if c in responses.columns]
    rows = responses.select(*keep, *used)
    kept = "".join(f"`{c}` {responses.schema[c].dataType.simpleString()}, " for c in keep)
    names = [c.split()[0] for c in RECORDS.format("").split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 500):  # the records of a batch are larger than its responses
                batch = whole.slice(at, 500)
                made = [r for row in batch.select(used).to_pylist() for r in derive(row)]
                twice = pa.array([i for i in range(batch.num_rows) for _ in range(2)], pa.int64())
                columns = [batch.column(i).take(twice) for i in range(len(keep))]
                columns += [pa.array([r[c] for r in made], pa.int64() if c == "content_length" else pa.string())
                            for c in names]
                yield pa.RecordBatch.from_arrays(columns, [*keep, *names])
    return rows.mapInArrow(run, RECORDS.format(kept))


def record_bytes(headers: str, block: bytes) -> bytes:
    """One record as it stands in an archive file, compressed by itself."""
    return gzip.compress(headers.encode() + b"\r\n" + block + b"\r\n\r\n", mtime=0)


def _pieces(archive: bytes) -> Iterator[bytes | None]:
    """The content of an archive file in parts of bounded size; None where a compressed member is broken."""
    if archive[:2] != GZIP[:2]:
        yield from (archive[at: at + PART_BYTES] for at in range(0, len(archive), PART_BYTES))
        return
    at = 0
    while 0 <= at < len(archive):
        member, fed = zlib.decompressobj(31), at
        try:
            while not member.eof and (fed < len(archive) or member.unconsumed_tail):
                part = member.unconsumed_tail or archive[fed: fed + PART_BYTES]
                fed += 0 if member.unconsumed_tail else len(part)
                yield member.decompress(part, PART_BYTES)
            ended = member.eof
        except zlib.error:
            ended = False
        if ended:
            at = fed - len(member.unused_data)
        else:
            yield None
            at = archive.find(GZIP, at + 1)  # the next member that can be read


def _damaged(problem: str) -> dict:
    return {"type": "damaged", "problem": problem}


def parse_records(archive: bytes) -> Iterator[dict]:
    """The records of an archive file, compressed or not, with their headers and blocks.

    One record at a time is held.  A record that is cut off, whose header has
    no end within ``HEADER_BYTES`` or no length, or whose compressed member is
    broken, comes as type ``damaged`` with its ``problem``; reading goes on at
    the next record that begins behind it.
    """
    held, source, more = bytearray(), _pieces(archive), True

    def fill(size: int) -> str | None:
        """Bring at least so many bytes into the buffer, if there are; else what stands in the way."""
        nonlocal more
        while len(held) < size:
            part = next(source, END)
            if part is None:
                return "compression"
            if part is END:
                more = False
                return "truncated"
            held.extend(part)
        return None

    while True:
        begin = held.find(b"WARC/")
        if begin < 0:
            del held[: max(0, len(held) - 4)]
            problem = fill(len(held) + 1)
            if problem == "compression":
                held.clear()
                yield _damaged(problem)
            elif problem:
                return
            continue
        del held[:begin]
        end, problem = -1, None
        while end < 0 and problem is None:
            end = held.find(b"\r\n\r\n", 0, HEADER_BYTES)
            if end < 0:
                problem = "header" if len(held) >= HEADER_BYTES else fill(len(held) + 1)
        lines = bytes(held[: max(end, 0)]).decode("utf-8", errors="replace").split("\r\n")
        fields = {n.strip().lower(): v.strip() for n, _, v in (line.partition(":") for line in lines[1:])}
        length = fields.get("content-length", "")
        if problem is None:
            problem = fill(end + 4 + int(length)) if length.isascii() and length.isdigit() else "length"
        if problem:
            yield _damaged(problem)
            if problem == "compression":
                held.clear()
            else:
                del held[:5]
            if not more and b"WARC/" not in held:
                return
            continue
        at = end + 4 + int(length)
        yield {"type": fields.get("warc-type"), "record_id": fields.get("warc-record-id"),
               "target_uri": fields.get("warc-target-uri"), "date": fields.get("warc-date"),
               "payload_digest": fields.get("warc-payload-digest"), "warc_headers": "\r\n".join(lines[1:]),
               "block": bytes(held[end + 4: at])}
        del held[:at]


def read_responses(spark: SparkSession, path: str) -> DataFrame:
    """Response records of the archive files under ``path``; damaged records are left out (``archive_report``).

    A task holds one compressed file, which ``binaryFile`` limits to 2 GB, and
    a record of it at a time.
    """
    ready(spark)
    names = ["record_id", "target_uri", "date", "payload_digest", "warc_headers", "block"]

    def batch_of(rows: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([r[c] for r in rows], pa.binary() if c == "block" else pa.string()) for c in names], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive in batch.column(0):
                rows, size = [], 0
                for r in parse_records(archive.as_py()):
                    if r["type"] == "response":
                        rows.append(r)
                        size += len(r["block"])
                    if size > OUT_BYTES:
                        yield batch_of(rows)
                        rows, size = [], 0
                yield batch_of(rows)
    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(run, ", ".join(f"{c} {'binary' if c == 'block' else 'string'}" for c in names))


def archive_report(spark: SparkSession, path: str) -> DataFrame:
    """``path, n_records, n_responses, n_damaged`` of each archive file that is not empty."""
    ready(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = [Counter(r["type"] for r in parse_records(archive.as_py())) for archive in batch.column(1)]
            yield record(
                path=batch.column(0), n_records=pa.array([c.total() - c["damaged"] for c in counts], pa.int64()),
                n_responses=pa.array([c["response"] for c in counts], pa.int64()),
                n_damaged=pa.array([c["damaged"] for c in counts], pa.int64()))
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(run, "path string, n_records bigint, n_responses bigint, n_damaged bigint")
