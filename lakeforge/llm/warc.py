"""WARC output: a deterministic sharded writer, and a reader.

Records are range-sorted by page id. Each task writes its range as WARC/1.1
files of one gzip member per record and rolls to the next file once the
compressed size passes ``roll_bytes``. Headers are regenerated from the page:
record id (a name-based UUID of page id and payload digest), target URI, payload
and block digest, length. Of pages with equal payloads, the one with the largest
id is written whole, as ``response``; the others become ``revisit`` records that
refer to it and carry no payload. Files get their names by renaming when they
are complete; the manifest, written last by Spark's own committer, lists them,
and readers go by it alone, so leftovers of lost attempts are never read.

Nulls: a null html counts as an empty payload, a null url as an empty URI; a
null page id sorts first. Each row has a record, also where rows repeat page id, url
and html: of such the payload's largest page id has several responses.
A page id with several payloads, null included, has a record for each; only those
whose payload a larger page id has too are revisits.
Payloads are never truncated. Other columns of the input don't matter.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeforge.llm import files, store

MANIFEST = "part int, seq int, path string, n_records bigint, n_bytes bigint"
RECORDS = "page_id bigint, url string, record_type string, refers_to bigint, payload_bytes bigint, payload_digest string, payload string"
_NAMESPACE = uuid.UUID("6f1c1d0a-0b0e-5c55-9a0e-3c5d8f1f7a10")
_DATE = "2000-01-01T00:00:00Z"


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_NAMESPACE, f'{page_id}/{digest}')}>"


def _clean(value: str) -> str:
    """A header value on one line."""
    return value.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A")


def _unclean(value: str) -> str:
    return value.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%")


def make_record(page_id: int | None, url: str, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """The bytes of one record: headers, block, end."""
    digest = sha1_base32(payload)
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {record_id(page_id, digest)}",
        f"WARC-Date: {_DATE}",
        f"WARC-Target-URI: {_clean(url)}",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"X-Page-ID: {'' if page_id is None else page_id}",
        f"X-Payload-Length: {len(payload)}",
    ]
    block = b"" if revisit else payload
    if revisit:
        head += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: {record_id(refers_to, digest)}",
            f"X-Refers-To-Page: {'' if refers_to is None else refers_to}",
        ]
    head += [f"WARC-Block-Digest: sha1:{sha1_base32(block)}", "Content-Type: text/html", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def gzip_member(raw: bytes, level: int) -> bytes:
    """One gzip member, without a time, so equal input gives equal bytes."""
    z = zlib.compressobj(level, zlib.DEFLATED, 31)
    return z.compress(raw) + z.flush()


def read_records(stream, size: int = 1 << 20) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and blocks of the records of a file, a member at a time. Wrong
    lengths or digests raise ValueError."""
    pending = b""
    while True:
        z, parts = zlib.decompressobj(31), []
        while not z.eof:
            pending = pending or stream.read(size)
            if not pending:
                if parts:
                    raise ValueError("the file ends within a record")
                return
            parts.append(z.decompress(pending))
            pending = z.unused_data
        head, _, rest = b"".join(parts).partition(b"\r\n\r\n")
        version, *lines = head.decode().split("\r\n")
        headers = dict(x.split(": ", 1) for x in lines)
        block = rest[:-4]
        if version != "WARC/1.1" or rest[-4:] != b"\r\n\r\n" or len(block) != int(headers["Content-Length"]):
            raise ValueError("not a whole WARC record")
        if headers["WARC-Block-Digest"] != "sha1:" + sha1_base32(block):
            raise ValueError("a block doesn't match its digest")
        yield headers, block


def _sha(html: str) -> Column:
    return F.unhex(F.sha2(F.coalesce(html, F.lit("")), 256))


def referrals(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """(page_id, sha, refers_to) of the payloads that become revisits: those, of
    at least ``min_bytes``, that a page with a larger id has too. Payloads are
    told apart by SHA-256 (``sha``, binary) and length."""
    keys = pages.select("page_id", _sha("html").alias("__sha"), F.coalesce(F.octet_length("html"), F.lit(0)).alias("__n")).where(F.col("__n") >= min_bytes)
    groups = keys.groupBy("__sha", "__n").agg(F.max("page_id").alias("refers_to"), F.count("*").alias("__rows")).where("__rows > 1").drop("__rows")
    groups = store.save(groups, "payloads")  # small beside the pages, and lets a hot payload's rows be split in the join
    return keys.join(groups, ["__sha", "__n"]).where(~F.col("page_id").eqNullSafe(F.col("refers_to"))).select("page_id", F.col("__sha").alias("sha"), "refers_to")


def write_warc(pages: DataFrame, folder: str, min_bytes: int = 0, roll_bytes: int = 64 << 20, level: int = 6) -> DataFrame:
    """Write all pages below ``folder``; returns the manifest (``MANIFEST``)."""
    pages = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.coalesce("url", F.lit("")).alias("url"), F.coalesce("html", F.lit("")).alias("html"))
    known = referrals(pages, min_bytes).select("page_id", F.lit("").alias("url"), F.lit("").alias("html"), "refers_to", F.lit(0).alias("kind"), "sha")
    rows = known.unionByName(pages.withColumns({"refers_to": F.lit(None).cast("bigint"), "kind": F.lit(1), "sha": _sha("html")}))
    # a referral comes right before the rows of its page id and payload; rows of one
    # id, or without one, are dealt over ranges by their payloads
    ordered = rows.repartitionByRange("page_id", "sha").sortWithinPartitions("page_id", "sha", "kind", "url", "html")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        seq = 0
        members: list[bytes] = []
        size = 0
        revisit: tuple[bool, int | None, bytes, int | None] = (False, None, b"", None)

        def close() -> pa.RecordBatch:
            nonlocal seq, size
            path = f"{folder}/part-{part:06d}-{seq:06d}.warc.gz"
            with files.committed(path) as f:
                for m in members:
                    f.write(m)
            row = pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "seq": pa.array([seq], pa.int32()), "path": [path], "n_records": [len(members)], "n_bytes": [size]})
            seq, size = seq + 1, 0
            members.clear()
            return row

        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                for page_id, url, html, refers_to, kind, sha in zip(*(c.to_pylist() for c in batch.slice(at, 64).columns), strict=True):
                    if kind == 0:
                        revisit = (True, page_id, sha, refers_to)
                        continue
                    again = revisit[:3] == (True, page_id, sha)
                    member = gzip_member(make_record(page_id, url, html.encode("utf-8", "surrogatepass"), revisit[3] if again else None, again), level)
                    members.append(member)
                    size += len(member)
                    if size >= roll_bytes:
                        yield close()
        if members:
            yield close()

    return store.save(ordered.mapInArrow(run, MANIFEST), "warc-manifest")


def read_warc(spark: SparkSession, manifest: DataFrame, payloads: bool = True) -> DataFrame:
    """The records of a manifest's files (``RECORDS``), with their digests
    checked; payloads are null for revisits, or everywhere if not asked for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.string())])
        for batch in batches:
            for path in batch.column(0).to_pylist():
                rows, size = [], 0
                with files.open_stream(path) as f:
                    for h, block in read_records(f):
                        response = h["WARC-Type"] == "response"
                        digest = h["WARC-Payload-Digest"].removeprefix("sha1:")
                        if response and (digest != sha1_base32(block) or int(h["X-Payload-Length"]) != len(block)):
                            raise ValueError("a payload doesn't match its digest")
                        number = lambda k: int(h[k]) if h.get(k) else None
                        payload = block.decode("utf-8", "replace") if response and payloads else None
                        rows.append((number("X-Page-ID"), _unclean(h["WARC-Target-URI"]), h["WARC-Type"], number("X-Refers-To-Page"), int(h["X-Payload-Length"]), digest, payload))
                        size += len(payload or "")
                        if len(rows) >= 2000 or size >= 4 << 20:
                            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
                            rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    tasks = max(1, min(manifest.count(), 20_000))
    return manifest.select("path").repartition(tasks, "path").mapInArrow(run, RECORDS)
