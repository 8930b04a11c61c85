"""Deterministic sharded WARC writer and reader.

Pages are dealt to parts by ranges of page_id. The ranges come from exact sums of payload bytes over ``BUCKETS`` equal spans of ids,
so they depend on the pages alone; a span that holds more than a part is dealt further by payload digest. Within a part records are
sorted by id, payload and url. A task writes a part to archives that roll by compressed size, each record its own gzip
member, under a temporary name; a finished archive is renamed to its final name and listed in the part's manifest,
which is renamed last. A task that runs again, and any other run over the same pages, writes the same bytes to the same
names. Readers take only what manifests list.

The html is shuffled once. What a record has to know of others with its payload comes as a narrow row that sorts right before it.

Archives are written with pyarrow's file systems, so the folder must be one that all executors share and that these
know (mounted paths, s3, gs, hdfs).
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimlathe.llm.common import parts_for, pick
from dimlathe.operators.keys import keep_first
from dimlathe.session import materialize, scratch_path

#: Compressed bytes after which an archive is closed.
ROLL_BYTES = 32 << 20
#: Payload bytes that a part gets, about; spans of ids that are summed up for the ranges.
PART_BYTES, BUCKETS = 32 << 20, 4096
#: Bytes that are unpacked at a time.
CHUNK = 64 << 10
DATE = "2024-03-01T00:00:00Z"  # fixed, so that reruns give the same bytes
_NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")
CRLF = b"\r\n"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(key: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_NAMESPACE, key)}>"


def record(row: dict, rank: int, other: dict | None) -> bytes:
    """One record's bytes. ``other`` tells of its payload's response if several records have that payload, ``rank`` is its number
    among equal pages. A revisit has no payload block, but the payload's digest and length are kept."""
    payload = (row["html"] or "").encode()
    revisit = other is not None and (rank > 0 or other["best"] != row["ident"])
    status = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = status if revisit else status + payload
    headers = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Target-URI", (row["url"] or "").replace("\r", "%0D").replace("\n", "%0A")),
        ("WARC-Date", DATE),
        ("WARC-Record-ID", record_id(f"{row['ident']}:{rank}")),
        ("Content-Type", "application/http; msgtype=response"),
        ("WARC-Payload-Digest", f"sha1:{base32_sha1(payload)}"),
        ("WARC-Block-Digest", f"sha1:{base32_sha1(block)}"),
        ("X-Page-ID", "" if row["page_id"] is None else str(row["page_id"])),
        ("X-Null-Fields", ",".join(c for c in ("url", "html") if row[c] is None)),
    ]
    if revisit:
        headers += [
            ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
            ("WARC-Refers-To", record_id(f"{other['best']}:0")),
            ("X-Refers-To-Page", "" if other["best_page"] is None else str(other["best_page"])),
        ]
    headers.append(("Content-Length", str(len(block))))
    lines = [b"WARC/1.1", *(f"{k}: {v}".encode() for k, v in headers)]
    return CRLF.join(lines) + CRLF * 2 + block + CRLF * 2


def member(data: bytes) -> bytes:
    """A gzip member with a fixed time stamp."""
    return gzip.compress(data, compresslevel=6, mtime=0)


class _Archive:
    """One archive under a temporary name until it is committed."""

    def __init__(self, store, folder: str, part: int, number: int):
        self.store, self.name = store, f"part-{part:06d}-{number:05d}.warc.gz"
        self.temporary = f"{folder}/_temporary/{uuid.uuid4().hex}-{self.name}"
        self.final = f"{folder}/{self.name}"
        # The members are compressed already; left to itself the stream would compress them again by the file's name.
        self.out, self.bytes, self.records = store.open_output_stream(self.temporary, compression=None), 0, 0

    def add(self, data: bytes) -> None:
        self.out.write(data)
        self.bytes += len(data)
        self.records += 1

    def commit(self) -> dict:
        self.out.close()
        self.store.move(self.temporary, self.final)
        return {"file": self.name, "records": self.records, "bytes": self.bytes}


def identified(pages: DataFrame) -> DataFrame:
    """page_id, url and html with the payload's digest and length and ``ident``, which only equal pages share."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    read = pick(pages, "page_id", "url", "html").select(
        F.col("page_id").cast("long").alias("page_id"), "url", "html",
        F.sha2(payload, 256).alias("payload"), F.octet_length(payload).cast("long").alias("payload_bytes"),
    )
    where = F.md5(F.concat(F.coalesce(F.concat(F.lit("u"), "url"), F.lit("n")), F.col("html").isNull().cast("string")).cast("binary"))
    ident = F.concat_ws(":", F.coalesce(F.col("page_id").cast("string"), F.lit("")), "payload", F.col("payload_bytes").cast("string"), where)
    return read.withColumn("ident", ident)


def parts_of(named: DataFrame, part_bytes: int) -> tuple[Column, int] | None:
    """The part of each page, from byte sums of at most ``BUCKETS`` spans of ids, and the number of parts; None without pages."""
    low, high = named.agg(F.min("page_id"), F.max("page_id")).first()
    width = max(1.0, (float(high or 0) - float(low or 0) + 1) / BUCKETS)
    span = F.least(F.floor((F.coalesce(F.col("page_id"), F.lit(low or 0)).cast("double") - float(low or 0)) / width), F.lit(BUCKETS - 1)).cast("int")
    sums = {r["span"]: int(r["b"]) for r in named.groupBy(span.alias("span")).agg(F.sum(F.col("payload_bytes") + 512).alias("b")).collect()}
    if not sums:
        return None
    first, ways, filled, number = [0] * BUCKETS, [1] * BUCKETS, 0, 0
    for at in sorted(sums):
        if filled and filled + sums[at] > part_bytes:
            number, filled = number + 1, 0
        first[at], ways[at] = number, max(1, -(-sums[at] // part_bytes))
        number, filled = number + ways[at] - 1, filled + sums[at] // ways[at]
    # Two numbers per span, shipped with the plan.
    firsts, many = (F.expr(f"array({','.join(map(str, xs))})") for xs in (first, ways))
    slice_ = F.floor(F.conv(F.substring("payload", 1, 6), 16, 10).cast("double") / 2**24 * F.get(many, span))
    return (F.get(firsts, span) + slice_).cast("int"), number + 1


def shared(named: DataFrame) -> DataFrame:
    """One narrow row per page whose payload others have too: its place, and the page_id and ident of its payload's response.

    That is the record with the largest page_id (null ids count as smallest), of several the last by ident. Payloads are equal if their SHA-256 and
    length are. The groups' bests combine before the shuffle; a payload of many pages is split by adaptive execution.
    """
    narrow = materialize(named.select("part", "page_id", "payload", "payload_bytes", "ident"), "warc-narrow")
    best = narrow.groupBy("payload", "payload_bytes").agg(
        F.max(F.struct(F.coalesce("page_id", F.lit(-(2**63))).alias("id"), "ident", "page_id")).alias("best"), F.count("*").alias("n")
    )
    repeated = best.where("n > 1").select(
        F.col("payload").alias("p"), F.col("payload_bytes").alias("b"), F.col("best.ident").alias("best"), F.col("best.page_id").alias("best_page")
    )
    same = narrow["payload"].eqNullSafe(repeated["p"]) & narrow["payload_bytes"].eqNullSafe(repeated["b"])
    return narrow.join(repeated, same).select("part", "page_id", "payload", "ident", "best", "best_page")


def write(pages: DataFrame, folder: str, roll: int = ROLL_BYTES, part_bytes: int = PART_BYTES) -> DataFrame:
    """Write one record per page below ``folder``; returns the manifests (part, file, records, bytes).

    Null url or html are written as empty and marked; repeated rows are records of their own; an empty table writes
    no archive. Further columns are left out.
    """
    spark = pages.sparkSession
    named = identified(pages)
    found = parts_of(named, part_bytes)
    if found is None:
        return spark.createDataFrame([], MANIFEST)
    part, count = found
    named = named.withColumn("part", part)
    none = F.lit(None)
    told = shared(named).select("part", "page_id", "payload", "ident", F.lit(0).alias("kind"), none.cast("string").alias("url"), none.cast("string").alias("html"), "best", "best_page").distinct()
    full = named.select("part", "page_id", "payload", "ident", F.lit(1).alias("kind"), "url", "html", none.cast("string").alias("best"), none.cast("long").alias("best_page"))
    order = ("part", "page_id", "payload", "ident", "kind")
    ordered = full.unionByName(told).repartition(parts_for(spark, count, 1), "part").sortWithinPartitions(*order)

    def archive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(f"{root}/_temporary")
        at, done, current, other, ident, rank = None, [], None, None, None, 0

        def finish() -> pa.RecordBatch:
            if current:
                done.append(current.commit())
            temporary = f"{root}/_temporary/{uuid.uuid4().hex}-manifest"
            with store.open_output_stream(temporary) as out:
                out.write("".join(json.dumps({"part": at, **d}) + "\n" for d in done).encode())
            store.move(temporary, f"{root}/manifest-{at:06d}.jsonl")
            columns = {"part": [at] * len(done), **{k: [d[k] for d in done] for k in ("file", "records", "bytes")}}
            return pa.record_batch(columns, schema=pa.schema([("part", pa.int32()), ("file", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())]))

        for batch in batches:
            for row in batch.to_pylist():
                if row["part"] != at:
                    if at is not None:
                        yield finish()
                    at, done, current = row["part"], [], None
                if row["kind"] == 0:
                    other = row
                    continue
                rank = rank + 1 if row["ident"] == ident else 0
                ident = row["ident"]
                if current and current.bytes >= roll:
                    done.append(current.commit())
                    current = None
                current = current or _Archive(store, root, at, len(done))
                current.add(member(record(row, rank, other if other and other["ident"] == ident else None)))
        if at is not None:
            yield finish()

    listed = materialize(ordered.mapInArrow(archive, MANIFEST), "warc-manifest")
    store, root = fs.FileSystem.from_uri(folder)
    store.delete_dir(f"{root}/_temporary")  # what attempts that died left behind
    return listed


def parse(data: bytes) -> tuple[dict, bytes]:
    """Headers and block of one record; the length and both digests are checked."""
    head, _, rest = data.partition(CRLF * 2)
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"not a record: {lines[0][:40]!r}")
    headers = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
    block = rest[: int(headers["Content-Length"])]
    if len(block) != int(headers["Content-Length"]) or rest[len(block) :] != CRLF * 2:
        raise ValueError("a record's length is wrong")
    if f"sha1:{base32_sha1(block)}" != headers["WARC-Block-Digest"]:
        raise ValueError("a record's block digest is wrong")
    return headers, block


def members(source) -> Iterator[bytes]:
    """The gzip members of a stream, one after the other; only the current chunk's rest is carried over."""
    unpack, held, rest = zlib.decompressobj(31), [], b""
    while True:
        chunk = rest or source.read(CHUNK)
        if not chunk:
            break
        held.append(unpack.decompress(chunk))
        rest = unpack.unused_data
        if unpack.eof:
            yield b"".join(held)
            unpack, held = zlib.decompressobj(31), []
    if any(held):
        raise ValueError("an archive ends within a record")


def _number(text: str | None) -> int | None:
    return int(text) if text else None


def _parsed(data: bytes) -> dict:
    headers, block = parse(data)
    http, _, payload = block.partition(CRLF * 2)
    length = int(http.rsplit(b"Content-Length: ", 1)[1])
    digest = headers["WARC-Payload-Digest"].removeprefix("sha1:")
    kind = headers["WARC-Type"]
    if kind == "response" and (len(payload) != length or base32_sha1(payload) != digest):
        raise ValueError("a payload digest is wrong")
    nulls = headers["X-Null-Fields"].split(",")
    return {
        "page_id": _number(headers["X-Page-ID"]), "url": None if "url" in nulls else headers["WARC-Target-URI"],
        "html": None if "html" in nulls or kind == "revisit" else payload.decode(), "payload_bytes": length,
        "payload_digest": digest, "record_type": kind, "refers_to": _number(headers.get("X-Refers-To-Page")),
        "record_id": headers["WARC-Record-ID"],
    }


MANIFEST = "part int, file string, records long, bytes long"
RECORD = (
    "page_id long, url string, html string, payload_bytes long, payload_digest string, record_type string, "
    "refers_to long, record_id string"
)
_ARROW = {"long": pa.int64(), "string": pa.string()}
RECORD_ARROW = pa.schema([(c.split()[0], _ARROW[c.split()[1]]) for c in RECORD.split(", ")])


def read(spark, folder: str, manifest: DataFrame | None = None, bodies: bool = True) -> DataFrame:
    """The records of the archives that the manifests in ``folder`` list, digests and lengths checked.

    Each archive is one task's work; rolling bounds its size. A revisit has no html of its own; without ``bodies`` no record has.
    """
    if manifest is None:
        manifest = spark.read.schema(MANIFEST).json(f"{folder}/manifest-*.jsonl")

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for name, records in zip(batch.column("file").to_pylist(), batch.column("records").to_pylist(), strict=True):
                rows, seen = [], 0
                with store.open_input_stream(f"{root}/{name}", compression=None) as source:
                    for data in members(source):
                        row = _parsed(data)
                        rows.append(row if bodies else {**row, "html": None})
                        seen += 1
                        if len(rows) == 500:
                            yield pa.RecordBatch.from_pylist(rows, RECORD_ARROW)
                            rows = []
                if seen != records:
                    raise ValueError(f"{name} holds {seen} records, its manifest {records}")
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, RECORD_ARROW)

    spread = max(1, spark.sparkContext.defaultParallelism)
    return manifest.repartition(spread * 4, "file").mapInArrow(unpack, RECORD)


def restore(records: DataFrame) -> DataFrame:
    """page_id, url and html of every record, revisits with the payload of their response (matched by digest; one
    response per digest)."""
    bodies = keep_first(records.where("record_type = 'response'"), ["payload_digest"], ["page_id"])
    bodies = bodies.select(F.col("payload_digest").alias("__d"), F.col("html").alias("__h"))
    joined = records.join(bodies, F.col("payload_digest") == F.col("__d"), "left")
    return joined.select("page_id", "url", F.when(F.col("record_type") == "revisit", F.col("__h")).otherwise(F.col("html")).alias("html"))


def op9_warc(spark, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "warc")
    folder = folder if ":" in folder.split("/")[0] else f"file://{folder}"
    manifest = write(spark.read.parquet(f"{sf_dir}/pages.parquet"), folder)
    return read(spark, folder, manifest, bodies=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url"
    )
