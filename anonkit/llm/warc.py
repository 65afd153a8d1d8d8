"""Deterministic sharded WARC writer, and the reader of what it wrote.

Pages are range-sorted: shards are ranges of (key, payload digest) whose borders are rows of a bounded sample, chosen by a hash
of the row, so that shards follow the data, wherever its keys lie, and hold about equally many bytes. Each shard is
sorted by key, payload digest and URL. Of equal
payloads the record of the least key is a response, all others revisit it. Which payloads occur repeatedly
is found on digests alone; a mark for each such key and digest travels with the pages to their shard, so
pages are shuffled once. A task writes its shard to files of gzip members, one per record, and starts the
next file when the compressed size is reached. A file is written under a name of its attempt and renamed
when complete. The manifest, a table that Spark commits, lists the files that count; readers open no
others, so a lost executor or a second attempt leaves nothing that is read. Headers, ids and dates are
made from the rows alone: the same rows give the same bytes.

Defined cases: a null payload is empty; a null URL gives a record without target; a null key sorts first
and is written without a key; of fully equal rows one is the response and the others revisit it; white space
inside a URL that would break a header is percent-encoded in it; an empty table gives no files and no rows;
other columns have no effect.
"""

from __future__ import annotations

import base64
import hashlib
import json
import math
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from anonkit.llm.common import pa_schema, written
from anonkit.sources.scratch import fresh_dir

DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_IDS = uuid.uuid5(uuid.NAMESPACE_URL, "urn:anonkit:warc")
_MANIFEST = "path string, shard bigint, part bigint, records bigint, bytes bigint, sha256 string"
_ROWS = "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, url string"


def record_id(key: int | None, digest: str, number: int = 0) -> str:
    """The id of a record, from its key, its payload and how many equal ones stand before it."""
    return f"<urn:uuid:{uuid.uuid5(_IDS, f'{key}|{digest}|{number}')}>"


def base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def _header_value(text: str) -> str:
    return "".join(c if c > " " and c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in text)


def member(headers: list[tuple[str, str | None]], block: bytes) -> bytes:
    """One record as a gzip member without time or name."""
    fields = [*headers, ("WARC-Block-Digest", "sha1:" + base32(hashlib.sha1(block).digest())), ("Content-Length", str(len(block)))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields if v is not None) + "\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(head.encode("utf-8", "surrogatepass") + block + b"\r\n\r\n") + packer.flush()


def page_record(key: int | None, url: str | None, payload: bytes, first: tuple | None, number: int) -> bytes:
    """Response record, or revisit record if ``first`` (key, URL) of an equal payload is given."""
    digest = base32(hashlib.sha1(payload).digest())
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    headers: list[tuple[str, str | None]] = [
        ("WARC-Type", "revisit" if first else "response"),
        ("WARC-Record-ID", record_id(key, digest, number)),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", _header_value(url) if url is not None else None),
        ("WARC-Payload-Digest", "sha1:" + digest),
        ("X-Page-Id", str(key) if key is not None else None),
        ("X-Payload-Length", str(len(payload))),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    if first:
        headers += [
            ("WARC-Profile", PROFILE),
            ("WARC-Refers-To", record_id(first[0], digest)),
            ("WARC-Refers-To-Target-URI", _header_value(first[1]) if first[1] is not None else None),
            ("WARC-Refers-To-Date", DATE),
            ("X-Refers-To-Page-Id", str(first[0]) if first[0] is not None else None),
        ]
    return member(headers, http if first else http + payload)


def file_system(path: str):
    """File system and path for a URI that all executors share."""
    from pyarrow import fs

    if path.startswith("file:/") and not path.startswith("file://"):
        path = path.removeprefix("file:")
    return fs.FileSystem.from_uri(path)


class ShardFiles:
    """Files of one shard; ``add`` starts a new one when the size is reached."""

    def __init__(self, base: str, shard: int, attempt: str, roll_bytes: int):
        self.base, self.shard, self.attempt, self.roll_bytes = base, shard, attempt, roll_bytes
        self.system, self.root = file_system(base)
        self.part, self.stream = 0, None

    def _start(self) -> None:
        self.name = f"shard-{self.shard:07d}-{self.part:05d}.warc.gz"
        self.system.create_dir(f"{self.root}/_temporary", recursive=True)
        self.temporary = f"{self.root}/_temporary/{self.name}.{self.attempt}"
        self.stream = self.system.open_output_stream(self.temporary)
        self.hash, self.size, self.records = hashlib.sha256(), 0, 0
        info = [("WARC-Type", "warcinfo"), ("WARC-Record-ID", record_id(None, self.name)), ("WARC-Date", DATE)]
        self._put(member([*info, ("WARC-Filename", self.name), ("Content-Type", "application/warc-fields")], b"format: WARC/1.1\r\n"))

    def _put(self, data: bytes) -> None:
        self.stream.write(data)
        self.hash.update(data)
        self.size += len(data)

    def add(self, record: bytes) -> Iterator[tuple]:
        if self.stream is None:
            self._start()
        self._put(record)
        self.records += 1
        if self.size >= self.roll_bytes:
            yield from self.close()

    def close(self) -> Iterator[tuple]:
        """Rename the open file to its final name and report it."""
        if self.stream is None:
            return
        self.stream.close()
        self.system.move(self.temporary, f"{self.root}/{self.name}")
        yield f"{self.base}/{self.name}", self.shard, self.part, self.records, self.size, self.hash.hexdigest()
        self.part, self.stream = self.part + 1, None


def plan_shards(narrow: DataFrame, shard_bytes: int, sample_rows: int = 100_000) -> list[tuple[int | None, str]]:
    """Borders (key, digest) between shards of about ``shard_bytes``, ascending; a border's own row is right of it.

    The sample has 100 rows for each shard and decides how even the shards are. There are at most a tenth as many shards as
    ``sample_rows``; beyond that shards grow.
    """
    total = narrow.agg(F.coalesce(F.sum(F.col("size") + 512), F.lit(0))).first()[0]
    shards = min(max(1, -(-total // shard_bytes)), sample_rows // 10)
    if shards == 1:
        return []
    chosen = narrow.select("key", "digest", "size").orderBy(F.xxhash64("key", "digest", "url"), "key", "digest").limit(min(100 * shards, sample_rows))
    rows = sorted(((r.key is not None, r.key or 0, r.digest), r.size + 512) for r in chosen.collect())
    room, filled = sum(size for _, size in rows) / shards, 0
    borders: list[tuple[int | None, str]] = []
    for (known, key, digest), size in rows:
        border = (key if known else None, digest)
        if filled >= room and border not in borders[-1:]:
            borders.append(border)
            filled = 0
        filled += size
    return borders


def shard_column(borders: list[tuple[int | None, str]]) -> Column:
    """Number of borders that do not lie behind (``key``, ``digest``): first those of every so many-th, then those in between."""
    if not borders:
        return F.lit(0)
    step = max(1, math.isqrt(len(borders)))
    row = F.struct(F.col("key"), F.col("digest"))

    def literal(some: list[tuple[int | None, str]]) -> Column:
        text = json.dumps([{"key": k, "digest": d} for k, d in some])
        return F.from_json(F.lit(text), "array<struct<key: bigint, digest: string>>")  # one constant, which Spark folds

    coarse = F.size(F.filter(literal(borders[step - 1 :: step]), lambda b: b <= row)) * step
    rest = F.slice(literal(borders), coarse + 1, F.lit(step))
    return coarse + F.size(F.filter(rest, lambda b: b <= row))


def write_archives(
    pages: DataFrame,
    base: str,
    *,
    key: str = "page_id",
    url: str = "url",
    html: str = "html",
    least_bytes: int = 0,
    shard_bytes: int = 64 << 20,
    roll_bytes: int = 16 << 20,
) -> DataFrame:
    """Write all pages below ``base`` and return the manifest. Equal payloads below ``least_bytes`` stay responses."""
    payload = F.encode(F.coalesce(F.col(html), F.lit("")), "UTF-8")
    rows = pages.select(F.col(key).cast("bigint").alias("key"), F.col(url).alias("url"), payload.alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload")).withColumn("size", F.octet_length("payload").cast("bigint"))
    narrow = rows.select("key", "url", "digest", "size")
    borders = plan_shards(narrow, shard_bytes)
    shard = shard_column(borders).alias("shard")
    repeated = (
        narrow.where(F.col("size") >= least_bytes)
        .groupBy("digest")
        .agg(F.min(F.struct("key", "url")).alias("first"), F.count("*").alias("n"))
        .where("n > 1")
        .select("digest", F.col("first.key").alias("first_key"), F.col("first.url").alias("first_url"))
    )
    marks = narrow.select("key", "digest").join(repeated, "digest").distinct()
    nothing = [F.lit(None).cast(kind).alias(name) for name, kind in (("url", "string"), ("payload", "binary"))]
    stream = marks.select(shard, "key", "digest", F.lit(0).alias("kind"), *nothing, "first_key", "first_url").unionByName(
        rows.select(shard, "key", "digest", F.lit(1).alias("kind"), "url", "payload"), allowMissingColumns=True
    )
    order = ["shard", "key", "digest", "kind", "url"]
    dealt = stream.repartitionById(len(borders) + 1, F.col("shard")).sortWithinPartitions(*order)
    target = pa_schema(_MANIFEST)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        attempt = f"{TaskContext.get().taskAttemptId()}"
        files: ShardFiles | None = None
        mark = last = None
        number = 0
        done: list[tuple] = []
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in (*order, "payload", "first_key", "first_url")]
            for shard, key, digest, kind, url, payload, first_key, first_url in zip(*columns, strict=True):
                if files is None or files.shard != shard:
                    done += files.close() if files else []
                    files = ShardFiles(base, shard, attempt, roll_bytes)
                if kind == 0:
                    mark = (key, digest, first_key, first_url)
                    continue
                number = number + 1 if last == (key, digest) else 0
                last = (key, digest)
                first = mark[2:] if mark and mark[:2] == last else None
                if first and first[0] == key and number == 0:
                    first = None  # the least key, and the first of its rows
                done += files.add(page_record(key, url, payload, first, number))
        done += files.close() if files else []
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done, strict=True), target, strict=True)], schema=target)

    return written(dealt.mapInArrow(write, _MANIFEST), "manifest")


def members(path: str, chunk: int = 1 << 20) -> Iterator[bytes]:
    """The uncompressed records of a file, one at a time."""
    system, place = file_system(path)
    with system.open_input_stream(place, compression=None) as source:
        unpacker, parts, data = zlib.decompressobj(31), [], source.read(chunk)
        while data:
            parts.append(unpacker.decompress(data))
            if unpacker.eof:
                yield b"".join(parts)
                data, unpacker, parts = unpacker.unused_data, zlib.decompressobj(31), []
            else:
                data = b""
            data = data or source.read(chunk)
        if any(parts):
            raise ValueError(f"{path} ends inside a record")


def parse(record: bytes) -> tuple[dict[str, str], bytes]:
    """Headers by lower-case name, and the block, whose digest is checked."""
    head, _, rest = record.partition(b"\r\n\r\n")
    first, *lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    headers = {k.lower(): v for k, v in (line.split(": ", 1) for line in lines)}
    block = rest[: int(headers["content-length"])]
    if not first.startswith("WARC/") or headers["warc-block-digest"] != "sha1:" + base32(hashlib.sha1(block).digest()):
        raise ValueError(f"record {headers.get('warc-record-id')} is damaged")
    return headers, block


def read_archives(spark: SparkSession, manifest: DataFrame, *, with_payload: bool = False) -> DataFrame:
    """One row per page record of the files in the manifest; payload digests are computed anew and compared."""
    schema = _ROWS + (", payload binary" if with_payload else "")
    target = pa_schema(schema)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), target, strict=True)], schema=target)

        for batch in batches:
            for path in batch.column("path").to_pylist():
                rows: list[tuple] = []
                for headers, block in map(parse, members(path)):
                    kind = headers["warc-type"]
                    if kind not in ("response", "revisit"):
                        continue
                    payload = block.partition(b"\r\n\r\n")[2]
                    digest = headers["warc-payload-digest"].removeprefix("sha1:")
                    size = int(headers["x-payload-length"])
                    if kind == "response" and (len(payload) != size or base32(hashlib.sha1(payload).digest()) != digest):
                        raise ValueError(f"payload of {headers['warc-record-id']} is damaged")
                    key, refers = headers.get("x-page-id"), headers.get("x-refers-to-page-id")
                    row = (int(key) if key else None, size, digest, kind, int(refers) if refers else None, headers.get("warc-target-uri"))
                    rows.append((*row, payload) if with_payload else row)
                    if len(rows) == 1000:
                        yield batch_of(rows)
                        rows = []
                if rows:
                    yield batch_of(rows)

    files = max(1, min(manifest.count(), 4096))
    return manifest.select("path").repartition(files).mapInArrow(read, schema)


def archive(spark: SparkSession, pages: DataFrame, **options: object) -> DataFrame:
    """Write all pages to a fresh folder in the shared place and read the archives back."""
    return read_archives(spark, write_archives(pages, fresh_dir(spark, "warc"), **options))
