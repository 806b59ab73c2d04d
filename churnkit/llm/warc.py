"""Web archives (WARC) written in sorted shards and read back."""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnkit.llm.common import fresh_path, map_batches, open_folder, stored
from churnkit.llm.ranges import plan_ranges

# Payload bytes of a shard, and compressed bytes after which a shard goes on in another file.
SHARD_BYTES = 16 << 20
ROLL_BYTES = 64 << 20
# The tables say nothing about when a page was fetched; a fixed date keeps archives the same on every run.
DATE = "2000-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_SALTS = 16
_LEVEL = 6


def digest(payload: bytes) -> str:
    """SHA-1 in upper-case base32."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None, payload_digest: str, nth: int) -> str:
    """The URI of a record: its page, its payload, and which of equal rows it is."""
    return f"<urn:x-page:{'' if page_id is None else page_id}:{payload_digest}:{nth}>"


def _page_of(identity: str) -> int | None:
    page = identity.split(":")[2]
    return int(page) if page else None


def _record(fields: list[tuple[str, str]], block: bytes) -> bytes:
    """One record as a gzip member of its own."""
    head = "".join(f"{k}: {v}\r\n" for k, v in [*fields, ("WARC-Block-Digest", f"sha1:{digest(block)}"), ("Content-Length", str(len(block)))])
    packer = zlib.compressobj(_LEVEL, zlib.DEFLATED, 31)
    return packer.compress(b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n") + packer.flush()


def _address(url: str | None) -> list[tuple[str, str]]:
    """The target field. White space and control characters, which no header may hold, are escaped."""
    if url is None:
        return []
    return [("WARC-Target-URI", "".join(c if c > " " and c.isprintable() else "".join(f"%{x:02X}" for x in c.encode("utf-8", "replace"))
                                        for c in url))]


def page_record(page_id: int | None, url: str | None, payload: bytes, payload_digest: str, refers: int | None, nth: int) -> bytes:
    """A response record, or a revisit record if the payload is that of page ``refers``. A revisit keeps the response's
    header lines, with the length of the payload it leaves out."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    fields = [("WARC-Type", "response" if refers is None else "revisit"), ("WARC-Record-ID", record_id(page_id, payload_digest, nth)),
              ("WARC-Date", DATE), *_address(url), ("Content-Type", "application/http; msgtype=response"),
              ("WARC-Payload-Digest", f"sha1:{payload_digest}")]
    if refers is None:
        return _record(fields, http + payload)
    return _record([*fields, ("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(refers, payload_digest, 0))], http)


class _Shard:
    """The files of one shard: each is written under a temporary name and gets its own name when it is whole."""

    def __init__(self, folder: str, shard: int, roll: int):
        self.fs, self.path = open_folder(folder)
        self.shard, self.roll, self.number, self.out = shard, roll, 0, None
        self.done: list[dict] = []

    def add(self, member: bytes) -> None:
        if self.out is None:
            self.name = f"pages-{self.shard:08d}-{self.number:04d}.warc.gz"
            self.temporary = f"{self.path}/_{self.name}.{uuid.uuid4().hex}"
            self.fs.create_dir(self.path, recursive=True)
            self.out = self.fs.open_output_stream(self.temporary, compression=None)
            self.size = self.records = self.crc = 0
            info = f"software: churnkit\r\nformat: WARC File Format 1.1\r\nisPartOf: shard {self.shard}\r\n".encode()
            self._put(_record([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:x-file:{self.name}>"), ("WARC-Date", DATE),
                               ("WARC-Filename", self.name), ("Content-Type", "application/warc-fields")], info))
        self._put(member)
        self.records += 1
        if self.size >= self.roll:
            self.close()

    def _put(self, member: bytes) -> None:
        self.out.write(member)
        self.size += len(member)
        self.crc = zlib.crc32(member, self.crc)

    def close(self) -> None:
        if self.out is None:
            return
        self.out.close()
        self.out = None
        self.fs.move(self.temporary, f"{self.path}/{self.name}")
        self.done.append({"file": self.name, "records": self.records, "bytes": self.size, "crc32": self.crc})
        self.number += 1

    def taken(self) -> dict:
        rows, self.done = self.done, []
        return {k: [r[k] for r in rows] for k in ("file", "records", "bytes", "crc32")}


def revisits(keys: DataFrame, min_bytes: int) -> DataFrame:
    """(page_id, digest, refers) for pages whose payload a page of larger id has too, from ``keys(page_id, digest, bytes)``.

    Largest ids are found map-side first. Payloads that occur once are dropped before the join, and what is left of that
    side is repeated for each salt, so rows of a payload that a third of all pages share are dealt to many tasks.
    """
    heads = (keys.where(F.col("bytes") >= min_bytes).groupBy("digest").agg(F.max("page_id").alias("refers"), F.count(F.lit(1)).alias("n"))
             .where("n > 1 and refers is not null").select("digest", "refers", F.explode(F.array(*map(F.lit, range(_SALTS)))).alias("salt")))
    salted = keys.withColumn("salt", F.pmod(F.xxhash64("page_id"), F.lit(_SALTS)).cast("int"))
    return (salted.join(heads, ["digest", "salt"]).where("page_id is null or page_id <> refers")
            .select("page_id", "digest", "refers").distinct())


def write_archives(pages: DataFrame, folder: str, min_bytes: int = 0, shard_bytes: int = SHARD_BYTES, roll_bytes: int = ROLL_BYTES,
                   key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Write ``pages`` as WARC files to ``folder`` and return the manifest.

    Shards are ranges of the key that depend on the rows alone; in a shard records ascend by key (null first, equal keys by
    payload digest and url). A shard rolls to a next file once one has ``roll_bytes``. The manifest (file, records, bytes,
    crc32), a Parquet table committed last, says which files count; a task that runs twice writes the same files again.

    Of pages with equal payloads of ``min_bytes`` or more, that with the largest key is a response, the others are
    revisits; of rows equal in key and payload too, the first is as said and the others revisit it. Rows without a key are
    revisits only of a page that has one. A null html is empty.
    """
    spark = pages.sparkSession
    rows = pages.select(F.col(key).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"),
                        F.coalesce(F.col(html).cast("string"), F.lit("")).cast("binary").alias("payload"))
    keys = stored(rows.select("page_id", F.unhex(F.sha1("payload")).alias("digest"), F.octet_length("payload").cast("long").alias("bytes")), "digests")
    ranges = plan_ranges(keys.withColumn("weight", F.col("bytes") + 512), "page_id", "weight", shard_bytes)

    def numbered(batches):
        for b in batches:
            yield b | {"shard": ranges.find(b["page_id"])}

    # pages and what is known about them meet in the shard: payloads are moved once
    known = revisits(keys, min_bytes).select("page_id", F.lit(None).cast("string").alias("url"), F.lit(None).cast("binary").alias("payload"), "digest", "refers")
    both = rows.withColumns({"digest": F.unhex(F.sha1("payload")), "refers": F.lit(None).cast("long")}).union(known)
    schema = "shard long, page_id long, url string, payload binary, digest binary, refers long"
    placed = map_batches(both, numbered, schema).repartition("shard").sortWithinPartitions(
        "shard", F.col("page_id").asc_nulls_first(), "digest", F.col("payload").isNotNull(), "url")

    def run(batches):
        out, last, refers, nth = None, None, None, 0
        for b in batches:
            for shard, page, target, payload, raw, head in zip(*(b[c] for c in ("shard", "page_id", "url", "payload", "digest", "refers")), strict=True):
                if out is None or shard != out.shard:
                    if out:
                        out.close()
                        yield out.taken()
                    out, last = _Shard(folder, shard, roll_bytes), None
                if (page, raw) != last:
                    last, refers, nth = (page, raw), None, 0
                if payload is None:
                    refers = head
                    continue
                same = page if nth and page is not None and len(payload) >= min_bytes else None
                out.add(page_record(page, target, payload, base64.b32encode(raw).decode(), same if refers is None else refers, nth))
                nth += 1
            if out and out.done:
                yield out.taken()
        if out:
            out.close()
            yield out.taken()

    manifest = map_batches(placed, run, "file string, records long, bytes long, crc32 long")
    manifest.write.parquet(f"{folder}/manifest")
    return spark.read.schema(manifest.schema).parquet(f"{folder}/manifest")


def _members(source) -> Iterator[bytes]:
    """The gzip members of a stream, one after another, without holding the file."""
    reader, parts, rest = zlib.decompressobj(31), [], b""
    while rest or (rest := source.read(1 << 20)):
        parts.append(reader.decompress(rest))
        rest = b""
        if reader.eof:
            yield b"".join(parts)
            rest = reader.unused_data
            reader, parts = zlib.decompressobj(31), []
    if parts and any(parts):
        raise ValueError("an archive ends inside a record")


def _fields(head: bytes) -> dict[str, str]:
    return dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])


def parse_record(raw: bytes) -> dict | None:
    """What a page record says, checked against its digests and lengths; None for a record of another type."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = _fields(head)
    block = rest[:int(fields["Content-Length"])]
    if rest[len(block):] != b"\r\n\r\n" or f"sha1:{digest(block)}" != fields["WARC-Block-Digest"]:
        raise ValueError(f"{fields['WARC-Record-ID']} is damaged")
    kind = fields["WARC-Type"]
    if kind not in ("response", "revisit"):
        return None
    http, _, payload = block.partition(b"\r\n\r\n")
    size, named = int(_fields(http)["Content-Length"]), fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if kind == "response" and (len(payload) != size or digest(payload) != named):
        raise ValueError(f"{fields['WARC-Record-ID']} has another payload")
    refers = fields.get("WARC-Refers-To")
    return {"page_id": _page_of(fields["WARC-Record-ID"]), "url": fields.get("WARC-Target-URI"), "payload_bytes": size,
            "payload_digest": named, "record_type": kind, "refers_to": _page_of(refers) if refers else None,
            "payload": payload if kind == "response" else None}


def read_archives(spark: SparkSession, folder: str, payloads: bool = False) -> DataFrame:
    """Page records of the files that the manifest in ``folder`` lists: page_id, url, payload_bytes, payload_digest,
    record_type, refers_to and, if asked for, payload (null in revisits). Files are streamed; each must have the size,
    checksum and number of records that the manifest says, and each record its digests."""
    manifest = spark.read.parquet(f"{folder}/manifest")
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", *(["payload"] if payloads else [])]

    class Counted:
        def __init__(self, source):
            self.source, self.crc = source, 0

        def read(self, n):
            raw = self.source.read(n)
            self.crc = zlib.crc32(raw, self.crc)
            return raw

    def run(batches):
        fs, path = open_folder(folder)
        for b in batches:
            for name, records, crc in zip(b["file"], b["records"], b["crc32"], strict=True):
                with fs.open_input_stream(f"{path}/{name}", compression=None) as stream:
                    source, seen, rows = Counted(stream), 0, []
                    for raw in _members(source):
                        if row := parse_record(raw):
                            rows.append(row)
                            seen += 1
                        if len(rows) >= 256:
                            yield {n: [r[n] for r in rows] for n in names}
                            rows = []
                    yield {n: [r[n] for r in rows] for n in names}
                if seen != records or source.crc != crc:
                    raise ValueError(f"{name} is not as it was written")

    schema = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"
    # a task for every few files: told so, or adaptive execution would put the short manifest into one task
    files = manifest.select("file", "records", "crc32").repartition(max(1, manifest.count()), "file")
    return map_batches(files, run, schema + (", payload binary" if payloads else ""))


def archive_pages(pages: DataFrame, folder: str | None = None, min_bytes: int = 0) -> DataFrame:
    """Write archives of ``pages`` to ``folder`` (a fresh one in the shared folder unless given) and read them back: one row
    per page. An empty table writes no file and gives no rows; other columns are not read."""
    spark = pages.sparkSession
    folder = folder or fresh_path(spark, "warc")
    write_archives(pages, folder, min_bytes)
    return read_archives(spark, folder)
