"""Token ids of a corpus in Huffman-coded files, in the order of their documents' keys."""

from __future__ import annotations

import io
import json
import struct
import zlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnkit.llm.common import fresh_path, map_batches, open_folder, stored, text_of, write_then_rename
from churnkit.llm.huffman import BLOCK, Codebook, code_lengths
from churnkit.llm.ranges import plan_ranges
from churnkit.llm.tokens import encoder

MAGIC = b"IDHUF001"
END_ID = 0
# Ids in a file, about; one task holds the codes of one file at a time.
FILE_TOKENS = 4_000_000
# Ids coded at once: arrays of so many stay in a core's own memory.
_CODED_IDS = 100_000


# Bytes of ids counted at once: many more than there are ids, few enough to be held twice.
_COUNTED_BYTES = 1 << 21


def _stretches(parts: list[bytes], most: int):
    """Consecutive parts of about ``most`` bytes together."""
    at, held = 0, 0
    for i, p in enumerate(parts):
        held += len(p)
        if held >= most:
            yield parts[at:i + 1]
            at, held = i + 1, 0
    if at < len(parts):
        yield parts[at:]


def encode_documents(docs: DataFrame, tokenizer: str, end_id: int = END_ID, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_tokens, wide, ids): the ids of each whole text and ``end_id`` after them, as little-endian integers of 16
    bits where the ids of the tokenizer fit, of 32 if ``wide``. A null text is empty and has the end id alone.

    After its documents, each task adds a row with how often it met each id: n_tokens is null there, ids has pairs of id
    and count, 64 bits each.
    """
    kind = docs.schema[key].dataType.simpleString()

    def run(batches):
        enc = encoder(tokenizer)
        short = max(enc.tokenizer.get_vocab_size(), end_id + 1) <= 1 << 16
        if short:
            enc = encoder(tokenizer, short)
        end, size = struct.pack("<H" if short else "<I", end_id), 2 if short else 4
        counts = np.zeros(0, np.int64)
        for b in batches:
            coded = [ids + end for ids in enc.encode(b["text"])]
            for part in _stretches(coded, _COUNTED_BYTES):
                seen = np.bincount(_numbers(b"".join(part), not short))
                if len(seen) > len(counts):
                    counts = np.concatenate([counts, np.zeros(len(seen) - len(counts), np.int64)])
                counts[:len(seen)] += seen
            yield {"key": b["key"], "n_tokens": [len(c) // size for c in coded], "wide": [not short] * len(coded), "ids": coded}
        used = np.flatnonzero(counts)
        yield {"key": [None], "n_tokens": [None], "wide": [None], "ids": [np.stack([used, counts[used]]).astype("<i8").tobytes()]}

    rows = docs.select(F.col(key).alias("key"), text_of(text).alias("text"))
    return map_batches(rows, run, f"key {kind}, n_tokens long, wide boolean, ids binary").withColumnRenamed("key", key)


def _numbers(raw: bytes, wide: bool) -> np.ndarray:
    return np.frombuffer(raw, "<u4" if wide else "<u2")


def count_ids(encoded: DataFrame) -> DataFrame:
    """(id, n) over all documents, summed from the counts that the tasks have made."""
    def run(batches):
        for b in batches:
            for raw in b["ids"]:
                ids, counts = np.frombuffer(raw, "<i8").reshape(2, -1)
                yield {"id": ids, "n": counts}

    return map_batches(encoded.where("n_tokens is null").select("ids"), run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


def _code_rows(encoded: DataFrame, key: str, book: Codebook, ranges) -> DataFrame:
    """Each document's code and checkpoints, with the number of the file it goes to."""
    def run(batches):
        for b in batches:
            shards = ranges.find(b["key"])
            at = 0
            while at < len(shards):
                stop, n = at, 0
                while stop < len(shards) and (stop == at or n + b["n_tokens"][stop] <= _CODED_IDS):
                    n += b["n_tokens"][stop]
                    stop += 1
                part = slice(at, stop)
                ids = np.concatenate([_numbers(i, w) for i, w in zip(b["ids"][part], b["wide"][part], strict=True)]).astype(np.int64)
                sizes = np.array(b["n_tokens"][part])
                payloads, marks = book.encode(ids, sizes)
                cuts = np.cumsum(-(-sizes // BLOCK))[:-1]
                yield {"shard": shards[part], "key": b["key"][part], "n_tokens": sizes, "payload": payloads,
                       "marks": [m.astype("<u8").tobytes() for m in np.split(marks, cuts)]}
                at = stop

    return map_batches(encoded.select(F.col(key).cast("long").alias("key"), "n_tokens", "ids", "wide"), run,
                       "shard long, key long, n_tokens long, payload binary, marks binary")


def _write_file(folder: str, shard: int, first: int, rows: list[tuple]) -> dict:
    """One file under a temporary name, then under its own. A second attempt of a task writes the same bytes again."""
    keys, sizes, payloads, marks = zip(*rows, strict=True)
    head = json.dumps({"docs": len(rows), "first_token": first, "block": BLOCK, "marks": sum(map(len, marks))}).encode()
    body = io.BytesIO()
    body.write(MAGIC + struct.pack("<I", len(head)) + head)
    body.write(np.array([k is None for k in keys], np.uint8).tobytes())
    for column in ([k or 0 for k in keys], sizes, [len(p) for p in payloads]):
        body.write(np.array(column, "<i8").tobytes())
    for part in (*marks, *payloads):
        body.write(part)
    raw = body.getvalue()
    fs, path = open_folder(folder)
    name = f"ids-{shard:08d}.huf"
    fs.create_dir(path, recursive=True)
    write_then_rename(fs, f"{path}/{name}", raw)
    return {"file": name, "docs": len(rows), "first_token": first, "tokens": int(sum(sizes)), "bytes": len(raw), "crc32": zlib.crc32(raw)}


def write_id_files(encoded: DataFrame, folder: str, key: str = "doc_id", file_tokens: int = FILE_TOKENS) -> DataFrame:
    """Write ``encoded`` (of ``encode_documents``, stored) to ``folder`` and return its manifest.

    Codes come from the counts of all documents. Files hold ranges of the key that depend on the rows alone; in a file,
    documents ascend by key (null first; equal keys by content). The manifest, a Parquet table in the folder that is
    committed last, lists every file with its size and checksum; files it does not list are leftovers. One task holds a file
    of about ``file_tokens`` ids, or one key's documents if these are more.
    """
    counted = count_ids(encoded).collect()  # as many rows as the tokenizer has ids, at most
    counts = np.zeros(max([0, *(r.id for r in counted)]) + 1, np.int64)
    for r in counted:
        counts[r.id] = r.n
    book = Codebook(code_lengths(counts))
    documents = encoded.where("n_tokens is not null")
    ranges = plan_ranges(documents, key, "n_tokens", file_tokens)
    firsts = np.cumsum([0, *ranges.totals]).tolist()
    fs, path = open_folder(folder)
    fs.create_dir(path, recursive=True)
    write_then_rename(fs, f"{path}/codebook.bin", zlib.compress(book.lengths.astype(np.uint8).tobytes()))

    def run(batches):
        held, shard = [], None
        for b in batches:
            for s, *row in zip(b["shard"], b["key"], b["n_tokens"], b["payload"], b["marks"], strict=True):
                if s != shard and held:
                    yield {k: [v] for k, v in _write_file(folder, shard, firsts[shard], held).items()}
                    held = []
                shard = s
                held.append(tuple(row))
        if held:
            yield {k: [v] for k, v in _write_file(folder, shard, firsts[shard], held).items()}

    rows = (_code_rows(documents, key, book, ranges).repartition("shard")
            .sortWithinPartitions("shard", F.col("key").asc_nulls_first(), "n_tokens", "payload"))
    manifest = map_batches(rows, run, "file string, docs long, first_token long, tokens long, bytes long, crc32 long")
    manifest.write.parquet(f"{folder}/manifest")
    return encoded.sparkSession.read.schema(manifest.schema).parquet(f"{folder}/manifest")


def _read_file(raw: bytes, book: Codebook) -> dict:
    """(keys, starts, sizes, ids) of a file's bytes."""
    if raw[:len(MAGIC)] != MAGIC:
        raise ValueError("not a file of token ids")
    size = struct.unpack_from("<I", raw, len(MAGIC))[0]
    at = len(MAGIC) + 4
    head = json.loads(raw[at:at + size])
    at += size
    n = head["docs"]
    null = np.frombuffer(raw, np.uint8, n, at)
    keys, sizes, octets = (np.frombuffer(raw, "<i8", n, at + n + 8 * n * i) for i in range(3))
    at += n + 24 * n
    marks = np.frombuffer(raw, "<u8", head["marks"] // 8, at).astype(np.int64)
    blocks = -(-sizes // head["block"])
    doc = np.repeat(np.arange(n), blocks)
    nth = np.arange(len(doc)) - (np.cumsum(blocks) - blocks)[doc]
    held = np.minimum(head["block"], sizes[doc] - nth * head["block"])
    ids = book.decode(raw[at + head["marks"]:], marks + 8 * (np.cumsum(octets) - octets)[doc], held)
    return {"keys": [None if x else k for x, k in zip(null, keys.tolist(), strict=True)],
            "starts": head["first_token"] + np.cumsum(sizes) - sizes, "sizes": sizes, "ids": ids}


def read_id_files(spark: SparkSession, folder: str, digest_only: bool = False) -> DataFrame:
    """Documents of the files that the manifest in ``folder`` lists: key, start (ids of all documents before it), n_tokens,
    ids_crc32 (of its ids as little-endian unsigned 32-bit integers) and, unless ``digest_only``, ids as such bytes.

    Each file is read, checked against the manifest and decoded by itself; a file that is missing or changed is an error.
    """
    manifest = spark.read.parquet(f"{folder}/manifest")

    def run(batches):
        fs, path = open_folder(folder)
        with fs.open_input_stream(f"{path}/codebook.bin", compression=None) as source:
            book = Codebook(np.frombuffer(zlib.decompress(source.read()), np.uint8).astype(np.int64))
        for b in batches:
            for name, crc in zip(b["file"], b["crc32"], strict=True):
                with fs.open_input_stream(f"{path}/{name}", compression=None) as source:
                    raw = source.read()
                if zlib.crc32(raw) != crc:
                    raise ValueError(f"{name} is not as it was written")
                got = _read_file(raw, book)
                ends = np.cumsum(got["sizes"])
                parts = [got["ids"][e - n:e].astype("<u4").tobytes() for e, n in zip(ends.tolist(), got["sizes"].tolist(), strict=True)]
                out = {"key": got["keys"], "start": got["starts"], "n_tokens": got["sizes"], "ids_crc32": list(map(zlib.crc32, parts))}
                yield out if digest_only else out | {"ids": parts}

    schema = "key long, start long, n_tokens long, ids_crc32 long" + ("" if digest_only else ", ids binary")
    # a task for every few files: told so, or adaptive execution would put the short manifest into one task
    return map_batches(manifest.select("file", "crc32").repartition(max(1, manifest.count()), "file"), run, schema)


def corpus_ids(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", folder: str | None = None) -> DataFrame:
    """Encode ``docs``, write id files to ``folder`` (a fresh one in the shared folder unless given) and read them back.

    One row per document of any kind: null keys come first in order, repeated keys follow one another, a null text is
    empty, an empty table writes no file and gives no rows. Other columns are not read.
    """
    spark = docs.sparkSession
    folder = folder or fresh_path(spark, "ids")
    encoded = stored(encode_documents(docs, tokenizer, END_ID, key, text), "encoded")
    write_id_files(encoded, folder, key)
    return read_id_files(spark, folder, digest_only=True).withColumnRenamed("key", key)
