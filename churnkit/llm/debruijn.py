"""Long passages that repeat across documents, by compaction of a De Bruijn graph of words.

An edge of the graph is a window of 50 words. Edges are not written one by one: consecutive windows of a document that
choose the same place as the least of their 16-word k-mers form one path, which is told by that k-mer and by a digest of its
words (about one row for 18 words). A copy of a window chooses the same k-mer at the same place, so all copies of an edge lie
on paths of one k-mer. Equal paths are compacted by an aggregation. Where only one path goes through a k-mer it does not
branch, and all its edges share their source. Only where paths branch are they opened into edges, from the words at the
coordinates of one source each, and edges are compacted in turn. Joins bring the sources back to every document's paths.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnkit.llm.common import stored, text_of

WINDOW, KMER = 50, 16
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)
_EMPTY = hashlib.sha256(b"").hexdigest()
_DOC = "n_words long, kept_sha256 string, paths array<struct<kmer:long,high:long,low:long,at:int,n:int>>"
_PATH = pa.struct([("kmer", pa.int64()), ("high", pa.int64()), ("low", pa.int64()), ("at", pa.int32()), ("n", pa.int32())])


def split_words(text: str) -> list[bytes]:
    """Words between ASCII white space, as UTF-8."""
    return text.encode("utf-8", "surrogatepass").split()


def _starts(words: list[bytes]) -> np.ndarray:
    """Where each word begins in the words joined by one space; one more entry for a word behind the last."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    return np.concatenate([[0], np.cumsum(sizes + 1)])


def _digests(joined: bytes, starts: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """128-bit digests of the words from ``first`` up to ``last``, two signed longs each."""
    spans = zip(starts[first].tolist(), (starts[last] - 1).tolist(), strict=True)
    return np.frombuffer(b"".join(xxhash.xxh3_128_digest(joined[a:b]) for a, b in spans), ">i8").astype(np.int64).reshape(-1, 2)


def paths(words: list[bytes], joined: bytes, window: int = WINDOW, kmer: int = KMER) -> tuple[np.ndarray, ...]:
    """(kmer hash, digest, first window, number of windows) of each path of a document, in order.

    The least k-mer of every window, the leftmost of equal ones, is found for all windows at once by doubling the reach.
    """
    n = len(words) - window + 1
    if n < 1:
        none = np.empty(0, np.int64)
        return none, none.reshape(0, 2), none, none
    gram, reach = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words)), 1
    while reach < kmer:
        step = min(reach, kmer - reach)
        gram = (gram[:-step] * _MIX[0] + _MIX[1]) ^ (gram[step:] * _MIX[2])
        gram ^= gram >> np.uint64(31)
        reach += step
    gram = gram * _MIX[3]
    gram ^= gram >> np.uint64(29)
    least, reach = np.arange(len(gram)), 1
    while reach < window - kmer + 1:
        step = min(reach, window - kmer + 1 - reach)
        left, right = least[:-step], least[step:]
        least = np.where(gram[right] < gram[left], right, left)
        reach += step
    at = np.concatenate([[0], np.flatnonzero(np.diff(least)) + 1])
    ends = np.append(at[1:], n)
    return gram[least[at]].view(np.int64), _digests(joined, _starts(words), at, ends + window - 1), at, ends - at


def _text_rows(docs: DataFrame, key: str, text: str) -> DataFrame:
    """key, text, and the hash that tells rows of one key apart."""
    return docs.select(F.col(key).alias("key"), text_of(text).alias("text")).withColumn("tag", F.xxhash64("text"))


def _document_paths(rows: DataFrame, window: int) -> DataFrame:
    """Words, digest and paths of every document."""
    kind = rows.schema["key"].dataType.simpleString()

    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            n_words, shas, found, ends = [], [], [], [0]
            for t in b.column(1).to_pylist():
                words = split_words(t)
                joined = b" ".join(words)
                n_words.append(len(words))
                shas.append(hashlib.sha256(joined).hexdigest())
                found.append(paths(words, joined, window))
                ends.append(ends[-1] + len(found[-1][0]))
            grams, marks, at, n = (np.concatenate([f[i] for f in found]) for i in range(4))
            cells = pa.StructArray.from_arrays(
                [pa.array(grams), pa.array(marks[:, 0].copy()), pa.array(marks[:, 1].copy()), pa.array(at.astype(np.int32)),
                 pa.array(n.astype(np.int32))], fields=list(_PATH))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(2), pa.array(n_words, pa.int64()), pa.array(shas),
                 pa.ListArray.from_arrays(pa.array(ends, pa.int32()), cells)],
                ["key", "tag", "n_words", "kept_sha256", "paths"])

    return rows.mapInArrow(run, f"key {kind}, tag long, {_DOC}")


def _open_paths(rows: DataFrame, wanted: DataFrame, window: int) -> DataFrame:
    """Edges of the wanted paths (key, tag, high, low, at, n), read from the words at their coordinates: the path's digest, the
    edge's place on it and the edge's own digest. ``key`` is the least one that has the path."""
    asked = wanted.groupBy("key", "tag").agg(F.collect_list(F.struct("high", "low", "at", "n")).alias("asked"))
    kind = rows.schema["key"].dataType.simpleString()

    def run(batches):
        for b in batches:
            for key, text, asked in zip(b.column(0), b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                words = split_words(text)
                joined, starts = b" ".join(words), _starts(words)
                n = np.array([a["n"] for a in asked])
                step = np.concatenate([np.arange(k) for k in n])
                first = np.repeat([a["at"] for a in asked], n) + step
                marks = _digests(joined, starts, first, first + window)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat([a["high"] for a in asked], n)), pa.array(np.repeat([a["low"] for a in asked], n)),
                     pa.array(step.astype(np.int32)), pa.array(marks[:, 0].copy()), pa.array(marks[:, 1].copy()),
                     pa.repeat(key, len(step))], ["high", "low", "step", "edge_high", "edge_low", "key"])

    met = rows.join(asked, ["key", "tag"]).select("key", "text", "asked")
    return met.mapInArrow(run, f"high long, low long, step int, edge_high long, edge_low long, key {kind}")


def path_sources(occurrences: DataFrame, rows: DataFrame, window: int) -> DataFrame:
    """(high, low, source, edges) for each path with an edge that more than one key may have: the least key that has the path
    if it does not branch, else the least key of each of its edges as an array of (step, source)."""
    compact = stored(occurrences.groupBy("kmer", "high", "low").agg(
        F.min(F.struct("key", "tag", "at", "n")).alias("first"), F.max("key").alias("last")), "paths")
    joints = compact.groupBy("kmer").agg(F.count(F.lit(1)).alias("forms"), F.min("first.key").alias("least"), F.max("last").alias("most"))
    repeated = stored(compact.join(joints.where("least < most").select("kmer", "forms"), "kmer")
                      .select("high", "low", "first", "forms"), "repeated")
    edges = stored(_open_paths(rows, repeated.where("forms > 1").select("first.*", "high", "low"), window), "edges")
    least = edges.groupBy("edge_high", "edge_low").agg(F.min("key").alias("source"))
    opened = (edges.join(least, ["edge_high", "edge_low"]).groupBy("high", "low")
              .agg(F.collect_set(F.struct("step", "source")).alias("edges")))
    none = F.lit(None).cast(opened.schema["edges"].dataType)
    straight = repeated.where("forms = 1").select("high", "low", F.col("first.key").alias("source"), none.alias("edges"))
    return straight.unionByName(opened.withColumn("source", F.lit(None).cast(straight.schema["source"].dataType)))


def _covered(window: int) -> Column:
    """Spans of words (first, behind the last) of a document's path whose windows start in a lesser key too."""
    whole = F.struct(F.col("at").alias("a"), (F.col("at") + F.col("n") + F.lit(window - 1)).alias("b"))
    parts = F.transform(F.filter("edges", lambda e: e["source"] < F.col("key")), lambda e: F.struct(
        (F.col("at") + e["step"]).alias("a"), (F.col("at") + e["step"] + F.lit(window)).alias("b")))
    return F.when(F.col("edges").isNotNull(), parts).when(F.col("source") < F.col("key"), F.array(whole))


def repeated_spans(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """Stored document rows (key, tag, n_words, kept_sha256 of all words) and, for keys with words to remove, their spans of words.

    Keys that are null are no sources and lose nothing. Rows of one key are no sources for each other.
    """
    rows = _text_rows(docs, key, text)
    documents = stored(_document_paths(rows, window), "documents")
    occurrences = documents.where("key IS NOT NULL").select("key", "tag", F.explode("paths").alias("p")).select("key", "tag", "p.*")
    sources = path_sources(occurrences, rows.where("key IS NOT NULL"), window)
    met = occurrences.join(sources, ["high", "low"]).select("key", "tag", _covered(window).alias("spans")).where(F.size("spans") > 0)
    # as long as a document is at most; repeated rows of a document give each span again
    spans = met.select("key", "tag", F.explode("spans").alias("span")).distinct().groupBy("key", "tag").agg(F.collect_list("span").alias("spans"))
    return documents, stored(spans, "spans")


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """(key, n_words, n_removed, kept_sha256, kept) per row: the words left when each word is removed that is covered by
    a window of ``window`` words which also starts in a document of a smaller key.

    Windows are judged on the input. ``kept`` has the words joined by one space; it is null where nothing was removed, so that
    texts which stay as they are need not be moved. Texts of fewer words than a window lose nothing. A null text has no words. Rows with a null
    key lose nothing and are no source; rows of one key do not make each other lose words; repeated rows get a row each. An
    empty table gives none. Other columns of ``docs`` are not read.
    """
    documents, spans = repeated_spans(docs, key, text, window)
    kind = docs.schema[key].dataType.simpleString()

    def run(batches):
        for b in batches:
            out = []
            for text, spans in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                words = split_words(text)
                depth = np.zeros(len(words) + 1, np.int64)
                np.add.at(depth, [s["a"] for s in spans], 1)
                np.add.at(depth, [s["b"] for s in spans], -1)
                left = [words[i] for i in np.flatnonzero(np.cumsum(depth[:-1]) == 0).tolist()]
                joined = b" ".join(left)
                out.append((len(words), len(words) - len(left), hashlib.sha256(joined).hexdigest(), joined.decode("utf-8", "replace")))
            if out:
                n, gone, sha, kept = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(sha), pa.array(kept)],
                    ["key", "n_words", "n_removed", "kept_sha256", "kept"])

    touched = _text_rows(docs, key, text).join(spans, ["key", "tag"]).select("key", "text", "spans")
    changed = touched.mapInArrow(run, f"key {kind}, n_words long, n_removed long, kept_sha256 string, kept string")
    rest = documents.join(spans.select("key", "tag"), ["key", "tag"], "left_anti").select(
        "key", "n_words", F.lit(0).cast("long").alias("n_removed"), "kept_sha256", F.lit(None).cast("string").alias("kept"))
    return changed.union(rest).withColumnRenamed("key", key)
