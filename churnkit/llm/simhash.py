"""SimHash near-duplicates through a byte-position inverted index with count filtering."""

from __future__ import annotations

from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnkit.llm.common import map_batches, stored, text_of
from churnkit.llm.components import component_labels

SEED = 42
POSITIONS = 8
# Two differing bits touch two bytes at most, so linked fingerprints share at least six of their eight positional bytes.
MAX_BITS = 2
GUARANTEED = POSITIONS - MAX_BITS

_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)
_OFFSETS = (256 * np.arange(POSITIONS)).astype(np.int64)
_CHUNK = 1 << 16


def fingerprint(text: str, shingle: int = 3) -> int:
    """The 64-bit SimHash of one text: majority bits of XXH64 over its word shingles; 0 without words."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        grams = iter((b" ".join(words),))
        total = 1
    else:
        grams = map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False))
        total = len(words) - shingle + 1
    hashes = np.fromiter(map(partial(xxhash.xxh64_intdigest, seed=SEED), grams), np.uint64, total)
    votes = np.zeros((POSITIONS, 8), np.int64)
    for at in range(0, total, _CHUNK):
        octets = hashes[at:at + _CHUNK].astype(">u8").view(np.uint8).reshape(-1, POSITIONS)
        tally = np.bincount((octets + _OFFSETS).ravel(), minlength=256 * POSITIONS).reshape(POSITIONS, 256)
        votes += tally @ _BITS
    return int.from_bytes(np.packbits(votes.ravel() * 2 > total).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 3) -> DataFrame:
    """(key, fp) for every row of ``docs``; fp is the fingerprint as a signed long."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches):
        for b in batches:
            yield {"key": b["key"], "fp": [fingerprint(t, shingle) for t in b["text"]]}

    rows = docs.select(F.col(key).alias("key"), text_of(text).alias("text"))
    return map_batches(rows, run, f"key {kind}, fp long").withColumnRenamed("key", key)


def _masks() -> list[int]:
    """For each choice of six of the eight byte positions, the mask of those bytes."""
    return [sum(0xFF << (8 * p) for p in chosen) for chosen in combinations(range(POSITIONS), GUARANTEED)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def _close_words() -> np.ndarray:
    """All 16-bit words with one or two bits set: how the two bytes outside a posting may differ."""
    words = np.arange(1 << 16, dtype=np.uint32)
    return words[(words != 0) & (np.bitwise_count(words) <= MAX_BITS)]


_CLOSE = _close_words()
_SMALL = 96


def _roots(prints: np.ndarray) -> np.ndarray:
    """For fingerprints of one posting list, the index of the least member each is connected to by verified links.

    A short list is verified pair by pair. Members of a longer one differ in 16 bits only, so links are looked up in a
    table of those words: work and memory are in proportion to the list, of at most 65,536 members.
    """
    n = len(prints)
    label = np.arange(n)
    if n <= _SMALL:
        near = np.bitwise_count(prints[:, None] ^ prints[None, :]) <= MAX_BITS
        while True:
            least = np.where(near, label[None, :], n).min(1)
            if (least == label).all():
                return label
            label = least
    differing = np.bitwise_or.reduce(prints ^ prints[0])
    free = [p for p in range(POSITIONS) if int(differing) >> (8 * p) & 0xFF]
    low = sum(((prints >> np.uint64(8 * p)) & np.uint64(0xFF)) << np.uint64(8 * i) for i, p in enumerate(free)).astype(np.int64)
    place = np.full(1 << 16, -1)
    place[low] = label
    while True:
        least = label.copy()
        for word in _CLOSE:
            other = place[low ^ int(word)]
            np.minimum(least, np.where(other >= 0, label[other], n), out=least)
        least = least[least]
        if (least == label).all():
            return label
        label = least


def posting_links(prints: DataFrame) -> DataFrame:
    """Links (a, b) between distinct fingerprints that differ in two bits at most, enough to connect all that are linked.

    The inverted index is over positional bytes. Counting shared (position, byte) postings per pair one byte at a time
    would read lists of n / 256 members, so postings hold the guaranteed minimum at once: a list for each choice of six
    positions and the bytes there. A pair's tally reaches six exactly if it meets in one of the 28 lists it can meet in.
    Members of a list are distinct and differ in two bytes only, so a list has at most 65,536 of them however skewed the
    input is. Within a list pairs are verified by their differing bits, and each member is linked to the least member
    reachable there: at most one row per member, never all pairs.
    """
    masks = _masks()
    lists = F.array(*[F.struct(F.lit(i).alias("chosen"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("bytes"))
                      for i, m in enumerate(masks)])
    postings = prints.select("fp", F.explode(lists).alias("list")).select("list.chosen", "list.bytes", "fp")
    spread = postings.repartition("chosen", "bytes").sortWithinPartitions("chosen", "bytes", "fp")

    def run(batches):
        held: list[np.ndarray] = []
        for batch in batches:
            cols = [np.asarray(batch.column(i)) for i in range(3)]
            if held:
                cols = [np.concatenate([h, c]) for h, c in zip(held, cols, strict=True)]
            if not len(cols[0]):
                continue
            new = np.flatnonzero((np.diff(cols[0]) != 0) | (np.diff(cols[1]) != 0)) + 1
            last = new[-1] if len(new) else 0
            held = [c[last:] for c in cols]
            yield from _linked(np.concatenate([[0], new]), cols[2][:last])
        if held:
            yield from _linked(np.zeros(1, np.int64), held[2])

    def _linked(starts, fps):
        starts = starts[starts < len(fps)]
        sizes = np.diff(np.append(starts, len(fps)))
        for at, size in zip(starts[sizes > 1], sizes[sizes > 1], strict=True):
            members = fps[at:at + size]
            root = _roots(members.view(np.uint64))
            linked = root != np.arange(size)
            if linked.any():
                yield pa.RecordBatch.from_arrays([pa.array(members[linked]), pa.array(members[root[linked]])], ["a", "b"])

    return spread.mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 3) -> DataFrame:
    """(key, fingerprint, component_id) per row: near-duplicate groups of documents.

    Fingerprints link at two or fewer differing bits; component_id is the smallest key reachable over links, the row's own
    included. Exact copies share a fingerprint and are one member of the index, so groups of any size cost one posting set.
    A null text is empty and empty texts have fingerprint 0, linked like any other. Rows with a null key get a result and
    count as no smallest key; a group of null keys alone has a null component. Repeated rows each get a row; an empty table
    gives none. Other columns of ``docs`` are not read.
    """
    prints = stored(fingerprints(docs, key, text, shingle), "fingerprints")
    classes = prints.groupBy("fp").agg(F.min(key).alias("least"))
    labels = component_labels(posting_links(classes.select("fp")))
    grouped = stored(classes.join(labels.withColumnRenamed("node", "fp"), "fp", "left")
                     .select("fp", "least", F.coalesce("label", "fp").alias("label")), "classes")
    least = grouped.groupBy("label").agg(F.min("least").alias("component_id"))
    names = grouped.join(least, "label").select("fp", "component_id")
    return prints.join(names, "fp").select(
        key, F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
