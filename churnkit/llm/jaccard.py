"""Near-duplicates by the Jaccard similarity of five-word shingles: candidates from the positional byte index of SimHash
fingerprints and, for what lies further apart, from MinHash bands; an exact check for links."""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from churnkit.llm.common import free_name, stored, text_of
from churnkit.llm.components import component_labels
from churnkit.llm.simhash import fingerprint, posting_links

SHINGLE = 5
LEAST = 0.8
# Two texts of similarity 0.8 agree in a band of 5 with probability 0.33, and in one of 24 at least with 0.99993.
BANDS, ROWS = 24, 5
# In buckets of up to so many texts all pairs are checked at once; in larger ones first each text against the least of so
# many orders, then all that this has not brought together, by blocks of so many texts and characters.
ALL_PAIRS, ORDERS = 32, 6
BLOCK, BLOCK_CHARS = 1024, 1 << 23
CELL = ["band", "value", "i", "j"]

_ODD = np.random.default_rng(7).integers(0, 1 << 63, BANDS * ROWS, np.uint64) | np.uint64(1)
_ADD = np.random.default_rng(8).integers(0, 1 << 63, BANDS * ROWS, np.uint64)
_CHUNK = 1 << 14


def shingles(text: str) -> np.ndarray:
    """Distinct XXH64 values of a text's word shingles, sorted; one of all words if there are fewer, none without words."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    n = max(1, len(words) - SHINGLE + 1)
    grams = map(b" ".join, zip(*(words[i:] for i in range(SHINGLE)), strict=False)) if len(words) >= SHINGLE else (b" ".join(words),)
    return np.unique(np.fromiter(map(partial(xxhash.xxh64_intdigest, seed=42), grams), np.uint64, n))


def bands(grams: np.ndarray) -> np.ndarray:
    """One long for each band: the least values of its five hash functions over the shingles, hashed."""
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(grams), _CHUNK):
        part = grams[at:at + _CHUNK]
        for i in range(BANDS * ROWS):
            least[i] = min(least[i], (part * _ODD[i] + _ADD[i]).min())
    return np.array([xxhash.xxh64_intdigest(b.tobytes()) for b in least.reshape(BANDS, ROWS)], np.uint64).view(np.int64)


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether the similarity of two sorted sets is ``LEAST`` or more; two empty ones are alike."""
    small, large = sorted((len(a), len(b)))
    if small < LEAST * large:
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 5 * both >= 4 * (len(a) + len(b) - both)


def marks(grams: np.ndarray) -> bytes:
    """How many of the shingles fall on each bit, odd or even: four bits a shingle, 512 at least, a power of two.

    Marks of one length differ in no more bits than their sets do in shingles; the two halves of longer ones, one laid on the
    other (xor), are the marks of half the length.
    """
    bits = 1 << max(9, (4 * len(grams) - 1).bit_length())
    fall = np.bincount((grams & np.uint64(bits - 1)).astype(np.int64), minlength=bits)
    return np.packbits((fall & 1).astype(np.uint8)).tobytes()


def _signatures(rows: DataFrame) -> DataFrame:
    """(cls, band, value) of different texts: the value of each band and, as band -1, the five-word SimHash fingerprint."""
    names = np.arange(-1, BANDS, dtype=np.int32)

    def run(batches):
        for b in batches:
            if b.num_rows:
                found = [np.concatenate([np.array([fingerprint(t, SHINGLE)], np.int64), bands(shingles(t))]) for t in b.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(np.asarray(b.column(0)), BANDS + 1)), pa.array(np.tile(names, b.num_rows)), pa.array(np.concatenate(found))],
                    ["cls", "band", "value"])

    # copies of a text meet in every bucket and are one member of it
    return stored(rows.mapInArrow(run, "cls long, band int, value long").distinct(), "signatures")


def _pairs(found: DataFrame) -> DataFrame:
    """Distinct pairs (a, b) of the two ends x and y in either order."""
    return found.where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def _index_pairs(signatures: DataFrame) -> DataFrame:
    """Distinct pairs (a, b) of texts that the positional byte index of fingerprints brings together.

    Texts with one fingerprint meet the least of them, and these meet where their fingerprints share six of eight bytes and
    differ in two bits at most (``simhash.posting_links``), whatever the size of the buckets they are in.
    """
    prints = signatures.where("band = -1").select("cls", F.col("value").alias("fp"))
    least = stored(prints.groupBy("fp").agg(F.min("cls").alias("y")), "prints")
    same = prints.join(least, "fp").select(F.col("cls").alias("x"), "y")
    near = (posting_links(least.select("fp")).join(least.select(F.col("fp").alias("a"), F.col("y").alias("x")), "a")
            .join(least.select(F.col("fp").alias("b"), "y"), "b").select("x", "y"))
    return _pairs(same.union(near))


def _buckets(signatures: DataFrame) -> DataFrame:
    """(band, value, n, o0, ...) of the buckets that texts share, a band and its value: how many, and the least of each order."""
    orders = [F.min(F.struct(F.xxhash64(F.lit(i), "cls").alias("h"), F.col("cls").alias("v"))).alias(f"o{i}") for i in range(ORDERS)]
    return stored(signatures.where("band >= 0").groupBy("band", "value").agg(F.count(F.lit(1)).alias("n"), *orders).where("n > 1"), "full")


def _band_pairs(signatures: DataFrame, full: DataFrame) -> DataFrame:
    """Distinct pairs (a, b) of different texts that share a bucket: all of small ones, and of large ones those with the least
    of each order, which bring near copies together; ``_open_links`` sees to all others."""
    buckets = signatures.where("band >= 0")
    small = (buckets.join(full.where(F.col("n") <= ALL_PAIRS).select("band", "value"), ["band", "value"])
             .groupBy("band", "value").agg(F.collect_list("cls").alias("all"))
             .select(F.explode("all").alias("x"), "all").select("x", F.explode("all").alias("y")))
    large = (buckets.join(full.where(F.col("n") > ALL_PAIRS), ["band", "value"])
             .select(F.col("cls").alias("x"), F.explode(F.array(*[F.col(f"o{i}")["v"] for i in range(ORDERS)])).alias("y")))
    return _pairs(small.union(large))


def _texts(rows: DataFrame, pairs: DataFrame) -> DataFrame:
    """(cls, text, chars) of the texts that are in pairs, each once."""
    nodes = pairs.select(F.col("a").alias("cls")).union(pairs.select(F.col("b").alias("cls"))).distinct()
    texts = rows.join(nodes, "cls", "left_semi").groupBy("cls").agg(F.min("text").alias("text"))
    return stored(texts.withColumn("chars", F.length("text").cast("long")), "texts")


def _links(texts: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs whose texts are similar, by all shingles of both."""
    met = (pairs.join(texts.select(F.col("cls").alias("a"), F.col("text").alias("s")), "a")
           .join(texts.select(F.col("cls").alias("b"), F.col("text").alias("t")), "b").select("a", "b", "s", "t"))

    def run(batches):
        for b in batches:
            near = [similar(shingles(s), shingles(t)) for s, t in zip(b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True)]
            keep = pa.array(near, pa.bool_())
            yield pa.RecordBatch.from_arrays([b.column(0).filter(keep), b.column(1).filter(keep)], ["a", "b"])

    return met.mapInArrow(run, "a long, b long")


def _sides(cell: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Which members of a cell are of its block with fewer, and which are to be held against these."""
    i, j = cell["i"][0].as_py(), cell["j"][0].as_py()
    first = cell["block"].to_numpy() == i
    few = first if 2 * first.sum() <= len(first) or i == j else ~first
    return few, few if i == j else ~few


def _close(cell: pa.Table) -> pa.Table:
    """The members of a cell that may be similar to one of the other side under another label, as far as sizes and marks tell:
    of similar sets the shingles of one alone are a ninth of all at most."""
    few, against = _sides(cell)
    label, size = cell["label"].to_numpy(), cell["size"].to_numpy()
    rows = [np.frombuffer(m, np.uint64) for m in cell["marks"].to_pylist()]
    width = np.array([len(m) for m in rows])
    met = np.zeros(len(rows), bool)
    for w in np.unique(width):  # sizes of similar sets differ by a quarter, so marks have one length, or one has twice the other's
        at = np.flatnonzero((width == w) | (width == 2 * w))
        table = np.array([rows[k] if width[k] == w else rows[k][:w] ^ rows[k][w:] for k in at])
        brief = np.bitwise_xor.reduce(table.reshape(len(at), 4, -1), axis=1)  # a quarter of the length rules out most
        lead, ys = few[at], at[against[at]]
        others, short = table[against[at]], np.ascontiguousarray(brief[against[at]].T)
        for x, own, start in zip(at[lead], table[lead], brief[lead], strict=True):
            most = (size[ys] + size[x]) // 9
            near = np.flatnonzero(np.bitwise_count(short ^ start[:, None]).sum(0, dtype=np.int32) <= most)
            near = near[(label[ys[near]] != label[x]) & (np.abs(size[ys[near]] - size[x]) <= most[near])]
            near = near[np.bitwise_count(others[near] ^ own).sum(1, dtype=np.int32) <= most[near]]
            met[ys[near]] = True
            met[x] |= len(near) > 0
    return cell.select([*CELL, "block", "cls", "label"]).filter(pa.array(met))


def _joined(cell: pa.Table) -> pa.Table:
    """Pairs (a, b) of labels, enough to connect all that similar texts of the two sides connect."""
    few, against = _sides(cell)
    label = cell["label"].to_numpy()
    sets = [np.frombuffer(g, np.uint64) for g in cell["grams"].to_pylist()]
    size = np.array([len(s) for s in sets])
    _, ids, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    member = np.repeat(np.arange(len(sets)), size)
    # shingles of a sixteenth of the texts and more are bits of a row, others that come again are looked up
    often, seldom = 16 * times >= len(sets), times > 1
    seldom &= ~often
    bits = np.zeros((len(sets), 64 * -(-often.sum() // 64)), bool)
    bits[member[often[ids]], (np.cumsum(often) - 1)[ids[often[ids]]]] = True
    shared = np.packbits(bits, axis=1).view(np.uint64)
    del bits
    member, ids = member[seldom[ids]], ids[seldom[ids]]
    bounds = np.searchsorted(member, np.arange(len(sets) + 1))
    own, group, found = np.zeros(len(times), bool), label.copy(), []
    for x in np.flatnonzero(few):
        mine = ids[bounds[x]:bounds[x + 1]]
        own[mine] = True
        both = np.bitwise_count(shared & shared[x]).sum(1, dtype=np.int64) + np.diff(np.concatenate([[0], np.cumsum(own[ids])])[bounds])
        own[mine] = False
        for y in np.flatnonzero((9 * both >= 4 * (size + size[x])) & against & (group != group[x])):
            if group[y] != group[x]:
                found.append((label[x], label[y]))
                group[group == group[y]] = group[x]
    ends = np.array(found, np.int64).reshape(-1, 2)
    return pa.table({"a": ends[:, 0], "b": ends[:, 1]})


def _open_links(signatures: DataFrame, full: DataFrame, texts: DataFrame, labels: DataFrame) -> DataFrame:
    """Pairs (a, b) of labels that similar texts in a large bucket have, where the bucket's texts have more labels than one.

    All texts of such a bucket that differ in their label are held against each other: cells are pairs of blocks, and texts
    under the bucket's most frequent label are in blocks of their own, which are not held against one another. Marks, a
    sixteenth of a set's bytes, say exactly which pairs cannot be similar; what they leave is compared by whole sets. A cell
    gives no more pairs than it has texts.
    """
    named = (texts.select("cls", "chars").join(labels.withColumnRenamed("node", "cls"), "cls", "left")
             .select("cls", "chars", F.coalesce("label", "cls").alias("label")))
    large = full.where(F.col("n") > ALL_PAIRS).select("band", "value")
    members = stored(signatures.join(large, ["band", "value"]).join(named, "cls"), "members")
    sums = members.groupBy("band", "value", "label").agg(F.count(F.lit(1)).alias("n"), F.sum("chars").alias("chars"))
    blocks = lambda n, chars: F.greatest(n / BLOCK, chars / BLOCK_CHARS)
    split = (sums.groupBy("band", "value").agg(F.max(F.struct("n", "chars", "label")).alias("main"), F.sum("n").alias("n"), F.sum("chars").alias("chars"))
             .where("main.n < n").withColumn("k", F.floor(blocks(F.col("main.n"), F.col("main.chars"))))
             .withColumn("m", F.ceil(F.when(F.col("k") == 0, blocks(F.col("n"), F.col("chars")))
                                     .otherwise(blocks(F.col("n") - F.col("main.n"), F.col("chars") - F.col("main.chars")))))
             .select("band", "value", "k", "m", F.when(F.col("k") > 0, F.col("main.label")).alias("main")))
    place = F.xxhash64(F.lit("block"), "cls")
    known = F.coalesce(F.col("label") == F.col("main"), F.lit(False))
    dealt = stored(members.join(split, ["band", "value"])
                   .withColumn("block", F.when(known, F.pmod(place, F.greatest("k", F.lit(1)))).otherwise(F.col("k") + F.pmod(place, "m")))
                   .withColumn("from", F.when(known, F.col("k")).otherwise(F.lit(0)))
                   .select("band", "value", "cls", "label", "block", "from", (F.col("k") + F.col("m") - 1).alias("to")), "dealt")

    def run(batches):
        for b in batches:
            sets = [shingles(t) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array([marks(s) for s in sets], pa.binary()),
                 pa.array([s.tobytes() for s in sets], pa.binary())], ["cls", "size", "marks", "grams"])

    sets = stored(texts.join(dealt.select("cls").distinct(), "cls", "left_semi").select("cls", "text")
                  .mapInArrow(run, "cls long, size long, marks binary, grams binary"), "sets")
    cells = (dealt.join(sets.select("cls", "size", "marks"), "cls").withColumn("other", F.explode(F.sequence("from", "to")))
             .select("band", "value", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "cls", "label", "size", "marks"))
    close = cells.groupBy(*CELL).applyInArrow(_close, "band int, value long, i long, j long, block long, cls long, label long")
    return (stored(close, "close").join(sets.select("cls", "grams"), "cls").groupBy(*CELL).applyInArrow(_joined, "a long, b long"))


def drop_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of each near-duplicate group: that of the smallest key.

    Texts link if they are equal or if the similarity of their five-word shingles is 0.8 or more; groups are what links
    connect. The SimHash index says which texts may link; two of 64 bits are less than a similarity of 0.8 leaves apart, so
    MinHash bands name those beyond it, and both are held against whole texts. Of rows with the key that stays the one whose text is least in order stays. Rows without a key cannot stand
    for a group and are kept as they are. A null text is empty. An empty table gives none.
    """
    rows = docs.select(F.col(key).alias("key"), text_of(text).alias("text")).withColumn("cls", F.xxhash64("text"))
    texts = rows.select("cls", "text")
    signatures = _signatures(texts)
    full = _buckets(signatures)
    pairs = stored(_index_pairs(signatures).union(_band_pairs(signatures, full)).distinct(), "pairs")
    paired = _texts(texts, pairs)
    labels = component_labels(_links(paired, pairs))
    wider = component_labels(_open_links(signatures, full, paired, labels)).select(F.col("node").alias("label"), F.col("label").alias("wider"))
    least = rows.groupBy("cls").agg(F.min("key").alias("least"))
    grouped = (least.join(labels.withColumnRenamed("node", "cls"), "cls", "left").select("least", F.coalesce("label", "cls").alias("label"))
               .join(wider, "label", "left").select("least", F.coalesce("wider", "label").alias("label")))
    stay = grouped.groupBy("label").agg(F.min("least").alias(key)).select(key).where(F.col(key).isNotNull()).distinct()
    met = docs.join(stay, key, "left_semi")
    order = Window.partitionBy(key).orderBy(text)
    number = free_name(docs, "_row")
    once = met.withColumn(number, F.row_number().over(order)).where(F.col(number) == 1).drop(number)
    return once.union(docs.where(F.col(key).isNull()))
