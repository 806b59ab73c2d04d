"""Alignment of two tokenizers' ids over the same bytes, and how often ids meet in the whole corpus.

A is a byte-level tokenizer of the tokenizers library, B a SentencePiece model. Both tell where in the text a token lies: A in
characters, B in bytes. Places where both say that a token ends are coarse cuts. Between them spans can be too coarse: tokens
that share a character have one span. There the bytes that tokens stand for say where each ends.
"""

from __future__ import annotations

import gc
import hashlib
import json
import os
import re
from functools import lru_cache
from itertools import accumulate
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnkit.llm.common import stored
from churnkit.llm.tokens import _byte_letters, _steps, separable

SPACE = "▁"
# New words after which a process starts a new store; words met again are taken over from the last one.
CACHE_WORDS = 200_000
# Words of the documents of one block. Its table of pairs is as large as its different words have, so it is bounded as well.
BLOCK_WORDS = 1 << 19
# New words that are encoded as one text, and texts whose tokens are held at once.
JOINED_WORDS = 256
JOINED_TEXTS = 16
_NORMAL, _BYTE = 1, 6
# Letters that have been letters in every version of Unicode, and digits.
_LETTER = "[0-9" + "".join(c for c in map(chr, range(0x250)) if c.isalpha()) + "]"
_MARK = re.escape("!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")


def _word_pattern(spaces: str, marks: bool) -> re.Pattern:
    """Words with the white space before them. Between two words white space begins with one of ``spaces``, or, if ``marks``, none is
    there and a letter or digit is followed by a mark. White space at the end of a text belongs to the word before it."""
    part = rf"(?:[{_MARK}]++[^\s{_MARK}]*+|[^\s{_MARK}]++)(?:(?<!{_LETTER})[{_MARK}]++[^\s{_MARK}]*+)*+" if marks else r"\S++"
    return re.compile(rf"\s*+{part}(?:(?![{spaces}])\s++{part})*+(?:\s++\Z)?+|\s+")


class Aligned(NamedTuple):
    """Two rows of ids over the same bytes: their groups as text and how the ids meet. ``pairs`` has a << 32 | b for each
    pair of tokens with a byte in common, as 64-bit integers. Without tokens everything is empty."""

    n_a: int
    n_b: int
    n_groups: int
    groups: str
    pairs: bytes

    @property
    def n_links(self) -> int:
        return len(self.pairs) // 8


_NONE = Aligned(0, 0, 0, "", b"")


def byte_ends(spans: list[tuple[int, int]], sizes: list[int], cuts: set[int], start: int = 0) -> list[int]:
    """Where each token ends; the first begins at ``start``. Between two cuts the spans say so if they follow one another without a
    gap or an overlap, each of as many bytes as its token; else the sizes of the tokens do."""
    ends: list[int] = []
    first = 0
    for i, (_, end) in enumerate(spans):
        if i + 1 < len(spans) and (end not in cuts or spans[i + 1][0] != end):
            continue
        block = spans[first:i + 1]
        clean = block[0][0] == start and all(p[1] == q[0] for p, q in zip(block, block[1:], strict=False)) and all(
            q - p == n for (p, q), n in zip(block, sizes[first:i + 1], strict=True))
        ends += [q for _, q in block] if clean else [start + n for n in accumulate(sizes[first:i + 1])]
        start, first = ends[-1], i + 1
    return ends


class SpanAligner:
    """Aligned ids of texts, found once for each word (with the white space before it) where both tokenizers cut there. Signs after
    a letter or digit are words of their own if both cut there too."""

    def __init__(self, path_a: str, path_b: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as pb
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        with open(path_a, encoding="utf-8") as file:
            spec = json.load(file)
        byte_of = {c: b for b, c in _byte_letters().items()}
        vocabulary = self.a.get_vocab(with_added_tokens=False)
        # an added token that is no word of the vocabulary is never met here
        self.bytes_a = [b""] * (max(vocabulary.values()) + 1)
        for t, i in vocabulary.items():
            if all(c in byte_of for c in t):
                self.bytes_a[i] = bytes(byte_of[c] for c in t)
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        model = pb.ModelProto()
        with open(path_b, "rb") as file:
            model.ParseFromString(file.read())
        if not model.normalizer_spec.add_dummy_prefix:
            raise ValueError("a model that puts no space before a text")
        self.bytes_b = [bytes([int(p.piece[3:5], 16)]) if p.type == _BYTE else p.piece.replace(SPACE, " ").encode() for p in model.pieces]
        self.sizes_a, self.sizes_b = (np.array(list(map(len, t)), np.int64) for t in (self.bytes_a, self.bytes_b))
        normal = [p.piece for p in model.pieces if p.type == _NORMAL]
        plain = (not model.normalizer_spec.precompiled_charsmap and not model.normalizer_spec.remove_extra_whitespaces
                 and separable(spec) and not any(re.search(f"[^{SPACE}]{SPACE}", p) for p in normal))
        lines = plain and model.trainer_spec.byte_fallback and not any("\n" in p for p in normal)
        # the pattern of byte-level tokenizers never goes from a letter or digit to one of these signs
        marks = (lines and len(_steps(spec["pre_tokenizer"], "pretokenizers")) == 1
                 and not any(re.search(f"{_LETTER}[{_MARK}]", p) for p in normal))
        self.cut = _word_pattern(" \n" if lines else " ", marks) if plain else None
        # ids as they are written in groups: followed by another one of their side, last of A, last of B
        n = max(len(self.bytes_a), len(self.bytes_b))
        self.written, self.last_a, self.last_b = [f"{i}{sign}" for sign in ",|;" for i in range(n)], n, 2 * n
        self.known: dict[str, Aligned | None] = {}
        self.last: dict[str, Aligned | None] = {}

    def words(self, text: str) -> list[str]:
        """A space and the text, cut where no token of either reaches over."""
        text = " " + text
        return self.cut.findall(text) if self.cut else [text]

    def learn(self, texts: list[list[str]]) -> None:
        """Align the words that were not met before, many in one text of each library."""
        if len(self.known) > CACHE_WORDS:
            self.known, self.last = {}, self.known
        known, last = self.known, self.last
        met = set().union(*texts) - known.keys()
        for word in met & last.keys():
            known[word] = last[word]
        new = list(met - last.keys())
        if new:
            # nothing made here has cycles; a collector that walks the growing stores takes a fifth of the time
            gc.disable()
            try:
                self._learn_joined(new)
                gc.freeze()
            finally:
                gc.enable()

    def _learn_joined(self, new: list[str]) -> None:
        # a word with white space at its end was the end of its text, and the marker sign is a space to B: nothing may follow
        alone = [w for w in new if self.cut is None or w[-1].isspace() or SPACE in w]
        if alone:
            apart = set(alone)
            new = [w for w in new if w not in apart]
        joined = [new[i:i + JOINED_WORDS] for i in range(0, len(new), JOINED_WORDS)] + [[w] for w in alone]
        failed: list[list[str]] = []
        for words, found in zip(joined, self._encoded(joined), strict=True):
            if found is None and len(words) > 1:
                failed += [[w] for w in words]
            else:
                self.known.update(zip(words, found or [None], strict=True))
        for words, found in zip(failed, self._encoded(failed), strict=True):
            self.known.update(zip(words, found or [None], strict=True))

    def _encoded(self, joined: list[list[str]]):
        """The alignments of each list of words, encoded as one text; None where one side's bytes are not the text's."""
        for i in range(0, len(joined), JOINED_TEXTS):
            yield from self._encoded_together(joined[i:i + JOINED_TEXTS])

    def _encoded_together(self, joined: list[list[str]]):
        # a word that begins with neither a space nor a line end followed a letter: a line end, a token of its own, keeps it off
        texts = ["".join([w if w[0] in " \n" else "\n" + w for w in words]) for words in joined]
        found_a = self.a.encode_batch(texts, add_special_tokens=False)
        # a text begins with the space that B adds itself, or with a line end and then goes without it
        found_b = self.b.encode([t[1:] if t[0] == " " else t for t in texts], return_type="offset_mapping", num_threads=1)
        return map(self._aligned, joined, texts, found_a, found_b)

    def _aligned(self, words: list[str], text: str, found_a, found_b) -> list[Aligned] | None:
        raw = text.encode()
        # B was given the text without its space or, if it begins with a line end, has put one before it
        shift = 1 if text[0] == " " else 0
        a, spans_a = found_a.ids, found_a.offsets
        b, spans_b = (found_b["ids"], found_b["offsets"]) if shift else (found_b["ids"][1:], found_b["offsets"][1:])
        if b"".join(map(self.bytes_a.__getitem__, a)) != raw or b"".join(map(self.bytes_b.__getitem__, b)) != raw:
            return None
        a, b = np.array(a, np.int64), np.array(b, np.int64)
        to = np.cumsum([len(w) + (w[0] not in " \n") for w in words])
        since = to - np.array(list(map(len, words)))
        ends_a, ends_b = np.array([e for _, e in spans_a]), np.array([e for _, e in spans_b]) + shift
        at = None
        if len(raw) != len(text):
            # the byte at which each character begins
            at = np.append(np.flatnonzero(np.frombuffer(raw, np.int8) >= -64), len(raw))
            ends_a, ends_b, since, to = at[ends_a], at[ends_b], at[since], at[to]
        sums_a, sums_b = np.cumsum(self.sizes_a[a]), np.cumsum(self.sizes_b[b])
        from_a, from_b = np.searchsorted(sums_a, since, "right"), np.searchsorted(sums_b, since, "right")
        to_a, to_b = np.searchsorted(sums_a, to, "right"), np.searchsorted(sums_b, to, "right")
        if not all((s[t - 1] == to).all() and (s[f - 1] == since)[since > 0].all()
                   for s, f, t in ((sums_a, from_a, to_a), (sums_b, from_b, to_b))):
            return None
        coarse = {*np.searchsorted(to, sums_a[ends_a != sums_a]).tolist(), *np.searchsorted(to, sums_b[ends_b != sums_b]).tolist()}
        if coarse:
            # tokens that share a character with another one
            starts_a, starts_b = np.array([s for s, _ in spans_a]), np.array([s + shift if s else 0 for s, _ in spans_b])
            near_a, near_b = (list(zip((starts if at is None else at[starts]).tolist(), ends.tolist(), strict=True))
                              for starts, ends in ((starts_a, ends_a), (starts_b, ends_b)))
            sizes_a, sizes_b = self.sizes_a[a].tolist(), self.sizes_b[b].tolist()
            for k in coarse:
                x, y, start = slice(from_a[k], to_a[k]), slice(from_b[k], to_b[k]), int(since[k])
                cuts = {e for _, e in near_a[x]} & {e for _, e in near_b[y]}
                ends_a[x], ends_b[y] = byte_ends(near_a[x], sizes_a[x], cuts, start), byte_ends(near_b[y], sizes_b[y], cuts, start)
        # Each stretch up to the next end of either is one pair of tokens with bytes in common; a group goes up to an end of both.
        ends = np.sort(np.concatenate([ends_a, ends_b]), kind="stable")
        ends = ends[np.append(True, ends[1:] != ends[:-1])]
        i, j = np.searchsorted(ends_a, ends), np.searchsorted(ends_b, ends)
        pairs = (a[i] << 32 | b[j]).astype("<i8").tobytes()
        both = ends[(ends_a[i] == ends) & (ends_b[j] == ends)]
        group_a, group_b = np.searchsorted(both, ends_a), np.searchsorted(both, ends_b)
        last_a, last_b = both[group_a] == ends_a, both[group_b] == ends_b
        order = np.empty(len(a) + len(b), np.int64)
        order[np.arange(len(a)) + np.append(0, np.flatnonzero(last_b) + 1)[group_a]] = a + last_a * self.last_a
        order[np.arange(len(b)) + (np.flatnonzero(last_a) + 1)[group_b]] = b + last_b * self.last_b
        written = list(map(self.written.__getitem__, order.tolist()))
        n_groups = np.searchsorted(both, to, "right") - np.searchsorted(both, since, "right")
        froms, tos = (from_a + from_b).tolist(), (to_a + to_b).tolist()
        first, end = (8 * np.searchsorted(ends, since, "right")).tolist(), (8 * np.searchsorted(ends, to, "right")).tolist()
        return list(map(Aligned, (to_a - from_a).tolist(), (to_b - from_b).tolist(), n_groups.tolist(),
                        ["".join(written[f:t])[:-1] for f, t in zip(froms, tos, strict=True)],
                        [pairs[f:t] for f, t in zip(first, end, strict=True)]))

    def align_text(self, text: str) -> Aligned:
        """The alignment of one whole text."""
        if not text:
            return _NONE
        words = self.words(text)
        self.learn([words])
        parts = [self.known[w] for w in words]
        if None in parts:
            return _NONE
        return Aligned(sum(p.n_a for p in parts), sum(p.n_b for p in parts), sum(p.n_groups for p in parts),
                       ";".join(p.groups for p in parts), b"".join(p.pairs for p in parts))


@lru_cache(maxsize=2)
def aligner(path_a: str, path_b: str) -> SpanAligner:
    """One aligner for each pair of files and process, so that the words it has met serve later tasks too."""
    return SpanAligner(path_a, path_b)


class _Places(dict):
    """The number of each word of a block, given when it is first met."""

    def __init__(self, known: dict[str, Aligned | None]):
        super().__init__()
        self.known, self.found, self.texts, self.bad = known, [], [], False

    def __missing__(self, word: str) -> int:
        one = self.known[word]
        if one is None:
            self.bad = True
            return -1
        at = self[word] = len(self.found)
        self.found.append(one)
        self.texts.append(one.groups)
        return at


class _Block:
    """Some documents of one task: each has the numbers of its words, and the block the words' alignments."""

    def __init__(self, number: int, keep_groups: bool = True):
        self.number, self.size, self.keep_groups = number, 0, keep_groups
        self.keys, self.docs, self.groups, self.shas = [], [], [], []
        self.place = _Places({})

    def add(self, key, words: list[str] | None, known: dict[str, Aligned | None]) -> None:
        place = self.place
        place.known, place.bad = known, False
        ids = list(map(place.__getitem__, words or ()))
        if place.bad:
            ids = []
        groups = ";".join(map(place.texts.__getitem__, ids))
        self.keys.append(key)
        self.shas.append(hashlib.sha256(groups.encode()).hexdigest() if groups else "")
        self.groups.append(groups if self.keep_groups else None)
        self.docs.append(np.array(ids, np.int32))
        self.size += len(ids) + 1

    def rows(self, names: list[str], key_type: pa.DataType):
        """A row for each document, then one for the block."""
        found = self.place.found
        sizes = np.array([(f.n_a, f.n_b, f.n_groups, f.n_links) for f in found], np.int64).reshape(-1, 4)
        n = len(self.keys)
        sums = np.array([sizes[d].sum(0) for d in self.docs]).reshape(-1, 4)
        none = [None] * n
        yield pa.RecordBatch.from_arrays(
            [pa.repeat(pa.scalar(self.number, pa.int64()), n), pa.array(self.keys, key_type), *[pa.array(sums[:, i].copy()) for i in range(4)],
             pa.array(self.shas), pa.array(self.groups, pa.string()), pa.array([d.tobytes() for d in self.docs]), pa.array(none, pa.list_(pa.int64())),
             pa.array(none, pa.list_(pa.int64())), pa.array(none, pa.binary()), pa.array(none, pa.binary())], names)
        pairs, at = np.unique(np.frombuffer(b"".join([f.pairs for f in found]), np.int64), return_inverse=True)
        ids = np.concatenate([np.zeros(0, np.int32), *self.docs])
        often = np.bincount(ids, minlength=len(found))
        counts = np.bincount(at, np.repeat(often, sizes[:, 3]), len(pairs)).astype(np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array([self.number]), pa.array([None], key_type), *[pa.array([None], pa.int64())] * 4, *[pa.array([None], pa.string())] * 2,
             pa.array([None], pa.binary()), pa.array([pairs.tolist()], pa.list_(pa.int64())), pa.array([counts.tolist()], pa.list_(pa.int64())),
             pa.array([sizes[:, 3].astype(np.int32).tobytes()]), pa.array([at.astype(np.int32).tobytes()])], names)


_NAMES = ["n_a", "n_b", "n_groups", "n_links"]
_BLOCKS = (f"{', '.join(f'{n} long' for n in _NAMES)}, groups_sha256 string, groups string, words binary, "
           "pairs array<long>, counts array<long>, word_pairs binary, places binary")


def aligned_blocks(docs: DataFrame, path_a: str, path_b: str, key: str = "doc_id", text: str = "text", keep_groups: bool = True) -> DataFrame:
    """A row for each document with its own figures and, for each block of documents, one with the block's pairs of ids."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_type
        key_type = to_arrow_type(docs_key)
        task = TaskContext.get().partitionId() << 32
        names = ["block", "key", *_NAMES, "groups_sha256", "groups", "words", "pairs", "counts", "word_pairs", "places"]
        tool, block = aligner(path_a, path_b), _Block(task, keep_groups)
        for b in batches:
            keys, texts = b.column(0).to_pylist(), b.column(1).to_pylist()
            cut = [tool.words(t) if t else None for t in texts]
            tool.learn([w for w in cut if w])
            for k, words in zip(keys, cut, strict=True):
                block.add(k, words, tool.known)
                if block.size >= BLOCK_WORDS:
                    yield from block.rows(names, key_type)
                    block = _Block(block.number + 1, keep_groups)
        if block.keys:
            yield from block.rows(names, key_type)

    docs_key = docs.schema[key].dataType
    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, f"block long, key {kind}, {_BLOCKS}")


def pair_counts(blocks: DataFrame) -> DataFrame:
    """(pair, count, best) for each pair of ids in the corpus: at how many links it is, and whether no other id of A has more with
    that id of B."""
    each = blocks.where("pairs IS NOT NULL").select(F.explode(F.arrays_zip("pairs", "counts")).alias("p"))
    counts = stored(each.groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.counts").alias("count")), "pairs")
    b = F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF))
    best = counts.groupBy(b.alias("b")).agg(F.max("count").alias("most"))
    return counts.withColumn("b", b).join(best, "b").select("pair", "count", (F.col("count") == F.col("most")).alias("best"))


def _corpus_sums(key_type, kind):
    """Each document's links against the counts of the whole corpus, for one block."""
    names = ["key", *_NAMES, "n_best", "count_sum", "groups_sha256", "groups"]

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        is_block = pa.compute.is_valid(left["pairs"])
        own, docs = left.filter(is_block), left.filter(pa.compute.invert(is_block))
        n = right.num_rows
        count, best = np.zeros(n, np.int64), np.zeros(n, np.int64)
        at = right["place"].to_numpy()
        count[at] = right["count"].to_numpy()
        best[at] = right["best"].to_numpy(zero_copy_only=False)
        sizes = np.frombuffer(own["word_pairs"][0].as_py(), np.int32)
        places = np.frombuffer(own["places"][0].as_py(), np.int32)
        ends = np.concatenate([[0], np.cumsum(sizes)])

        def per_word(values):
            upto = np.concatenate([[0], np.cumsum(values[places])])
            return upto[ends[1:]] - upto[ends[:-1]]

        counts, bests = per_word(count), per_word(best)
        words = [np.frombuffer(w, np.int32) for w in docs["words"].to_pylist()]
        sums = [[int(v[w].sum()) for w in words] for v in (bests, counts)]
        return pa.table([docs["key"], *[docs[n] for n in _NAMES], *[pa.array(s, pa.int64()) for s in sums], docs["groups_sha256"], docs["groups"]], names)

    return run, f"key {kind}, {', '.join(f'{n} long' for n in [*_NAMES, 'n_best', 'count_sum'])}, groups_sha256 string, groups string"


def align_tokens(docs: DataFrame, path_a: str, path_b: str, key: str = "doc_id", text: str = "text", keep_groups: bool = True) -> DataFrame:
    """(key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256, groups) per row: how the tokens of A over a space
    and the text meet the tokens of B over the text, which adds the space.

    Groups lie between the bytes where both end, written a1,a2|b1;a3|b2,b3. A link is a pair of tokens with a byte in common; the count of
    its ids is the number of links in the corpus that hold them. ``n_best`` counts links whose count is the highest of their id
    of B, ``count_sum`` adds up the counts. Special tokens' strings are plain text. Texts that are null or empty, or that one
    side does not give back byte by byte (such as texts with the marker sign), have no tokens: zeros and ''. Every row has a
    result, repeated and null keys too; an empty table gives none; other columns are not read. ``keep_groups`` False leaves
    the groups themselves out.

    Documents are dealt into blocks of bounded size where they are read. A block asks for the counts of its own different pairs once,
    so links are never moved, and a pair that is everywhere has a row for each block.
    """
    blocks = stored(aligned_blocks(docs, path_a, path_b, key, text, keep_groups), "blocks")
    asked = blocks.where("pairs IS NOT NULL").select(F.col("block").alias("asker"), F.posexplode("pairs").alias("place", "pair"))
    told = asked.join(pair_counts(blocks), "pair").select("asker", "place", "count", "best")
    run, schema = _corpus_sums(docs.schema[key].dataType, docs.schema[key].dataType.simpleString())
    held = blocks.select("block", "key", *_NAMES, "groups_sha256", "groups", "words", "pairs", "word_pairs", "places")
    return held.groupBy("block").cogroup(told.groupBy("asker")).applyInArrow(run, schema).withColumnRenamed("key", key)
