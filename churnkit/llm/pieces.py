"""SentencePiece ids by unigram Viterbi over a double-array trie, with byte fallback, and the way back to text."""

from __future__ import annotations

import pickle
import re
from array import array
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnkit.llm.common import text_of

SPACE = "▁"
_MARK = SPACE.encode()
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
# What an unknown sign costs beyond the least score, as the library has it.
UNKNOWN_PENALTY = 10.0
# New words after which a process starts a new store; words met again are taken over from the last one.
CACHE_WORDS = 350_000
# Places that the building of a trie looks at, behind the last one taken and before it.
WINDOW = 4096
# A word with the markers before it; no piece may cross such a place.
_WORD = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")


@dataclass(frozen=True)
class Trie:
    """Double array over bytes: the child of node s by byte c is t = base[s] + c + 1 if check[t] is s; ``value`` has the piece
    that ends at a node, or -1. Node 0 is the root."""

    base: array
    check: array
    value: array


def build_trie(words: dict[bytes, int]) -> Trie:
    """The double array of some words and their numbers, filled by first fit."""
    children: list[dict[int, int]] = [{}]
    ends = [-1]
    for word, number in words.items():
        at = 0
        for c in word:
            below = children[at].get(c)
            if below is None:
                below = children[at][c] = len(children)
                children.append({})
                ends.append(-1)
            at = below
        ends[at] = number
    base, check, value = array("i", [0]), array("i", [-2]), array("i", [ends[0]])

    def grow(size: int) -> None:
        more = size - len(check)
        if more > 0:
            base.extend([0] * more)
            check.extend([-1] * more)
            value.extend([-1] * more)

    # a bit for each free place of a window that moves along: where all children fit comes from shifting it over itself
    low, width = 257, 2 * WINDOW
    free = (1 << width) - 1
    todo = [(0, 0)]
    while todo:
        node, at = todo.pop()
        below = children[node]
        if not below:
            continue
        codes = sorted(below)
        fits = free
        for c in codes[1:]:
            fits &= free >> (c - codes[0])
        offset = low + (fits & -fits).bit_length() - 1 - codes[0] - 1
        grow(offset + 258)
        base[at] = offset
        for c in codes:
            place = offset + c + 1
            free &= ~(1 << (place - low))
            check[place] = at
            value[place] = ends[below[c]]
            todo.append((below[c], place))
        if not free >> WINDOW == (1 << WINDOW) - 1:
            # its second half has been touched: move on by a quarter
            free = free >> WINDOW // 2 | ((1 << WINDOW // 2) - 1) << (width - WINDOW // 2)
            low += WINDOW // 2
    # every look-up stays inside the arrays
    grow(max(base) + 257)
    return Trie(base, check, value)


@dataclass(frozen=True)
class PieceModel:
    """What encoding and decoding need of a model file."""

    trie: Trie
    scores: list[float]
    unknown: int
    unknown_score: float
    byte_ids: list[int] | None
    shown: list[bytes]
    prefix: bool
    by_words: bool


def read_model(raw: bytes) -> PieceModel:
    """The pieces and scores of a SentencePiece model file, read as a unigram model whatever trained them.

    Only what changes no text but its white space is understood: an identity normaliser without a character map and
    markers in front of words. Anything else is refused rather than encoded differently.
    """
    from sentencepiece import sentencepiece_model_pb2 as pb
    model = pb.ModelProto()
    model.ParseFromString(raw)
    normal, trained = model.normalizer_spec, model.trainer_spec
    kinds = {p.type for p in model.pieces}
    if (normal.precompiled_charsmap or normal.remove_extra_whitespaces or not normal.escape_whitespaces
            or trained.treat_whitespace_as_suffix or kinds - {NORMAL, UNKNOWN, CONTROL, BYTE}):
        raise ValueError("a model with a character map, changed white space, suffix markers or user-defined pieces")
    words = {p.piece.encode(): i for i, p in enumerate(model.pieces) if p.type == NORMAL}
    unknown = next(i for i, p in enumerate(model.pieces) if p.type == UNKNOWN)
    shown = []
    for p in model.pieces:
        if p.type == BYTE:
            shown.append(bytes([int(p.piece[3:5], 16)]))
        else:
            shown.append({NORMAL: p.piece.replace(SPACE, " "), UNKNOWN: trained.unk_surface}.get(p.type, "").encode())
    of_byte = {p.piece: i for i, p in enumerate(model.pieces) if p.type == BYTE}
    scores = [float(p.score) for p in model.pieces]
    return PieceModel(
        build_trie(words), scores, unknown, min((scores[i] for i in words.values()), default=0.0) - UNKNOWN_PENALTY,
        [of_byte[f"<0x{b:02X}>"] for b in range(256)] if trained.byte_fallback else None, shown, normal.add_dummy_prefix,
        not any(re.search(f"[^{SPACE}]{SPACE}", w.decode()) for w in words))


class PieceCoder:
    """Encodes and decodes whole texts. Words met before are looked up: no piece of such a model goes from a sign to a marker
    after it, so the best path of a text is those of its words one after another. Other models get whole texts."""

    def __init__(self, model: PieceModel):
        self.model = model
        self.words: dict[str, bytes] = {}
        self.last: dict[str, bytes] = {}

    def best_path(self, raw: bytes) -> list[int]:
        """Ids of the path with the greatest sum of scores; of equal ones that whose last piece is longest, as in the library.

        Sums are doubles over one word or text, so they are exact for whole-numbered scores however long the text is.
        """
        m = self.model
        base, check, value, scores, n = m.trie.base, m.trie.check, m.trie.value, m.scores, len(raw)
        best: list[float | None] = [None] * (n + 1)
        best[0] = 0.0
        came: list[tuple[int, int]] = [(0, -1)] * (n + 1)
        for start in range(n):
            so_far = best[start]
            if so_far is None:
                continue
            lead = raw[start]
            first = start + (1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4)
            node, at, single = 0, start, False
            while at < n:
                below = base[node] + raw[at] + 1
                if check[below] != node:
                    break
                node = below
                at += 1
                piece = value[node]
                if piece >= 0:
                    single = single or at == first
                    score = so_far + scores[piece]
                    old = best[at]
                    if old is None or score > old:
                        best[at] = score
                        came[at] = start, piece
            if not single:
                score = so_far + m.unknown_score
                old = best[first]
                if old is None or score > old:
                    best[first] = score
                    came[first] = start, m.unknown
        path, end = [], n
        while end:
            start, piece = came[end]
            if piece != m.unknown:
                path.append(piece)
            elif m.byte_ids is not None:
                path += [m.byte_ids[b] for b in reversed(raw[start:end])]
            elif not path or path[-1] != piece:
                path.append(piece)
            end = start
        path.reverse()
        return path

    def _ids(self, word: str) -> bytes:
        found = self.last.get(word)
        if found is None:
            found = array("i", self.best_path(word.encode())).tobytes()
        self.words[word] = found
        return found

    def encode(self, text: str) -> np.ndarray:
        """Ids of one text, as int32; none of an empty one. Surrogates, which UTF-8 lacks, are read as question marks."""
        if not text:
            return np.empty(0, np.int32)
        if not text.isascii():
            text = text.encode("utf-8", "replace").decode()
        marked = (SPACE if self.model.prefix else "") + text.replace(" ", SPACE)
        if not self.model.by_words:
            return np.array(self.best_path(marked.encode()), np.int32)
        if len(self.words) > CACHE_WORDS:
            self.words, self.last = {}, self.words
        known, ids = self.words, self._ids
        # without byte fallback a run of unknown signs is one id, but never over a marker, which is a piece or unknown itself
        return np.frombuffer(b"".join([known.get(w) or ids(w) for w in _WORD.findall(marked)]), np.int32)

    def decode(self, ids: np.ndarray) -> str:
        """The text of some ids: markers as spaces without the one put before the text, runs of bytes as UTF-8."""
        shown = self.model.shown
        text = b"".join([shown[i] for i in ids.tolist()]).decode("utf-8", "replace")
        return text[1:] if self.model.prefix and text[:1] == " " else text


_CODERS: dict[str, PieceCoder] = {}


def _coder(name: str, sent) -> PieceCoder:
    """One coder for each model and process, so that the words it has seen serve later tasks too."""
    if name not in _CODERS:
        _CODERS.clear()
        _CODERS[name] = PieceCoder(pickle.loads(sent.value))
    return _CODERS[name]


def piece_ids(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_ids, ids, decoded, restored) per row: ids of the whole text, the text made of these ids again, and whether it is
    the one that was given.

    The model is read on the driver and its trie broadcast, once to each executor; documents are mapped where they are
    read. A text comes back unless it has the marker sign itself, which stands for a space. A null text counts as empty and
    has no ids; null and repeated keys get a row each; an empty table gives none; other columns are not read.
    """
    kind = docs.schema[key].dataType.simpleString()
    with open(path, "rb") as file:
        raw = file.read()
    sent = docs.sparkSession.sparkContext.broadcast(pickle.dumps(read_model(raw)))
    name = f"{path}:{hash(raw)}"

    def run(batches):
        coder = _coder(name, sent)
        for b in batches:
            if not b.num_rows:
                continue
            texts = b.column(1).to_pylist()
            ids = [coder.encode(t) for t in texts]
            decoded = [coder.decode(i) for i in ids]
            sizes = np.array([len(i) for i in ids], np.int64)
            ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(sizes), pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(ids))),
                 pa.array(decoded, pa.string()), pa.array([t == d for t, d in zip(texts, decoded, strict=True)])],
                ["key", "n_ids", "ids", "decoded", "restored"])

    rows = docs.select(F.col(key).alias("key"), text_of(text).alias("text"))
    return rows.mapInArrow(run, f"key {kind}, n_ids long, ids array<int>, decoded string, restored boolean").withColumnRenamed("key", key)
