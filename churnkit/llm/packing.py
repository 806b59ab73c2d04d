"""Packing token ids into fixed windows by minimum bin slack."""

from __future__ import annotations

import struct
import zlib
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnkit.llm.common import map_batches, stored, text_of
from churnkit.llm.tokens import encoder

WINDOW = 2048
END_ID = 1
# Pieces a task holds while it looks for windows that they fill; beyond it, windows are closed until half of it is left.
POOL = 8192


def best_filling(counts: dict[int, int], window: int) -> list[int]:
    """Lengths out of ``counts`` (how many pieces of each length there are) whose sum comes closest to ``window`` from below.

    Subset-sum dynamic programming over a bitset of reachable sums: bit s of ``reach`` is set if some of the lengths seen
    add up to s. Longest lengths come first and each at most as often as it is there; the search ends when the window can
    be full. Going back through the stages tells how many pieces of each length were used.
    """
    full = (1 << (window + 1)) - 1
    reach, stages = 1, []
    for length in sorted(counts, reverse=True):
        for _ in range(min(counts[length], window // length)):
            wider = (reach | reach << length) & full
            if wider == reach:
                break
            stages.append((length, reach))
            reach = wider
            if reach >> window & 1:
                break
        if reach >> window & 1:
            break
    at = reach.bit_length() - 1
    used = []
    for length, before in reversed(stages):
        if not before >> at & 1:
            used.append(length)
            at -= length
    return used


@dataclass
class Piece:
    """Ids of one document from ``start`` on."""

    key: object
    start: int
    ids: bytes
    total: int

    def __len__(self) -> int:
        return len(self.ids) // 4


@dataclass
class Packer:
    """Fills windows from pieces as they come and numbers them from 0. ``rows`` has what is settled."""

    window: int = WINDOW
    pool: int = POOL
    rows: list[tuple] = field(default_factory=list)
    sequences: int = 0
    _held: dict[int, list[Piece]] = field(default_factory=dict)
    _count: int = 0
    _ids: int = 0

    def add(self, key: object, ids: bytes) -> None:
        """A document: its full windows are sequences of their own, what is left joins the pool."""
        total = len(ids) // 4
        cut = total // self.window * self.window
        for at in range(0, cut, self.window):
            self._emit([Piece(key, at, ids[4 * at:4 * (at + self.window)], total)])
        if cut < total:
            self._put(Piece(key, cut, ids[4 * cut:], total))
        if self._count > self.pool:
            while self._count > self.pool // 2 and self._ids >= self.window:
                self._fill()

    def finish(self) -> None:
        """Pack all that is left. What is not enough for a window goes into sequences of powers of two, which need no
        padding."""
        while self._ids >= self.window:
            self._fill()
        rest = [p for n in sorted(self._held, reverse=True) for p in self._held[n]]
        self._held, self._count, self._ids = {}, 0, 0
        size = 1 << max(0, sum(map(len, rest)).bit_length() - 1)
        while rest:
            if sum(map(len, rest)) >= size:
                self._emit(self._take(rest, size))
            size >>= 1

    def _put(self, piece: Piece) -> None:
        self._held.setdefault(len(piece), []).append(piece)
        self._count += 1
        self._ids += len(piece)

    def _fill(self) -> None:
        """Close one window: the longest piece and those that fill the rest best; a gap left is filled by cutting another."""
        longest = max(self._held)
        chosen = [self._pop(longest)]
        chosen += [self._pop(n) for n in best_filling({n: len(p) for n, p in self._held.items()}, self.window - longest)]
        gap = self.window - sum(map(len, chosen))
        if gap and self._held:
            rest = self._pop(min(self._held))
            if len(rest) <= gap:
                raise AssertionError("a piece that fits was left out")
            chosen += self._take([rest], gap)
            self._put(Piece(rest.key, rest.start + gap, rest.ids[4 * gap:], rest.total))
        self._emit(chosen)

    def _pop(self, length: int) -> Piece:
        pieces = self._held[length]
        piece = pieces.pop()
        if not pieces:
            del self._held[length]
        self._count -= 1
        self._ids -= length
        return piece

    @staticmethod
    def _take(pieces: list[Piece], size: int) -> list[Piece]:
        """The first ``size`` ids of the pieces; what is left of the last stays in front of the list."""
        out = []
        while size:
            first = pieces.pop(0)
            n = min(size, len(first))
            out.append(Piece(first.key, first.start, first.ids[:4 * n], first.total))
            if n < len(first):
                pieces.insert(0, Piece(first.key, first.start + n, first.ids[4 * n:], first.total))
            size -= n
        return out

    def _emit(self, pieces: list[Piece]) -> None:
        at = 0
        for p in pieces:
            self.rows.append((p.key, p.start, len(p), zlib.crc32(p.ids), p.total, self.sequences, at))
            at += len(p)
        self.sequences += 1


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int = END_ID, window: int = WINDOW, pool: int = POOL,
                   key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per piece: key, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Every document (its ids and ``end_id``; a null text is empty) is cut into full windows and a remainder. Remainders meet
    in a pool of the task that read them, of at most ``pool`` pieces, where windows are filled by minimum bin slack; a gap
    that no piece fits is filled by cutting one. So all sequences are full but those of a task's last remainder, which have
    lengths of powers of two: nothing is padded. Sequences are numbered from 0 without gaps, in the order of the tasks.
    Every row of ``docs`` is packed, null and repeated keys included; an empty table gives no rows. Texts are not shuffled.
    """
    kind = docs.schema[key].dataType.simpleString()
    names = ["key", "start", "length", "ids_crc32", "doc_tokens", "local", "offset"]

    def run(batches):
        from pyspark import TaskContext
        part = TaskContext.get().partitionId()
        enc, packer, end = encoder(tokenizer), Packer(window, pool), struct.pack("<I", end_id)

        def settled():
            rows, packer.rows = packer.rows, []
            return {"part": [part] * len(rows)} | {n: [r[i] for r in rows] for i, n in enumerate(names)}

        for b in batches:
            for k, ids in zip(b["key"], enc.encode(b["text"]), strict=True):
                packer.add(k, ids + end)
            yield settled()
        packer.finish()
        yield settled()

    schema = f"part int, key {kind}, start long, length long, ids_crc32 long, doc_tokens long, local long, offset long"
    pieces = stored(map_batches(docs.select(F.col(key).alias("key"), text_of(text).alias("text")), run, schema), "pieces")
    # one number per input task
    sizes = sorted((r.part, r.n) for r in pieces.groupBy("part").agg((F.max("local") + 1).alias("n")).collect())
    firsts, at = [], 0
    for part, n in sizes:
        firsts.append((part, at))
        at += n
    first = docs.sparkSession.createDataFrame(firsts, "part int, first long")
    return pieces.join(first, "part").select(
        F.col("key").alias(key), "start", "length", "ids_crc32", "doc_tokens", (F.col("first") + F.col("local")).alias("sequence_id"), "offset")
