"""Canonical length-limited Huffman codes over token ids, coded and decoded with whole arrays."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

import numpy as np

MAX_BITS = 20
BLOCK = 1024
# Blocks decoded side by side.
LANES = 2048


def code_lengths(counts: np.ndarray, limit: int = MAX_BITS) -> np.ndarray:
    """Best code lengths of at most ``limit`` bits for symbols with these counts, by package-merge; 0 where the count is 0.

    On each level the packages of the level before are merged with the symbols by weight. Going back from the last level,
    the items taken are a run of smallest ones, so the symbols among them are the lightest: their lengths grow by one.
    """
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), np.int64)
    if len(used) <= 1:
        lengths[used] = 1
        return lengths
    if len(used) > 1 << limit:
        raise ValueError(f"{len(used)} symbols do not fit codes of {limit} bits")
    used = used[np.argsort(counts[used], kind="stable")]
    weights = counts[used].astype(np.int64)
    levels, packages = [], np.zeros(0, np.int64)
    for _ in range(limit):
        merged = np.concatenate([weights, packages])
        order = np.argsort(merged, kind="stable")
        levels.append(np.cumsum(order < len(weights)))
        ranked = merged[order]
        packages = ranked[0:len(ranked) // 2 * 2:2] + ranked[1::2]
    take = 2 * len(used) - 2
    for symbols in reversed(levels):
        if not take:
            break
        light = int(symbols[take - 1])
        lengths[used[:light]] += 1
        take = 2 * (take - light)
    return lengths


@dataclass(frozen=True)
class Codebook:
    """A canonical code: its lengths say everything. Codes of a length ascend with the symbol, longer ones follow."""

    lengths: np.ndarray

    @cached_property
    def max_bits(self) -> int:
        return int(self.lengths.max(initial=0))

    @cached_property
    def ordered(self) -> np.ndarray:
        used = np.flatnonzero(self.lengths)
        return used[np.argsort(self.lengths[used], kind="stable")]

    @cached_property
    def codes(self) -> np.ndarray:
        """The code of each symbol, in the upper bits of 64."""
        share = np.uint64(1) << (np.uint64(64) - self.lengths[self.ordered].astype(np.uint64))
        out = np.zeros(len(self.lengths), np.uint64)
        out[self.ordered] = np.cumsum(share) - share
        return out

    @cached_property
    def table(self) -> np.ndarray:
        """For each value of the next ``max_bits`` bits, the symbol that starts there, times 32, plus its length."""
        sizes = self.lengths[self.ordered]
        rows = np.repeat(self.ordered * 32 + sizes, 1 << (self.max_bits - sizes))
        return np.concatenate([rows, np.zeros((1 << self.max_bits) - len(rows), np.int64)]).astype(np.int32)

    def encode(self, ids: np.ndarray, sizes: np.ndarray) -> tuple[list[bytes], np.ndarray]:
        """The bits of each document as whole bytes, and the bit offsets in its document at which blocks of ``BLOCK``
        ids start. ``ids`` are those of all documents, ``sizes`` (none zero) how many each has."""
        bits = self.lengths[ids]
        if not bits.all():
            raise ValueError("an id without a code")
        ends = np.cumsum(bits)
        first = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        used = np.add.reduceat(bits, first)
        octets = (used + 7) >> 3
        base = np.cumsum(octets) - octets
        doc = np.repeat(np.arange(len(sizes)), sizes)
        place = ends - bits - (ends - bits)[first][doc] + 8 * base[doc]
        word, shift = place >> 6, (place & 63).astype(np.uint64)
        code = self.codes[ids]
        # bits of codes never overlap, so adding them up sets them; no code reaches past the second word it touches
        out = np.zeros(int(word[-1]) + 2, np.uint64)
        starts = np.flatnonzero(np.diff(word, prepend=-1))
        out[word[starts]] = np.add.reduceat(code >> shift, starts)
        over = np.flatnonzero((shift.astype(np.int64) + bits) > 64)
        out[word[over] + 1] += code[over] << (np.uint64(64) - shift[over])
        raw = out.astype(">u8").tobytes()
        payloads = [raw[b:b + n] for b, n in zip(base.tolist(), octets.tolist(), strict=True)]
        inside = np.arange(len(ids)) - first[doc]
        return payloads, (place - 8 * base[doc])[inside % BLOCK == 0]

    def decode(self, raw: bytes, offsets: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The ids of blocks that start at these bits of ``raw`` and hold so many ids each, one block after another.

        Blocks are independent, so one step reads the next id of every block that has more: a window of bits and a table.
        """
        data = np.frombuffer(raw + b"\0" * 4, np.uint8).astype(np.uint32)
        window = data[:-3] << 24 | data[1:-2] << 16 | data[2:-1] << 8 | data[3:]
        out = np.zeros(int(sizes.sum()), np.uint32)
        target = np.cumsum(sizes) - sizes
        drop, table = np.uint32(32 - self.max_bits), self.table
        ranked = np.argsort(-sizes, kind="stable")
        for k in range(0, len(ranked), LANES):
            lanes = ranked[k:k + LANES]
            place, left = offsets[lanes].astype(np.int64), sizes[lanes]
            steps = np.zeros((int(left[0]), len(lanes)), np.uint32)
            active = len(lanes)
            for step in range(len(steps)):
                while left[active - 1] <= step:
                    active -= 1
                at = place[:active]
                entry = table[window[at >> 3] << (at & 7).astype(np.uint32) >> drop]
                steps[step, :active] = entry >> 5
                at += entry & 31
            for lane, n, row in zip(lanes.tolist(), left.tolist(), np.ascontiguousarray(steps.T), strict=True):
                out[target[lane]:target[lane] + n] = row[:n]
        return out
