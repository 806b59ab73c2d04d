"""Quality rules on repetition: how much of a text lies inside repeated word n-grams and lines."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnkit.llm.common import keep_rows, map_batches, text_of

BASE_GRAM = 5
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class RepetitionRules:
    """Limits in percent. Coverage counts every copy of what repeats, the first included, so a limit is about twice what a
    rule on the later copies alone would have."""

    min_words: int = 10
    max_repeat_words: int = 20
    max_covered: dict[int, int] = field(default_factory=lambda: {5: 30, 6: 28, 7: 26, 8: 24, 9: 22, 10: 20})
    max_line_chars: int = 40


DEFAULT = RepetitionRules()


def _mixed(ids: np.ndarray) -> np.ndarray:
    """A 64-bit value for each word number (the splitmix64 finaliser)."""
    z = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def _repeated(hashes: np.ndarray, ids: np.ndarray, n: int) -> np.ndarray:
    """Which windows of ``n`` words occur at least twice. Equal hashes are checked word by word."""
    order = np.argsort(hashes, kind="stable")
    ranked = hashes[order]
    same = np.flatnonzero(ranked[1:] == ranked[:-1])
    out = np.zeros(len(hashes), bool)
    if not len(same):
        return out
    left, right = order[same], order[same + 1]
    if all((ids[left + k] == ids[right + k]).all() for k in range(n)):
        out[left] = out[right] = True
        return out
    # different windows with one hash: compare the windows themselves
    windows = np.lib.stride_tricks.sliding_window_view(ids, n)
    _, where, counts = np.unique(windows, axis=0, return_inverse=True, return_counts=True)
    return counts[where.ravel()] > 1


def covered(ids: np.ndarray, lengths: list[int]) -> dict[int, np.ndarray]:
    """For each length, which words lie in a window of so many words that occurs at least twice. The hash of a window
    grows from that of the window one shorter, so all lengths cost one pass each."""
    total, weights = len(ids), _mixed(ids)
    out = {}
    hashes, n = weights, 1
    for want in sorted(lengths):
        if want > total:
            out[want] = np.zeros(total, bool)
            continue
        while n < want:
            hashes = hashes[:-1] * _FACTOR + weights[n:]
            n += 1
        starts = np.flatnonzero(_repeated(hashes, ids, n))
        edges = np.zeros(total + 1, np.int64)
        np.add.at(edges, starts, 1)
        np.add.at(edges, starts + n, -1)
        out[want] = np.cumsum(edges[:-1]) > 0
    return out


def measure(text: str, rules: RepetitionRules = DEFAULT) -> dict:
    """All figures of one text and the verdict on it."""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    if raw.isascii():
        sizes = np.fromiter(map(len, number), np.int64, len(number))
    else:
        sizes = np.fromiter((len(w.decode("utf-8", "surrogatepass")) for w in number), np.int64, len(number))
    chars = sizes[ids]
    word_chars = int(chars.sum())
    marks = covered(ids, [BASE_GRAM, *rules.max_covered])
    lines: dict[bytes, int] = {}
    for line in raw.split(b"\n"):
        lines[line] = lines.get(line, 0) + 1
    repeats = {line: n for line, n in lines.items() if n > 1 and line.split()}
    line_chars = sum(n * sum(len(w.decode("utf-8", "surrogatepass")) for w in line.split()) for line, n in repeats.items())
    out = {"n_words": len(words), "word_chars": word_chars, "n_symbols": sum(map(text.count, "#*$%&|<>")),
           "n_dup_lines": sum(repeats.values()) - len(repeats), "n_repeat_words": int(marks[BASE_GRAM].sum())}
    out["base_failed"] = len(words) < rules.min_words or 100 * out["n_repeat_words"] > rules.max_repeat_words * len(words)
    spans = {n: int(chars[marks[n]].sum()) for n in rules.max_covered}
    over = (any(100 * spans[n] > most * word_chars for n, most in rules.max_covered.items())
            or 100 * line_chars > rules.max_line_chars * word_chars)
    out |= {f"covered_{n}": v for n, v in spans.items()} | {"line_chars": line_chars}
    out["kept"] = not (out["base_failed"] or over)
    return out


def repetition_quality(docs: DataFrame, key: str = "doc_id", text: str = "text",
                       rules: RepetitionRules = DEFAULT) -> DataFrame:
    """One row per document: counts, characters inside repeated n-grams and lines, and whether it is kept.

    Words are runs of anything but ASCII white space. n_repeat_words counts words in five-word windows that occur at least
    twice; covered_N the characters (code points) of words inside repeated windows of N words; line_chars those in lines
    that occur at least twice; every copy counts. A document is kept if the base rules pass and no coverage exceeds its
    limit. A null or empty text has no words and fails on their number. Null or repeated keys pass through, a row each; an
    empty table gives none; other columns are not read. The work is a map over texts: nothing is shuffled.
    """
    kind = docs.schema[key].dataType.simpleString()
    longs = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    spans = [*(f"covered_{n}" for n in rules.max_covered), "line_chars"]
    names = [*longs, "base_failed", "kept", *spans]
    schema = ", ".join([f"key {kind}", *(f"{n} long" for n in longs), "base_failed boolean", "kept boolean",
                        *(f"{n} long" for n in spans)])

    def run(batches):
        for b in batches:
            rows = [measure(t, rules) for t in b["text"]]
            yield {"key": b["key"]} | {n: [r[n] for r in rows] for n in names}

    return map_batches(docs.select(F.col(key).alias("key"), text_of(text).alias("text")), run, schema).withColumnRenamed("key", key)


def keep_quality(docs: DataFrame, text: str = "text", rules: RepetitionRules = DEFAULT) -> DataFrame:
    """The rows of ``docs`` whose text is kept, all columns as they are."""
    return keep_rows(docs, text, lambda texts: [measure(t or "", rules)["kept"] for t in texts])
