"""A bidirectional gated recurrent network with attention pooling over windows of words, in numpy."""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np

WINDOW, STRIDE = 32, 16
WORD_ROWS, GRAM_ROWS = 1 << 14, 1 << 15
WIDTH, HIDDEN = 12, 16
GRAMS = (3, 5, 7)
TABLES = ("word", "gram", "word_lean", "gram_lean")
# How sharply a document follows its highest windows (0: their mean, large: their maximum).
SHARPNESS = 1.0
# Distinct words whose inputs a process keeps; when full, it starts anew.
_CACHE_WORDS = 150_000
_STRIP = b".,;:!?\"'()[]|*"


def words_of(text: str) -> list[bytes]:
    """Words as UTF-8, ASCII letters in lower case; a text without any has the empty word."""
    return text.encode("utf-8", "surrogatepass").lower().split() or [b""]


def word_inputs(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row of each word, rows of all character n-grams, where each word's n-grams start). Words are stripped of
    punctuation; n-grams of bytes include the word's ends, and every word has at least one."""
    bare = [w.strip(_STRIP) for w in words]
    rows = np.fromiter((zlib.crc32(w) % WORD_ROWS for w in bare), np.int64, len(bare))
    raw = np.frombuffer(b"".join(b"\x02" + w + b"\x03" for w in bare), np.uint8).astype(np.uint64)
    sizes = np.fromiter((len(w) + 2 for w in bare), np.int64, len(bare))
    starts = np.cumsum(sizes) - sizes
    word = np.repeat(np.arange(len(bare)), sizes)
    left = sizes[word] - (np.arange(len(raw)) - starts[word])  # characters from here to the word's end
    found, of = [], []
    code = raw.copy()
    n = 1
    for want in (2, *GRAMS):
        while n < want:
            code = code[:-1] * np.uint64(0x100000001B3) ^ raw[n:]
            n += 1
        inside = np.flatnonzero(left[:len(code)] >= n) if want != 2 else np.flatnonzero(sizes[word[:len(code)]] == 2)
        if want == 2:  # the empty word has no longer n-gram
            inside = inside[left[inside] == 2]
        mixed = (code[inside] + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - 15)
        found.append(mixed.astype(np.int64) % GRAM_ROWS)
        of.append(word[inside])
    grams, of = np.concatenate(found), np.concatenate(of)
    order = np.argsort(of, kind="stable")
    return rows, grams[order], np.searchsorted(of[order], np.arange(len(bare)))


def window_starts(n: int) -> np.ndarray:
    """Starts of overlapping windows that cover ``n`` words."""
    return np.arange(0, max(1, n - (WINDOW - STRIDE)), STRIDE) if n > WINDOW else np.zeros(1, np.int64)


def _sigmoid(x):
    return 0.5 * np.tanh(0.5 * x) + 0.5


@dataclass
class Model:
    """Weights by name. ``rate`` is the score where nothing could be learned."""

    weights: dict[str, np.ndarray] | None
    rate: float = 0.0

    def __getstate__(self):
        return {"weights": self.weights, "rate": self.rate}

    def __setstate__(self, state):
        self.__dict__.update(state)

    @staticmethod
    def fresh(seed: int) -> Model:
        rng = np.random.default_rng(seed)
        draw = lambda *shape, scale: (rng.standard_normal(shape) * scale).astype(np.float32)
        h, d = HIDDEN, 2 * WIDTH + 2
        return Model({"word_lean": np.zeros(WORD_ROWS, np.float32), "gram_lean": np.zeros(GRAM_ROWS, np.float32), "word": draw(WORD_ROWS, WIDTH, scale=0.1), "gram": draw(GRAM_ROWS, WIDTH, scale=0.3),
                      "input": draw(d, 6 * h, scale=d ** -0.5), "bias": np.zeros(6 * h, np.float32),
                      "forth": draw(h, 3 * h, scale=h ** -0.5), "back": draw(h, 3 * h, scale=h ** -0.5),
                      "look": draw(2 * h, h, scale=(2 * h) ** -0.5), "weigh": draw(h, scale=h ** -0.5),
                      "out": draw(2 * h, scale=(2 * h) ** -0.5), "offset": np.zeros(1, np.float32)})

    def inputs(self, rows: np.ndarray, grams: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """The input of each word of ``word_inputs``: its own vector, the mean of those of its n-grams, and how far it and
        the most telling of its n-grams lean to one class."""
        w = self.weights
        counts = np.diff(np.append(starts, len(grams)))
        mean = np.add.reduceat(w["gram"][grams], starts, axis=0) / counts[:, None].astype(np.float32)
        lean = np.stack([w["word_lean"][rows], np.maximum.reduceat(w["gram_lean"][grams], starts)], axis=1)
        return np.concatenate([w["word"][rows], mean, lean], axis=1)

    def _pass(self, gates: np.ndarray, mask: np.ndarray, recur: np.ndarray, backward: bool, keep: bool):
        """States at all steps of one direction; with ``keep``, what the way back needs too."""
        h = HIDDEN
        state = np.zeros((len(mask), h), np.float32)
        states = np.zeros((mask.shape[1], len(mask), h), np.float32)
        kept = {}
        for t in range(mask.shape[1] - 1, -1, -1) if backward else range(mask.shape[1]):
            x = gates[t]
            side = state @ recur
            zr = _sigmoid(x[:, :2 * h] + side[:, :2 * h])
            z, r = zr[:, :h], zr[:, h:]
            n = np.tanh(x[:, 2 * h:] + r * side[:, 2 * h:])
            new = n + z * (state - n)
            if keep:
                kept[t] = (state, z, r, n, side[:, 2 * h:])
            on = mask[:, t, None]
            state = new if on.all() else np.where(on, new, state)
            states[t] = state
        return states, kept

    def windows(self, table: np.ndarray, ids: np.ndarray, mask: np.ndarray, keep: bool = False):
        """The logit of each window of word numbers ``ids``, rows of ``table`` (gate inputs of both directions)."""
        w, h = self.weights, HIDDEN
        gates = table[ids.T]
        forth, a = self._pass(gates[:, :, :3 * h], mask, w["forth"], False, keep)
        back, b = self._pass(gates[:, :, 3 * h:], mask, w["back"], True, keep)
        states = np.concatenate([forth, back], axis=2)
        looked = np.tanh(states @ w["look"])
        score = np.where(mask.T, looked @ w["weigh"], -np.float32(1e9))
        share = np.exp(score - score.max(0))
        share /= share.sum(0)
        pooled = (share[:, :, None] * states).sum(0)
        logit = pooled @ w["out"] + w["offset"][0]
        return logit, (states, looked, share, pooled, a, b)

    def gradients(self, ids, mask, cache, dlogit: np.ndarray, n_words: int) -> tuple[dict, np.ndarray]:
        """Gradients of the weights above the inputs, and of the gate inputs of each word."""
        w, h = self.weights, HIDDEN
        states, looked, share, pooled, a, b = cache
        g = {"out": pooled.T @ dlogit, "offset": dlogit.sum(keepdims=True)}
        dpool = dlogit[:, None] * w["out"]
        dstates = share[:, :, None] * dpool
        dshare = (states * dpool).sum(2)
        dscore = share * (dshare - (share * dshare).sum(0))
        g["weigh"] = looked.reshape(-1, h).T @ dscore.ravel()
        dlook = dscore[:, :, None] * w["weigh"] * (1 - looked ** 2)
        g["look"] = states.reshape(-1, 2 * h).T @ dlook.reshape(-1, h)
        dstates = dstates + dlook @ w["look"].T
        dgates = np.zeros((mask.shape[1], len(mask), 6 * h), np.float32)
        for name, kept, part, gate, backward in (("forth", a, slice(0, h), slice(0, 3 * h), False),
                                                 ("back", b, slice(h, 2 * h), slice(3 * h, 6 * h), True)):
            recur, carry = w[name], np.zeros((len(mask), h), np.float32)
            total = np.zeros_like(recur)
            for t in range(mask.shape[1]) if backward else range(mask.shape[1] - 1, -1, -1):
                state, z, r, n, side = kept[t]
                on = mask[:, t, None]
                d = carry + dstates[t, :, part]
                dn = d * (1 - z) * (1 - n ** 2)
                dz = d * (state - n) * z * (1 - z)
                dr = dn * side * r * (1 - r)
                dside = np.concatenate([dz, dr, dn * r], axis=1) * on
                total += state.T @ dside
                dgates[t, :, gate] = np.concatenate([dz, dr, dn], axis=1) * on
                carry = np.where(on, d * z + dside @ recur.T, d)
            g[name] = total
        flat = ids.T.ravel()
        order = np.argsort(flat, kind="stable")
        seen, first = np.unique(flat[order], return_index=True)
        dtable = np.zeros((n_words, 6 * h), np.float32)
        dtable[seen] = np.add.reduceat(dgates.reshape(-1, 6 * h)[order], first, axis=0)
        return g, dtable

    def scorer(self):
        return _Scorer(self)


def pooled_logit(logits: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A document's logit: the mean of its windows' logits, each weighted by the exponential of its own. Also the weights."""
    top = np.maximum.reduceat(logits, starts)
    doc = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(logits))))
    weight = np.exp(np.minimum(0, SHARPNESS * (logits - top[doc])))
    weight /= np.add.reduceat(weight, starts)[doc]
    return np.add.reduceat(weight * logits, starts), weight


class _Scorer:
    """Scores texts; gate inputs of words seen are kept from batch to batch."""

    def __init__(self, model: Model):
        self.model = model
        self._reset()

    def _reset(self) -> None:
        self.number: dict[bytes, int] = {}
        self.table = np.zeros((0, 6 * HIDDEN), np.float32)

    def _ids(self, docs: list[list[bytes]]) -> list[np.ndarray]:
        new = list(set().union(*docs).difference(self.number))
        if len(self.number) + len(new) > _CACHE_WORDS:
            self._reset()
            new = list(set().union(*docs))
        w = self.model.weights
        self.number.update(zip(new, range(len(self.number), len(self.number) + len(new)), strict=True))
        parts = [self.table]
        for at in range(0, len(new), 20_000):
            parts.append(self.model.inputs(*word_inputs(new[at:at + 20_000])) @ w["input"] + w["bias"])
        self.table = np.concatenate(parts)
        look = self.number.__getitem__
        return [np.fromiter(map(look, d), np.int32, len(d)) for d in docs]

    def scores(self, texts: list[str]) -> np.ndarray:
        """Score of each text from all of its windows. Long lists go through in parts, long texts too."""
        if self.model.weights is None:
            return np.full(len(texts), self.model.rate)
        out = []
        for at in range(0, len(texts), 128):
            ids = self._ids([words_of(t) for t in texts[at:at + 128]])
            logits, sizes = [], []
            held: list[tuple[np.ndarray, np.ndarray]] = []
            for doc in ids:
                starts = window_starts(len(doc))
                sizes.append(len(starts))
                for k in range(0, len(starts), 512):
                    held.append(windows_of(doc, starts[k:k + 512]))
                    if sum(len(m) for m, _ in held) >= 512:
                        logits.append(self._logits(held))
                        held = []
            if held:
                logits.append(self._logits(held))
            firsts = np.cumsum([0, *sizes[:-1]])
            out.append(_sigmoid(pooled_logit(np.concatenate(logits).astype(np.float64), firsts)[0]))
        return np.concatenate(out) if out else np.zeros(0)

    def _logits(self, held) -> np.ndarray:
        ids, mask = (np.concatenate(x) for x in zip(*held, strict=True))
        return self.model.windows(self.table, ids, mask)[0]


def windows_of(doc: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(word numbers, which are there) of the windows of a document."""
    place = starts[:, None] + np.arange(WINDOW)
    mask = place < len(doc)
    return np.where(mask, doc[np.minimum(place, len(doc) - 1)], 0), mask


def _inputs_in_parts(words: list[bytes], part: int = 20_000) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``word_inputs`` of many words, a part at a time, so that what is needed in between stays small."""
    rows, grams, starts, at = [], [], [], 0
    for k in range(0, len(words), part):
        r, g, s = word_inputs(words[k:k + part])
        rows.append(r.astype(np.int32))
        grams.append(g.astype(np.int32))
        starts.append(s + at)
        at += len(g)
    return np.concatenate(rows), np.concatenate(grams), np.concatenate(starts)


def _telling(doc: np.ndarray, lean: np.ndarray, most: int) -> np.ndarray:
    """Starts of the windows to learn from: those whose words lean most, and as many spread over the document."""
    starts = window_starts(len(doc))
    if len(starts) <= 2 * most:
        return starts
    ids, mask = windows_of(doc, starts)
    top = np.argsort(-np.where(mask, np.maximum(lean[ids], 0), 0).sum(1), kind="stable")[:most]
    return np.unique(np.concatenate([starts[top], starts[np.linspace(0, len(starts) - 1, most).astype(int)]]))


def train(texts: list[str], labels: list[int], base_rate: float | None = None, steps: int = 160, seed: int = 7,
          rate: float = 0.01, batch_windows: int = 448, telling: int = 3) -> Model:
    """Fit a model to document labels; only the document is labelled, so windows share the error as they share the score.

    First, counts say how far words and n-grams lean to a class. Then the network learns from the windows of each document
    that lean most and from some spread over it. Weights move by Adam, rows of the two tables by Adagrad. The result depends
    on the rows, their order and the seed alone; the number of steps does not depend on them. ``base_rate`` is the share of
    label 1 where texts to be scored come from, if not that of ``labels``: the final logit is moved by the difference. With
    one class, or none, the model says its rate.
    """
    positive = sum(labels)
    if not positive or positive == len(labels):
        return Model(None, positive / len(labels) if labels else 0.0)
    model = Model.fresh(seed)
    w = model.weights
    number: dict[bytes, int] = {}
    docs = [np.fromiter((number.setdefault(x, len(number)) for x in words_of(t)), np.int32) for t in texts]
    rows, grams, starts = _inputs_in_parts(list(number))
    counts = np.diff(np.append(starts, len(grams)))
    truths = np.array(labels, bool)
    w["word_lean"] = _lean([rows[np.unique(d)] for d in docs], truths, WORD_ROWS, 3.0)
    w["gram_lean"] = _lean([grams[np.concatenate([np.arange(starts[u], starts[u] + counts[u]) for u in np.unique(d)])] for d in docs],
                           truths, GRAM_ROWS, 5.0)
    lean = w["word_lean"][rows] + np.maximum.reduceat(w["gram_lean"][grams], starts)
    chosen = [windows_of(d, _telling(d, lean, telling)) for d in docs]
    rng = np.random.default_rng(seed)
    moment = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in w.items() if k not in TABLES}
    squares = {k: np.full(len(w[k]), 1e-6, np.float32) for k in ("word", "gram")}
    queue: list[int] = []
    for turn in range(1, steps + 1):
        picked, n = [], 0
        while n < batch_windows and len(picked) < len(docs):
            queue = queue or list(rng.permutation(len(docs)))
            picked.append(queue.pop())
            n += len(chosen[picked[-1]][0])
        parts = [chosen[i] for i in picked]
        ids, mask = (np.concatenate(x) for x in zip(*parts, strict=True))
        used, ids = np.unique(ids, return_inverse=True)
        ids = ids.reshape(mask.shape)
        spans = np.concatenate([np.arange(starts[u], starts[u] + counts[u]) for u in used])
        sizes = counts[used]
        own = np.cumsum(sizes) - sizes
        x = model.inputs(rows[used], grams[spans], own)
        logit, cache = model.windows(x @ w["input"] + w["bias"], ids, mask, keep=True)
        firsts = np.cumsum([0, *(len(m) for _, m in parts[:-1])])
        pooled, share = pooled_logit(logit, firsts)
        truth = np.array([labels[i] for i in picked])
        error = (_sigmoid(pooled) - truth) / len(picked)
        doc = np.repeat(np.arange(len(picked)), np.diff(np.append(firsts, len(logit))))
        dlogit = (error[doc] * share * (1 + SHARPNESS * (logit - pooled[doc]))).astype(np.float32)
        grad, dtable = model.gradients(ids, mask, cache, dlogit, len(used))
        grad["input"], grad["bias"] = x.T @ dtable, dtable.sum(0)
        dx = dtable @ w["input"].T
        step = rate * (1.05 - turn / steps)
        for k, g in grad.items():
            m, v = moment[k]
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            w[k] -= step * (m / (1 - 0.9 ** turn)) / (np.sqrt(v / (1 - 0.99 ** turn)) + 1e-8)
        _adagrad(w["word"], squares["word"], rows[used], dx[:, :WIDTH], 0.3 * step)
        each = np.repeat(dx[:, WIDTH:2 * WIDTH] / sizes[:, None].astype(np.float32), sizes, axis=0)
        _adagrad(w["gram"], squares["gram"], grams[spans], each, 0.3 * step)
    if base_rate is not None:
        share = positive / len(labels)
        w["offset"] += np.float32(np.log(base_rate / (1 - base_rate)) - np.log(share / (1 - share)))
    return model


def _lean(rows: list[np.ndarray], labels: np.ndarray, size: int, least: float) -> np.ndarray:
    """How many more positive documents a row of a table occurs in than its frequency lets expect, in about standard
    deviations: beyond ``least`` of them, halved and at most 3. What is rare is 0, so no document gives itself away."""
    seen, positive = np.zeros(size), np.zeros(size)
    for r, y in zip(rows, labels, strict=True):
        r = np.unique(r)
        seen[r] += 1
        positive[r] += y
    expected = seen * labels.mean()
    far = (positive - expected) / np.sqrt(expected + 1)
    return np.clip(np.sign(far) * np.maximum(np.abs(far) - least, 0) / 2, -3, 3).astype(np.float32)


def _adagrad(table, squares, rows, grad, step) -> None:
    order = np.argsort(rows, kind="stable")
    seen, first = np.unique(rows[order], return_index=True)
    g = np.add.reduceat(grad[order], first, axis=0)
    squares[seen] += (g * g).mean(1)
    table[seen] -= step * g / np.sqrt(squares[seen])[:, None]
