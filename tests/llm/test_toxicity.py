"""Gradients against differences, windows against a plain network, and what is learned against labels kept back."""

import random
import zlib

import numpy as np
from churnkit.llm import gru as G
from churnkit.llm import toxicity as T

BAD = ["zorg", "blarx", "quump"]


def corpus(n, seed):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 6))) for _ in range(300)]
    rows = []
    for i in range(n):
        text = [rng.choice(words) for _ in range(rng.randint(1, 150))]
        bad = int(rng.random() < 0.3)
        for _ in range(rng.randint(1, 4) if bad else 0):
            text.insert(rng.randint(0, len(text)), rng.choice(BAD) + rng.choice(["", "", "."]))
        rows.append((i, " ".join(text), bad))
    return rows


def plain_logit(model, words):
    """One window by the equations, a word at a time."""
    w, h = model.weights, G.HIDDEN
    sig = lambda x: 1 / (1 + np.exp(-x))
    x = model.inputs(*G.word_inputs(words)).astype(float) @ w["input"] + w["bias"]

    def states(order, gates, recur):
        state, out = np.zeros(h), {}
        for t in order:
            side = state @ recur
            z, r = sig(gates[t][:h] + side[:h]), sig(gates[t][h:2 * h] + side[h:2 * h])
            n = np.tanh(gates[t][2 * h:] + r * side[2 * h:])
            state = (1 - z) * n + z * state
            out[t] = state
        return out

    f = states(range(len(words)), x[:, :3 * h], w["forth"])
    b = states(range(len(words) - 1, -1, -1), x[:, 3 * h:], w["back"])
    s = np.array([np.concatenate([f[t], b[t]]) for t in range(len(words))])
    e = np.exp(np.tanh(s @ w["look"]) @ w["weigh"])
    return (e / e.sum()) @ s @ w["out"] + w["offset"][0]


def test_all_windows_enter_the_score():
    model = G.Model.fresh(1)
    rng = random.Random(0)
    texts = ["", "one", *(" ".join(rng.choice(["ab", "Cé", "xyz.", "ünd"]) for _ in range(n)) for n in (31, 32, 33, 48, 49, 200, 3000))]
    got = model.scorer().scores(texts)
    for text, score in zip(texts, got, strict=True):
        words = G.words_of(text)
        starts, at = [0], 0
        while at + G.WINDOW < len(words):
            at += G.STRIDE
            starts.append(at)
        assert G.window_starts(len(words)).tolist() == starts
        logits = np.array([plain_logit(model, words[s:s + G.WINDOW]) for s in starts])
        weight = np.exp(G.SHARPNESS * (logits - logits.max()))
        want = (weight * logits).sum() / weight.sum()
        assert np.isclose(score, 1 / (1 + np.exp(-want)), atol=1e-4)


def test_gradients_equal_differences():
    model = G.Model.fresh(2)
    w = {k: v.astype(np.float64) for k, v in model.weights.items()}
    model.weights = w
    rng = np.random.default_rng(0)
    table = rng.standard_normal((20, 6 * G.HIDDEN))
    ids = rng.integers(0, 20, (5, 7))
    mask = np.arange(7) < np.array([7, 1, 4, 7, 2])[:, None]
    aim = rng.standard_normal(5)
    loss = lambda: float(model.windows(table, ids, mask)[0] @ aim)
    _, cache = model.windows(table, ids, mask, keep=True)
    grad, dtable = model.gradients(ids, mask, cache, aim, 20)
    for name, g in [*grad.items(), ("table", dtable)]:
        target = table if name == "table" else w[name]
        for _ in range(6):
            at = tuple(rng.integers(0, n) for n in target.shape)
            old = target[at]
            target[at] = old + 1e-2
            up = loss()
            target[at] = old - 1e-2
            down = loss()
            target[at] = old
            assert np.isclose(g[at], (up - down) / 2e-2, rtol=2e-2, atol=2e-4), name


def test_learns_and_leaves_held_out_labels_alone(spark):
    rows = corpus(700, 1)
    docs = spark.createDataFrame([(i, t, "en", 0.5) for i, t, _ in rows] + [(None, None, "en", 0.1), (900, "", "x", 0.0), (900, None, "x", 0.0)],
                                 "doc_id long, text string, lang string, score double")
    # a label of a held-out row that is wrong changes nothing
    labels = [(i, y) for i, _, y in rows]
    wrong = [(i, 1 - y if zlib.crc32(str(i).encode()) % 5 == 0 else y) for i, y in labels]
    frames = [spark.createDataFrame(x + [(None, 1), (5, None)], "doc_id long, toxic int") for x in (labels, wrong)]
    model, same = (T.fit(docs, f) for f in frames)
    assert all((model.weights[k] == same.weights[k]).all() for k in model.weights)
    got = T.score(docs, model).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got if r.doc_id is not None)
    truth = dict(labels)
    held = [(truth[r.doc_id], r.predicted) for r in got if r.doc_id in truth and r.held_out]
    assert len(held) > 100 and sum(a == b for a, b in held) / len(held) > 0.95
    kept = T.drop_toxic(docs, model)
    assert kept.schema == docs.schema
    assert kept.count() == sum(r.predicted == 0 for r in got)


def test_without_labels_or_rows(spark):
    docs = spark.createDataFrame([(1, "a"), (2, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert [r.score for r in T.score(docs, T.fit(docs, none)).collect()] == [0.0, 0.0]
    clean = spark.createDataFrame([(1, 0), (2, 0)], "doc_id long, toxic int")
    assert {r.predicted for r in T.score(docs, T.fit(docs, clean)).collect()} == {0}
    assert T.score(docs.limit(0), G.Model.fresh(0)).count() == 0
