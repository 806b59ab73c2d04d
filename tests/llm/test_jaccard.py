"""The stage's groups against every pair of texts compared."""

import random

import numpy as np
import pyarrow as pa
from churnkit.llm import jaccard as J
from churnkit.llm.simhash import fingerprint
from pyspark.sql import functions as F


def plain_set(text):
    words = (text or "").lower().split()
    return {" ".join(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def plain_links(sets):
    """Pairs of similarity 0.8 or more, by shingles that both have."""
    where, links = {}, []
    for i, s in enumerate(sets):
        shared = {}
        for g in s:
            for j in where.setdefault(g, []):
                shared[j] = shared.get(j, 0) + 1
            where[g].append(i)
        links += [(j, i) for j, n in shared.items() if 5 * n >= 4 * (len(s) + len(sets[j]) - n)]
    return links


def plain_stay(rows):
    """Keys that stay of (key, text), keys all different."""
    label = {k: k for k, _ in rows}

    def top(x):
        while label[x] != x:
            x = label[x]
        return x

    for a, b in plain_links([plain_set(t) for _, t in rows]):
        x, y = sorted((top(rows[a][0]), top(rows[b][0])))
        label[y] = x
    return {k for k in label if label[k] == k}


def test_given_near_copies(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where(F.trim("text") != "")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = {r.doc_id for r in J.drop_duplicates(docs).collect()}
    assert got == plain_stay(rows)
    assert len(got) < len({t for _, t in rows})


def test_large_group_and_rows(spark):
    rng = random.Random(4)
    base = [rng.choice("abcdefghijklmnopqrstuvwxyz") * rng.randint(1, 5) for _ in range(300)]
    rows = []
    for i in range(200):  # one group of near copies, more than are compared in pairs
        words = list(base)
        for _ in range(3):
            words[rng.randrange(300)] = f"w{rng.random()}"
        rows.append((i + 10, " ".join(words)))
    rows += [(300 + i, " ".join(f"u{rng.random()}" for _ in range(20))) for i in range(50)]
    far = rows[-1][1].split()
    rows += [(400, " ".join([*far[:10], "x", *far[11:]])), (401, "One two"), (402, "one  two"), (403, "one three")]
    df = spark.createDataFrame([*rows, (None, "one two"), (11, rows[1][1])], "doc_id long, text string")
    got = [r.doc_id for r in J.drop_duplicates(df).collect()]
    assert sorted(k for k in got if k is not None) == sorted(plain_stay(rows)) and got.count(None) == 1
    assert {10, 400, 401, 403} <= set(got) and not {11, 402} & set(got)
    assert J.drop_duplicates(df.limit(0)).count() == 0


def test_clashing_column_names(spark):
    df = spark.createDataFrame([(1, "a b c d e f", 5, 6), (1, "a b c d e f", 5, 6), (2, "A B C D E F", 7, 8)], "doc_id long, text string, _row int, _ROW_ int")
    got = J.drop_duplicates(df)
    assert got.columns == df.columns and [tuple(r) for r in got.collect()] == [(1, "a b c d e f", 5, 6)]


def test_index_joins_without_bands(spark, monkeypatch):
    # bands that no two texts share: what is joined is joined by the SimHash index
    monkeypatch.setattr(J, "bands", lambda grams: grams[:1].repeat(24).view("int64") + np.arange(24) + len(grams) * 1000)
    rng = random.Random(11)
    rows = []
    for i in range(20):
        text = " ".join(f"{rng.choice('abcdefgh')}{rng.randrange(10 ** 6)}" for _ in range(80))
        own = fingerprint(text, 5)
        # the first beginning and ending that leave the fingerprint within two bits, a new least shingle or not
        near = next(t for t in (f"s{k} {text} e{k}" for k in range(10000)) if ((own ^ fingerprint(t, 5)) & (1 << 64) - 1).bit_count() <= 2)
        rows += [(2 * i, text), (2 * i + 1, near)]
    rows += [(100, " ".join(["x"] * 30)), (101, " ".join(["x"] * 40))]  # one set of shingles, one fingerprint
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(r.doc_id for r in J.drop_duplicates(df).collect()) == sorted(plain_stay(rows)) == [*range(0, 40, 2), 100]


def alike(rng, count, pairs, copies=0, start=0):
    """Texts of one template that are not similar themselves, so that their buckets are large, and pairs of them that are, if
    only just; ``copies`` near copies of one of them."""
    base = [f"b{rng.random()}" for _ in range(170)]
    texts = [[f"u{rng.random()}" for _ in range(30)] for _ in range(count)]
    for i in range(pairs):
        texts[2 * i + 1][:9] = texts[2 * i][:9]
    for _ in range(copies):
        texts.append([*texts[-1][:-1], f"u{rng.random()}"])
    order = rng.sample(range(len(texts)), len(texts))
    return [(start + k, " ".join([*base, *texts[i]])) for k, i in enumerate(order)]


def test_pairs_in_large_buckets(spark):
    rng = random.Random(21)
    rows = alike(rng, 160, 70)
    links = plain_links([plain_set(t) for _, t in rows])
    assert len(links) == 70
    got = sorted(r.doc_id for r in J.drop_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == sorted(plain_stay(rows)) and len(got) == 90


def test_blocks_of_large_buckets(spark, monkeypatch):
    # blocks of 20 texts, some under the most frequent label, and of few characters; texts of other lengths, so marks of two lengths
    rng = random.Random(22)
    rows = alike(rng, 100, 40, 60) + alike(rng, 60, 30, start=500)
    rows += [(1000 + k, t + " " + " ".join(t.split()[:40])) for k, t in rows[:30]] + [(2000 + k, " ".join([t, *(f"v{rng.random()}" for _ in range(70))])) for k, t in rows[:20]]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = sorted(plain_stay(rows))
    for block, chars in ((20, 1 << 23), (1024, 30000)):
        monkeypatch.setattr(J, "BLOCK", block)
        monkeypatch.setattr(J, "BLOCK_CHARS", chars)
        assert sorted(r.doc_id for r in J.drop_duplicates(df).collect()) == want


def test_marks_bound_what_differs():
    rng = np.random.default_rng(3)
    for n in (0, 1, 5, 100, 129, 260, 3000):
        a = np.unique(rng.integers(0, 1 << 63, n, np.uint64))
        for share in (0.5, 0.8, 0.95, 1.0):
            b = np.unique(np.concatenate([a[:int(share * len(a))], rng.integers(0, 1 << 63, n // 4, np.uint64)]))
            x, y = (np.frombuffer(J.marks(s), np.uint64) for s in (a, b))
            while len(x) != len(y):
                x, y = (m if len(m) == min(len(x), len(y)) else m[:len(m) // 2] ^ m[len(m) // 2:] for m in (x, y))
            assert np.bitwise_count(x ^ y).sum() <= len(np.setxor1d(a, b))
            if J.similar(a, b):
                assert 9 * len(np.setxor1d(a, b)) <= len(a) + len(b)


def test_cells_against_all_pairs():
    rng = np.random.default_rng(9)

    def cell(sets, block, j):
        n = len(sets)
        return pa.table({"band": [0] * n, "value": [0] * n, "i": [0] * n, "j": [j] * n, "block": block, "cls": list(range(n)), "label": [k // 2 if k < 20 else k for k in range(n)],
                         "size": [len(s) for s in sets], "marks": [J.marks(s) for s in sets], "grams": [s.tobytes() for s in sets]})

    base = rng.integers(0, 1 << 63, 900, np.uint64)
    for least, most, j in ((1, 30, 0), (100, 160, 1), (100, 160, 0), (300, 900, 1), (0, 1, 0)):
        sets = []
        for _ in range(120):
            n = rng.integers(least, most)
            sets.append(np.unique(np.concatenate([base[:n * 17 // 20], rng.choice(base, n // 12), rng.integers(0, 1 << 63, n // 20, np.uint64)])))
        block = [int(k) for k in rng.integers(0, j + 1, len(sets))]
        full = cell(sets, block, j)
        label = full["label"].to_pylist()
        links = [(x, y) for x in range(len(sets)) for y in range(x) if block[x] + block[y] == j and label[x] != label[y] and J.similar(sets[x], sets[y])]
        assert links
        close = set(J._close(full)["cls"].to_pylist())
        assert {k for ends in links for k in ends} <= close
        found = J._joined(full.take(sorted(close))).to_pylist()
        assert len(found) < len(sets)

        def groups(pairs):
            top = {k: k for k in label}
            for a, b in pairs:
                top = {k: top[a] if t == top[b] else t for k, t in top.items()}
            return {frozenset(k for k in top if top[k] == t) for t in top.values()}

        assert groups((label[x], label[y]) for x, y in links) == groups((r["a"], r["b"]) for r in found)
    far = [np.sort(rng.integers(0, 1 << 63, 200, np.uint64)) for _ in range(40)]
    assert J._close(cell(far, [0] * 40, 0)).num_rows == 0 == J._joined(cell(far, [0] * 40, 0)).num_rows
