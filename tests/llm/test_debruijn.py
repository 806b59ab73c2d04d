"""Repeated passages against a look at every window of every pair of documents."""

import hashlib
import random

import pytest

from churnkit.llm import debruijn as DB
from churnkit.llm.queries import QUERIES


def brute(rows, window=50):
    """(key, n_words, n_removed, kept) of each (key, text) by the rule as it is written."""
    words = [(k, DB.split_words(t or "")) for k, t in rows]
    least = {}
    for k, w in words:
        for i in range(len(w) - window + 1) if k is not None else ():
            at = tuple(w[i:i + window])
            least[at] = min(least.get(at, k), k)
    out = []
    for k, w in words:
        gone = set()
        for i in range(len(w) - window + 1) if k is not None else ():
            if least[tuple(w[i:i + window])] < k:
                gone.update(range(i, i + window))
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((k, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def run(spark, rows, more=""):
    df = spark.createDataFrame(rows, f"doc_id long, text string{more}").repartition(5)
    got = DB.remove_repeats(df).collect()
    for r in got:
        assert (r.kept is None) == (r.n_removed == 0)
        assert r.kept is None or hashlib.sha256(r.kept.encode()).hexdigest() == r.kept_sha256
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got), key=repr)


@pytest.fixture(scope="module")
def corpus():
    pick = random.Random(5)
    word = lambda: "".join(pick.choice("abcdeé") for _ in range(pick.randint(1, 4)))
    passage = [[word() for _ in range(n)] for n in (49, 50, 51, 90, 200)]
    rows = []
    for i in range(60):
        text = [word() for _ in range(pick.randint(0, 120))]
        for p in pick.sample(passage, pick.randint(0, 3)):
            cut = pick.randint(0, 20)
            text += p[cut:] if pick.random() < 0.5 else p
            text += [word() for _ in range(pick.randint(0, 5))]
        rows.append((pick.randint(0, 10_000), (" " if i % 2 else "\n\t ").join(text)))
    base = [word() for _ in range(300)]
    for i in range(40):  # near copies: one word of each differs
        copy = list(base)
        copy[pick.randrange(300)] = word()
        rows.append((20_000 + pick.randint(0, 500), " ".join(copy)))
    return rows


def test_equals_all_windows(spark, corpus):
    assert run(spark, corpus) == brute(corpus)


def test_loops_and_ties(spark):
    """Texts that repeat themselves: every k-mer ties, and a document is no source for itself."""
    rows = [(3, "la " * 200), (1, "la " * 60), (2, "la di " * 90), (5, "la di " * 25), (9, "la " * 49), (4, "di la " * 26 + "so " * 55)]
    assert run(spark, rows) == brute(rows)
    assert dict((k, n) for k, _, n, _ in run(spark, rows))[3] == 200


def test_nulls_repeats_and_short_texts(spark):
    long = " ".join(f"w{i}" for i in range(120))
    rows = [(None, long), (7, long), (7, long), (7, long + " more"), (8, None), (9, ""), (10, " ".join(f"w{i}" for i in range(49))), (11, long)]
    got = run(spark, rows)
    assert got == brute(rows)
    assert sum(1 for k, *_ in got if k == 7) == 3 and (None, 120, 0, hashlib.sha256(long.encode()).hexdigest()) in got
    assert (11, 120, 120, hashlib.sha256(b"").hexdigest()) in got


def test_other_columns_and_an_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string, tag string, key int")
    assert DB.remove_repeats(df).collect() == []
    df = spark.createDataFrame([(1, "a b", "x", 5)], "doc_id long, text string, tag string, key int")
    assert [(r.doc_id, r.n_words, r.n_removed) for r in DB.remove_repeats(df).collect()] == [(1, 2, 0)]


def test_a_passage_in_very_many_documents(spark):
    """One passage in a third of all rows: as many rows as before, and the first document keeps it."""
    passage = " ".join(f"p{i}" for i in range(70))
    rows = [(i, f"{passage} own{i}" if i % 3 == 0 else f"own{i} " * 10) for i in range(900)]
    got = {k: n for k, _, n, _ in run(spark, rows)}
    assert got == {i: 70 if i % 3 == 0 and i else 0 for i in range(900)}


def test_the_query(spark):
    d = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{d}/documents.parquet").collect()]
    got = QUERIES["op11_de_bruijn_repeats"](spark, d)
    assert got.columns == ["doc_id", "n_words", "n_removed", "kept_sha256"]
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows)
