"""Repetition figures against plain loops over windows."""

import random
from collections import Counter

import numpy as np
from churnkit.llm import repetition as R
from churnkit.llm.queries import SQL

SPACE = " \t\n\r\x0b\f"


def words_of(text):
    for c in SPACE:
        text = text.replace(c, " ")
    return [w for w in text.split(" ") if w]


def plain(text):
    text = text or ""
    words = words_of(text)
    chars = sum(map(len, words))

    def inside(n):
        windows = [tuple(words[i:i + n]) for i in range(len(words) - n + 1)]
        seen = Counter(windows)
        return {j for i, w in enumerate(windows) if seen[w] > 1 for j in range(i, i + n)}

    lines = Counter(line for line in text.split("\n") if words_of(line))
    repeat = len(inside(5))
    failed = len(words) < 10 or 100 * repeat > 20 * len(words)
    spans = {n: sum(len(words[j]) for j in inside(n)) for n in R.DEFAULT.max_covered}
    line_chars = sum(n * sum(map(len, words_of(line))) for line, n in lines.items() if n > 1)
    over = any(100 * spans[n] > most * chars for n, most in R.DEFAULT.max_covered.items()) or 100 * line_chars > 40 * chars
    return {"n_words": len(words), "word_chars": chars, "n_symbols": sum(c in "#*$%&|<>" for c in text),
            "n_dup_lines": sum(n - 1 for n in lines.values()), "n_repeat_words": repeat, "base_failed": failed,
            "kept": not failed and not over, "line_chars": line_chars} | {f"covered_{n}": v for n, v in spans.items()}


def cases():
    rng = random.Random(5)
    texts = [None, "", " \n\t", "a", "a b c d e a b c d e", "é\xa0ß \x85x \x1cy", "same line\nsame line\n\n\nother", "#* $|\n<>&%",
             "a b c d e f g h i j", "one\r\ntwo\x0bthree\ffour", "x " * 3000, "é" * 50_000]
    for n in (12, 60, 400):
        for letters in ("ab", "abcdefghij", "abcdefghijklmnopqrstuvwxyzé"):
            texts.append("".join(rng.choice(letters) + rng.choice(["", " ", " ", "\n"]) for _ in range(n)))
    block = " ".join(f"w{i}" for i in range(12))
    texts += [f"{block} {' '.join(f'u{i}' for i in range(k))} {block}" for k in (0, 20, 60, 200)]
    return texts


def test_measures_equal_plain_loops(spark):
    texts = cases()
    rows = [*enumerate(texts), (None, "q w e"), (1, "")]
    df = spark.createDataFrame([(i, t, 1, True) for i, t in rows], "doc_id long, text string, n_words int, kept boolean")
    got = sorted(map(str, (r.asDict() for r in R.repetition_quality(df).collect())))
    assert got == sorted(str({k: ({"doc_id": i} | plain(t))[k] for k in R.repetition_quality(df).columns}) for i, t in rows)
    kept = R.keep_quality(df)
    assert kept.schema == df.schema
    assert sorted(map(str, kept.collect())) == sorted(
        str(r) for r in df.collect() if plain(r.text)["kept"])
    assert R.repetition_quality(df.limit(0)).count() == 0


def test_colliding_hashes_do_not_count(monkeypatch):
    monkeypatch.setattr(R, "_mixed", lambda ids: np.zeros(len(ids), np.uint64))
    for text in cases():
        assert R.measure(text or "") == plain(text)


def test_sql_says_the_same_on_awkward_rows():
    import duckdb
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    texts = cases()
    con.executemany("INSERT INTO documents VALUES (?, ?)", [[i, t] for i, t in enumerate(texts)])
    cur = con.execute(SQL["op5_repetition_quality"])
    names = [c[0] for c in cur.description]
    for row in cur.fetchall():
        got = dict(zip(names, row, strict=True))
        assert {k: v for k, v in got.items() if k != "doc_id"} == plain(texts[got["doc_id"]])
