"""Near-duplicates against a plain pairwise version, and the links and components they are made of."""

import random

import numpy as np
import xxhash
from churnkit.llm import simhash as S
from churnkit.llm.components import component_labels

ASCII_SPACE = "\x20\x09\x0a\x0b\x0c\x0d"


def plain_fingerprint(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words, word = [], ""
    for c in lower + " ":
        if c in ASCII_SPACE:
            words, word = ([*words, word] if word else words), ""
        else:
            word += c
    if not words:
        return 0
    grams = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, max_bits=2):
    """{node: least node reachable} over a list of (node, fingerprint)."""
    label = {n: n for n, _ in prints}
    changed = True
    while changed:
        changed = False
        for n, f in prints:
            least = min(label[m] for m, g in prints if (f ^ g).bit_count() <= max_bits)
            if least < label[n]:
                label[n], changed = least, True
    return label


def test_query_cases_against_plain_version(spark):
    rng = random.Random(3)
    base = [" ".join(rng.choice("abcdefgh") * rng.randint(1, 4) for _ in range(300)) for _ in range(6)]
    texts = [*base, *base, None, "", " \n", "One", "one", "a b", "A\tB", "a b", "x " * 40_000]
    for b in base:
        words = b.split()
        for at in (5, 60):
            texts.append(" ".join([*words[:at], "zz", *words[at + 1:]]))
    rows = list(enumerate(texts)) + [(0, texts[0])]
    df = spark.createDataFrame([(i, t, "en", "f" * 3, i) for i, t in rows], "doc_id long, text string, lang string, fp string, label long")
    got = sorted((r.doc_id, r.fingerprint, r.component_id) for r in S.near_duplicates(df).collect())
    prints = [(i, plain_fingerprint(t)) for i, t in rows]
    want = plain_components(prints)
    assert got == sorted((i, f"{f:016x}", want[i]) for i, f in prints)


def test_null_keys_and_empty_table(spark):
    schema = "doc_id long, text string"
    assert S.near_duplicates(spark.createDataFrame([], schema)).count() == 0
    got = S.near_duplicates(spark.createDataFrame([(None, "a b c d"), (5, "a b c d"), (None, "q")], schema)).collect()
    assert sorted((r.doc_id is None, r.component_id) for r in got if r.component_id) == [(False, 5), (True, 5)]
    assert sum(r.component_id is None for r in got) == 1


def test_links_of_a_dense_list(spark):
    """Thousands of fingerprints that share six bytes: linked through the table, not in pairs."""
    rng = np.random.default_rng(1)
    low = rng.choice(1 << 16, 3000, replace=False)
    far = rng.integers(0, 1 << 62, 500)
    prints = [int(x) for x in [*(0x1234567890AB0000 + low), *far]]
    df = spark.createDataFrame([(p,) for p in prints], "fp long")
    labels = {r.node: r.label for r in component_labels(S.posting_links(df)).collect()}
    word = np.array(prints, np.uint64)
    group = np.arange(len(word))
    while True:
        near = np.bitwise_count(word[:, None] ^ word[None, :]) <= 2
        least = np.where(near, group[None, :], len(word)).min(1)
        if (least == group).all():
            break
        group = least
    mine = [labels.get(p, p) for p in prints]
    pairs = set(zip(mine, group.tolist(), strict=True))
    assert len(pairs) == len(set(mine)) == len(set(group.tolist()))


def test_components_of_paths_and_stars(spark):
    path = [(i, i + 1) for i in range(200)]
    star = [(1000, 1000 + i) for i in range(1, 300)]
    ring = [(5000 + i, 5000 + (i + 1) % 50) for i in range(50)]
    df = spark.createDataFrame([*path, *star, *ring, (7, 7), (None, 3), *path[:5]], "a long, b long")
    got = component_labels(df).collect()
    assert len(got) == 201 + 300 + 50 == len({r.node for r in got})
    sides = {(r.label, "path" if r.node <= 200 else "star" if r.node < 5000 else "ring") for r in got}
    assert len(sides) == 3 == len({s for s, _ in sides})
    assert component_labels(df.limit(0)).count() == 0
