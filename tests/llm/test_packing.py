"""Fillings against all subsets, and packed corpora against the documents they are made of."""

import random
import zlib
from collections import Counter
from itertools import product

import numpy as np
import public_tokenizers
import pytest
from churnkit.llm import packing as P
from tokenizers import Tokenizer

WORDS = public_tokenizers.path("word_bpe_49k.json")


def test_filling_is_best_of_all_multisets():
    rng = random.Random(0)
    for _ in range(200):
        counts = {rng.randint(1, 30): rng.randint(1, 3) for _ in range(rng.randint(0, 5))}
        window = rng.randint(1, 60)
        used = P.best_filling(counts, window)
        assert not Counter(used) - Counter(counts)
        sums = {sum(n * k for n, k in zip(counts, take, strict=True)) for take in product(*(range(c + 1) for c in counts.values()))}
        assert sum(used) == max(s for s in sums if s <= window)


@pytest.mark.parametrize("pool", [4, 50, 10_000])
def test_packer_loses_nothing(pool):
    rng = random.Random(pool)
    docs = {k: bytes(4 * (rng.choice([1, 2, 63, 64, 65, rng.randint(1, 700)]))) for k in range(400)}
    docs = {k: np.arange(len(v) // 4, dtype="<u4").tobytes() for k, v in docs.items()}
    packer = P.Packer(64, pool)
    for k, ids in docs.items():
        packer.add(k, ids)
    packer.finish()
    _check(packer.rows, docs, 64)
    partial = [n for n in _sizes(packer.rows).values() if n != 64]
    assert len(partial) == len(set(partial)) and all(n & (n - 1) == 0 for n in partial)


def _sizes(rows):
    sizes = Counter()
    for _, _, length, _, _, seq, _ in rows:
        sizes[seq] += length
    return sizes


def _check(rows, docs, window):
    spans, offsets = {}, {}
    for key, start, length, crc, total, seq, offset in rows:
        assert total == len(docs[key]) // 4 and length > 0
        assert crc == zlib.crc32(docs[key][4 * start:4 * (start + length)])
        spans.setdefault(key, []).append((start, length))
        offsets.setdefault(seq, []).append((offset, length))
    assert spans.keys() == docs.keys()
    for key, found in spans.items():
        at = 0
        for start, length in sorted(found):
            assert start == at
            at += length
        assert at == len(docs[key]) // 4
    assert sorted(offsets) == list(range(len(offsets)))
    for found in offsets.values():
        at = 0
        for offset, length in sorted(found):
            assert offset == at
            at += length
        assert at == window or at & (at - 1) == 0


def test_query_form(spark):
    rng = random.Random(3)
    texts = [None, "", " \n", "one", "one", "word " * 30_000] + [" ".join(rng.choice("abcdef") * 3 for _ in range(rng.randint(0, 3000))) for _ in range(60)]
    rows = [(i, t, i, 0) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, start int, part int").repartition(5)
    theirs = Tokenizer.from_file(WORDS)
    docs = {i: np.array([*theirs.encode(t or "", add_special_tokens=False).ids, 1], "<u4").tobytes() for i, t in enumerate(texts)}
    got = P.pack_documents(df, WORDS)
    assert got.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    _check([tuple(r) for r in got.collect()], docs, P.WINDOW)
    assert P.pack_documents(df.limit(0), WORDS).count() == 0
    odd = spark.createDataFrame([(None, "a"), (1, "b"), (1, "b")], "doc_id long, text string").coalesce(1)
    assert sorted((r.doc_id is None, r.doc_tokens) for r in P.pack_documents(odd, WORDS).collect()) == [
        (False, 2), (False, 2), (True, 2)]
