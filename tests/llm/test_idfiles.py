"""Codes against plain Huffman coding, and exact round trips through files."""

import heapq
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from churnkit.llm import idfiles as I
from churnkit.llm.huffman import BLOCK, Codebook, code_lengths
from churnkit.llm.ranges import plan_ranges
from churnkit.llm.tokens import TextEncoder
from tokenizers import Tokenizer

BYTES, WORDS = map(public_tokenizers.path, ("byte_bpe_50k.json", "word_bpe_49k.json"))


def plain_cost(counts):
    heap = [int(c) for c in counts if c]
    heapq.heapify(heap)
    cost = 0
    while len(heap) > 1:
        pair = heapq.heappop(heap) + heapq.heappop(heap)
        cost += pair
        heapq.heappush(heap, pair)
    return cost


@pytest.mark.parametrize("n", [2, 3, 17, 500])
def test_lengths_are_best_and_limited(n):
    rng = np.random.default_rng(n)
    counts = rng.integers(0, 1000, n)
    counts[:2] = 1
    lengths = code_lengths(counts, 24)
    assert (lengths * counts).sum() == plain_cost(counts)
    steep = (1.7 ** np.arange(40)).astype(np.int64)
    for limit in (6, 9, 12):
        short = code_lengths(steep, limit)
        assert short.max() <= limit and np.isclose((0.5 ** short).sum(), 1) and (np.diff(short) <= 0).all()
    with pytest.raises(ValueError):
        code_lengths(np.ones(5), 2)


def test_coding_round_trip():
    rng = np.random.default_rng(0)
    for top, total in ((1, 3000), (2, 10), (50_000, 40_000)):
        ids = np.minimum(rng.zipf(1.3, total), top) - 1
        book = Codebook(code_lengths(np.bincount(ids)))
        cuts = np.unique(np.r_[0, rng.integers(0, total, 12), total])
        sizes = np.diff(cuts)
        payloads, marks = book.encode(ids, sizes)
        assert len(marks) == (-(-sizes // BLOCK)).sum()
        for n, payload, at in zip(sizes, payloads, cuts, strict=False):
            k = -(-n // BLOCK)
            mine, marks = marks[:k], marks[k:]
            held = np.minimum(BLOCK, n - BLOCK * np.arange(k))
            assert (book.decode(payload, mine, held) == ids[at:at + n]).all()
            # any block can be read by itself
            last = book.decode(payload, mine[-1:], held[-1:])
            assert (last == ids[at + n - held[-1]:at + n]).all()
    with pytest.raises(ValueError):
        book.encode(np.array([60_000 % len(book.lengths)]) * 0 + int(np.flatnonzero(book.lengths == 0)[0]), np.array([1]))


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_words_give_the_ids_of_the_text(path):
    rng = random.Random(2)
    parts = ["a", "The", " ", " ", " ", "  ", "\n", "\t", "12", ".", "'s", "'ll", "ß", "日本", "́", "Σ", "\x1c", "\x85",
             "<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|endo", "\r\n", "😀", "!?"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 30))) for _ in range(3000)]
    mine = TextEncoder(path)
    assert mine.by_words
    theirs = Tokenizer.from_file(path)
    want = [np.array(e.ids, "<u4").tobytes() for e in theirs.encode_batch(texts, add_special_tokens=False)]
    assert [ids for i in range(0, 3000, 50) for ids in mine.encode(texts[i:i + 50])] == want
    assert mine.encode(["lone \ud800 half"]) == mine.encode(["lone ? half"])


def test_files_hold_every_document_in_order(spark, tmp_path):
    texts = [None, "", " ", "one two", "one two", "two\n\n three", "long " * 30_000, "é日本 " * 50]
    rows = [(9 - i, t, 7) for i, t in enumerate(texts)] + [(None, "nobody", 1), (9, "again", 2), (10**15, "far", 0), (-5, "low", 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, start int").repartition(5)
    encoded = I.stored(I.encode_documents(df, BYTES), "t")
    folder = str(tmp_path / "ids")
    manifest = I.write_id_files(encoded, folder, file_tokens=50)
    assert manifest.count() > 3
    theirs = Tokenizer.from_file(BYTES)
    want = {}
    for k, t, _ in rows:
        want.setdefault(k, []).append([*theirs.encode(t or "", add_special_tokens=False).ids, 0])
    got = I.read_id_files(spark, folder).collect()
    for r in got:
        ids = np.frombuffer(bytes(r.ids), "<u4").tolist()
        assert ids in want[r.key] and r.n_tokens == len(ids) and r.ids_crc32 == zlib.crc32(bytes(r.ids))
    assert len(got) == len(rows)
    ordered = sorted(got, key=lambda r: r.start)
    assert [r.start for r in ordered] == np.cumsum([0, *(r.n_tokens for r in ordered)])[:-1].tolist()
    keys = [r.key for r in ordered]
    assert keys == [None, *sorted(k for k in keys if k is not None)]
    again = str(tmp_path / "again")
    I.write_id_files(encoded.repartition(3), again, file_tokens=50)
    assert {(r.file, r.crc32) for r in spark.read.parquet(f"{again}/manifest").collect()} == {(r.file, r.crc32) for r in manifest.collect()}
    name = manifest.first().file
    with open(f"{folder}/{name}", "r+b") as file:
        file.seek(-1, 2)
        last = file.read(1)
        file.seek(-1, 2)
        file.write(bytes([last[0] ^ 1]))
    with pytest.raises(Exception, match="not as it was written"):
        I.read_id_files(spark, folder).collect()


def test_query_form_and_empty_table(spark):
    df = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    got = {r.doc_id: (r.start, r.n_tokens) for r in I.corpus_ids(df, WORDS).collect()}
    assert got == {1: (0, 3), 2: (3, 1)}
    assert I.corpus_ids(df.limit(0), BYTES).count() == 0


def test_ranges_depend_on_rows_alone(spark):
    rng = random.Random(1)
    keys = [rng.choice([7, 7, rng.randint(0, 1000), 2**62 - rng.randint(0, 5), None]) for _ in range(4000)]
    df = spark.createDataFrame([(k, 2) for k in keys], "k long, w long")
    a, b = plan_ranges(df, "k", "w", 300), plan_ranges(df.repartition(13), "k", "w", 300)
    assert a == b and sum(a.totals) == 8000
    found = a.find(keys)
    for i, total in enumerate(a.totals):
        mine = [k for k, f in zip(keys, found, strict=True) if f == i]
        assert 2 * len(mine) == total
        assert total <= 300 or len({k for k in mine if k is not None}) == 1 or None in mine


@pytest.mark.parametrize("path,text,ids", [(BYTES, "a <|endoftext|> b", [64, 220, 50256, 275]), (WORDS, "a <|endoftext|> b", [320, 49407, 321])])
def test_added_tokens_in_a_text(path, text, ids):
    """As the library has it with its default settings."""
    assert np.frombuffer(TextEncoder(path).encode([text])[0], "<u4").tolist() == ids
