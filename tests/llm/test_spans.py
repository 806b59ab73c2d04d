"""Aligned tokens against a plain alignment of whole texts, byte by byte, with both libraries as they are."""

import hashlib
import random
from collections import Counter

import pytest

from churnkit.llm import spans
from churnkit.llm.queries import QUERIES, tokenizer_file
from churnkit.llm.tokens import _byte_letters

A, B = tokenizer_file("byte_bpe_50k.json"), tokenizer_file("piece_bpe_32k.model")
TEXTS = ["plain words in a row", " leading and  double   spaces ", "line\nends\n\n and\n  indents\n", "tabs\tand\r\nreturns\x0b\x0c\x1c\x1d\x85\xa0x  y",
         "naïve façade — “quoted” … ½", "你好，世界 😀👩‍👩‍👧 שלום العربية", "a<|endoftext|>b <s> </s> <unk> <0x41> <|endoftext|>", "\x00 zero ﻿ bom ‍",
         "é combining ำ 가 ﬁ", "don't we'll I'M", "   ", "\n", "\n\n\n", "x", "é" * 40, "😀" * 5 + " 😀\n😀", "1234567890 3.14 a1b2", "_" * 70]


def plain(texts):
    """The result of each text, without any cache, cut or span: tokens of whole texts by the sizes of their bytes."""
    import sentencepiece
    from tokenizers import Tokenizer
    ta = Tokenizer.from_file(A)
    ta.encode_special_tokens = True
    tb = sentencepiece.SentencePieceProcessor(model_file=B)
    byte_of = {c: b for b, c in _byte_letters().items()}

    def bytes_b(i):
        p = tb.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if len(p) == 6 and p.startswith("<0x") else p.replace("▁", " ").encode()

    rows, counts = [], Counter()
    for text in texts:
        a, b = (ta.encode(" " + text, add_special_tokens=False).ids, tb.encode(text)) if text else ([], [])
        xs, ys = [bytes(byte_of[c] for c in ta.id_to_token(i)) for i in a], [bytes_b(i) for i in b]
        if text and not b"".join(xs) == b"".join(ys) == (" " + text).encode():
            a, b, xs, ys = [], [], [], []
        of_a = [i for i, x in enumerate(xs) for _ in x]
        of_b = [j for j, y in enumerate(ys) for _ in y]
        links = list(dict.fromkeys(zip(of_a, of_b)))
        counts.update((a[i], b[j]) for i, j in links)
        groups, at = [], 0
        for k in range(1, len(of_a) + 1):
            if k == len(of_a) or of_a[k] != of_a[k - 1] and of_b[k] != of_b[k - 1]:
                groups.append(",".join(str(a[i]) for i in dict.fromkeys(of_a[at:k])) + "|" + ",".join(str(b[j]) for j in dict.fromkeys(of_b[at:k])))
                at = k
        rows.append((len(a), len(b), len(groups), [(a[i], b[j]) for i, j in links], ";".join(groups)))
    most = Counter()
    for (_, j), n in counts.items():
        most[j] = max(most[j], n)
    return [(na, nb, ng, len(links), sum(counts[p] == most[p[1]] for p in links), sum(counts[p] for p in links),
             hashlib.sha256(g.encode()).hexdigest() if g else "") for na, nb, ng, links, g in rows]


COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def run(spark, rows, parts=3, **options):
    df = spark.createDataFrame(rows, "doc_id long, text string, block string, pairs int").repartition(parts)
    got = spans.align_tokens(df, A, B, **options)
    return sorted((r.doc_id if r.doc_id is not None else -1, *[r[c] for c in COLUMNS]) for r in got.collect())


def test_awkward_texts(spark):
    texts = [*TEXTS, "with ▁ marker", "", "plain words in a row"]
    want = [(i, *w) for i, w in enumerate(plain(texts))]
    assert run(spark, [(i, t, "x", 1) for i, t in enumerate(texts)]) == want
    assert want[len(TEXTS)][1:] == (0, 0, 0, 0, 0, 0, "")


def test_random_texts_and_blocks(spark, monkeypatch):
    pick = random.Random(3)
    signs = ["a", "b", "the", "ing", " ", "  ", "\n", "\t", "é", "ß", "你", "😀", ".", ",", "'s", "9", "-", "́", "ﬀ", "\xa0", "<s>"]
    texts = ["".join(pick.choice(signs) for _ in range(pick.randint(0, 60))) for _ in range(250)]
    want = [(i, *w) for i, w in enumerate(plain(texts))]
    assert run(spark, [(i, t, "x", 1) for i, t in enumerate(texts)], 7) == want
    tool = spans.SpanAligner(A, B)
    tool.cut = None  # whole texts
    for t, w in zip(texts, plain(texts), strict=True):
        one = tool.align_text(t)
        assert (one.n_a, one.n_b, one.n_groups, one.n_links) == w[:4]
        assert (hashlib.sha256(one.groups.encode()).hexdigest() if one.groups else "") == w[6]


def test_small_blocks_give_the_same():
    block = spans._Block(0)
    tool = spans.SpanAligner(A, B)
    words = [tool.words(t) for t in TEXTS]
    tool.learn(words)
    for i, w in enumerate(words):
        block.add(i, w, tool.known)
    docs, own = block.rows(["block", "key", *spans._NAMES, "groups_sha256", "groups", "words", "pairs", "counts", "word_pairs", "places"], __import__("pyarrow").int64())
    assert docs["n_links"].to_pylist() == [w[3] for w in plain(TEXTS)]
    assert sum(own["counts"][0].as_py()) == sum(docs["n_links"].to_pylist())


def figures(one):
    return one.n_a, one.n_b, one.n_groups, one.n_links, hashlib.sha256(one.groups.encode()).hexdigest() if one.groups else ""


def test_signs_after_letters_are_words_of_their_own():
    tool = spans.SpanAligner(A, B)
    assert tool.words("Stop, stop. 12% (don't)!") == [" Stop", ",", " stop", ".", " 12", "%", " (don", "'t", ")!"]
    assert tool.words("²! \u0301. x\t.y \n") == [" ²!", " \u0301.", " x\t.y \n"]
    assert tool.words(" \n ") == ["  \n "]
    for t in TEXTS:
        assert "".join(tool.words(t)) == " " + t


def test_cuts_next_to_signs():
    pick = random.Random(8)
    signs = ["don", "l", "é", "ß", "ª", "²", "½", "٣", "7", "'", "'re", "'S", "’", "”", ".", ",", "...", "…", "-", "_", "|", "<", "\\", "×", "µ", "\u0301", " ", "\n", "\t"]
    texts = ["".join(pick.choice(signs) for _ in range(pick.randint(1, 40))) for _ in range(600)]
    tool = spans.SpanAligner(A, B)
    for t, w in zip(texts, plain(texts), strict=True):
        assert figures(tool.align_text(t)) == (*w[:4], w[6]), t


def test_new_words_share_a_text_of_each_library():
    """Every word as a text of its own costs twice the time."""
    class Counted:
        def __init__(self, tool):
            self.tool, self.texts = tool, 0

        def encode_batch(self, texts, **options):
            self.texts += len(texts)
            return self.tool.encode_batch(texts, **options)

    tool = spans.SpanAligner(A, B)
    tool.a = Counted(tool.a)
    texts = [f"word{i}é" + sign for i in range(2000) for sign in ("", ".", ",", "!?")]
    tool.learn([tool.words(" ".join(texts))])
    assert len(tool.known) == 2000 + 3
    assert tool.a.texts <= 1 + 2003 // spans.JOINED_WORDS


def test_words_are_told_apart_in_a_joined_text(monkeypatch):
    texts = [*TEXTS, "ends in white space \n", "a marker▁", "▁", "after it", "你好. 你好, é. é,"]
    want = [(*w[:4], w[6]) for w in plain(texts)]
    joined = spans.SpanAligner(A, B)
    joined.learn([joined.words(t) for t in texts])
    assert [figures(joined.align_text(t)) for t in texts] == want
    # a joined text that either library does not give back is taken apart
    single, aligned = spans.SpanAligner(A, B), spans.SpanAligner._aligned
    monkeypatch.setattr(spans.SpanAligner, "_aligned", lambda self, words, *found: aligned(self, words, *found) if len(words) == 1 else None)
    single.learn([single.words(t) for t in texts])
    assert single.known == joined.known


def test_refined_spans():
    assert spans.byte_ends([(0, 3), (0, 3), (3, 4)], [1, 2, 1], {3, 4}) == [1, 3, 4]
    assert spans.byte_ends([(0, 0), (0, 3), (3, 4)], [2, 1, 1], {4}) == [2, 3, 4]
    assert spans.byte_ends([(0, 1), (1, 2)], [1, 1], {1, 2}) == [1, 2]
    assert spans.byte_ends([], [], set()) == []


def test_nulls_repeats_and_an_empty_table(spark):
    rows = [(None, "same text", "x", 1), (1, "same text", "x", 1), (1, "same text", "x", 1), (2, None, "x", 1), (3, "", "x", 1)]
    got = run(spark, rows)
    texts = plain(["same text"] * 3)
    assert got == sorted([(-1, *texts[0]), (1, *texts[0]), (1, *texts[0]), (2, 0, 0, 0, 0, 0, 0, ""), (3, 0, 0, 0, 0, 0, 0, "")])
    assert run(spark, []) == []


def test_long_text_and_cache(spark, monkeypatch):
    monkeypatch.setattr(spans, "CACHE_WORDS", 50)
    tool = spans.SpanAligner(A, B)
    text = " ".join(f"word{i % 700} é{i}" for i in range(20_000))
    one = tool.align_text(text)
    want = plain([text])[0]
    assert (one.n_a, one.n_b, one.n_groups, one.n_links) == want[:4]


@pytest.mark.parametrize("d", ["/root/testdata/sf0.001"])
def test_the_query(spark, d):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{d}/documents.parquet").collect()]
    got = QUERIES["op12_tokenizer_spans"](spark, d)
    assert got.columns == ["doc_id", *COLUMNS]
    want = sorted((k, *w) for (k, _), w in zip(rows, plain([t or "" for _, t in rows]), strict=True))
    assert sorted(map(tuple, got.collect())) == want
