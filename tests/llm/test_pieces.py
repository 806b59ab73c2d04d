"""Unigram ids against the library's own Viterbi over the same pieces, and the way back to text."""

import random

import public_tokenizers
import pytest
import sentencepiece
from churnkit.llm import pieces as P
from sentencepiece import sentencepiece_model_pb2 as pb

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def raw():
    """The given pieces. Those that merging never makes have a score of -1e9; sums with it lose their last digits in the
    single precision of the library, so here they have one that does not."""
    with open(PATH, "rb") as file:
        model = pb.ModelProto.FromString(file.read())
    for p in model.pieces:
        p.score = max(p.score, -1e5)
    return model.SerializeToString()


@pytest.fixture(scope="module")
def coder(raw):
    return P.PieceCoder(P.read_model(raw))


def plain(raw, fallback=True):
    """The library on the same pieces and scores, told that they are a unigram model."""
    model = pb.ModelProto()
    model.ParseFromString(raw)
    model.trainer_spec.model_type = 1
    model.trainer_spec.byte_fallback = fallback
    return sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString())


def plain_ids(model, text):
    """Every path tried, in exact numbers."""
    words = {p.piece: (p.score, i) for i, p in enumerate(model.pieces) if p.type == 1}
    best = {0: (0.0, 0, None)}
    for end in range(1, len(text) + 1):
        for start in range(max(0, end - 20), end):
            if text[start:end] in words and start in best:
                score, piece = words[text[start:end]]
                if end not in best or best[start][0] + score > best[end][0]:
                    best[end] = best[start][0] + score, start, piece
    path, end = [], len(text)
    while end:
        _, end, piece = best[end]
        path.append(piece)
    return path[::-1]


def cases():
    rng = random.Random(2)
    parts = ["the", " ", "  ", "\n", "é", "straße", "日本", "<s>", "<0x41>", "Zug", "12", ".", "\t", "ing", "un", "believ", "ably", "𝄞", "word"]
    return ["".join(rng.choice(parts[:-2]) for _ in range(rng.randint(1, 12))) for _ in range(400)] + [" ", "   ", " a", "a ", "a  b"]


def test_ids_are_the_librarys(raw, coder):
    library = plain(raw)
    known = [t for t in cases() if library.unk_id() not in library.encode(t)]
    assert len(known) > 300
    for t in known:
        assert coder.encode(t).tolist() == library.encode(t), t
        assert coder.decode(coder.encode(t)) == t == library.decode(coder.encode(t).tolist())


def test_byte_fallback(raw, coder):
    library = plain(raw)
    for t in ("𓀀", "a𓀀b", "𓀀𓀁 𓀀", "x \u0001 y", "🜁🜂"):
        ids = coder.encode(t).tolist()
        assert ids == library.encode(t) and coder.decode(coder.encode(t)) == t
    assert coder.encode("𓀀").tolist()[1:] == [3 + b for b in "𓀀".encode()]


def test_long_texts_are_exact(raw, coder):
    """Sums of single precision would drift over a long text; words and the whole text give one answer here."""
    model = pb.ModelProto()
    model.ParseFromString(raw)
    rng = random.Random(5)
    text = " ".join("".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(1, 12))) for _ in range(3000))
    marked = P.SPACE + text.replace(" ", P.SPACE)
    assert coder.encode(text).tolist() == coder.best_path(marked.encode()) == plain_ids(model, marked)
    with open(PATH, "rb") as file:
        given = file.read()
    model.ParseFromString(given)
    assert P.PieceCoder(P.read_model(given)).encode(text).tolist() == plain_ids(model, marked)
    assert coder.decode(coder.encode(text)) == text
    one = "x" * 100_000
    assert coder.decode(coder.encode(one)) == one


def test_trie():
    rng = random.Random(1)
    words = {bytes(rng.choice(b"\x00ab\xff") for _ in range(rng.randint(1, 6))): i for i in range(500)}
    trie = P.build_trie(words)

    def find(word):
        node = 0
        for c in word:
            below = trie.base[node] + c + 1
            if trie.check[below] != node:
                return -1
            node = below
        return trie.value[node]

    assert all(find(w) == i for w, i in words.items())
    others = [bytes(rng.choice(b"\x00ab\xffz") for _ in range(rng.randint(1, 8))) for _ in range(2000)]
    assert all(find(w) == words.get(w, -1) for w in others)


def test_rows(spark):
    with open(PATH, "rb") as file:
        coder = P.PieceCoder(P.read_model(file.read()))
    long = "a b " * 30_000
    rows = [(1, "one two", 5), (1, "one two", 5), (None, "x", 0), (2, None, 0), (3, "", 0), (4, "𓀀 \n", 0), (5, P.SPACE, 0), (6, long, 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids int")
    got = sorted(((r.doc_id, r.n_ids, tuple(r.ids), r.decoded, r.restored) for r in P.piece_ids(df, PATH).collect()), key=str)
    want = [(k, len(i := coder.encode(t or "")), tuple(i.tolist()), (t or "").replace(P.SPACE, " "), P.SPACE not in (t or "")) for k, t, _ in rows]
    assert got == sorted(want, key=str)
    assert P.piece_ids(df.limit(0), PATH).count() == 0


def test_query(spark):
    from churnkit.llm.queries import QUERIES
    folder = "/root/testdata/sf0.001"
    rows = QUERIES["op4_unigram_pieces"](spark, folder).collect()
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    assert len(rows) == len(docs) and all(r.decoded == docs[r.doc_id] and r.restored and r.n_ids == len(r.ids) for r in rows)


def test_other_models_are_refused(raw):
    model = pb.ModelProto()
    model.ParseFromString(raw)
    model.normalizer_spec.remove_extra_whitespaces = True
    with pytest.raises(ValueError):
        P.read_model(model.SerializeToString())
