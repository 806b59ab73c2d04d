"""The pipeline against plain versions of its stages on small tables."""

import random
import zlib

import corpus_pipeline as C
import numpy as np
import public_tokenizers
import pytest
from churnkit.llm import repetition, secrets, toxicity
from tokenizers import Tokenizer

from tests.llm.test_jaccard import plain_stay


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    rng = random.Random(8)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8))) for _ in range(400)]
    rows, labels = [], []
    for i in range(260):
        text = [rng.choice(words) for _ in range(rng.randint(15, 120))]
        bad = i % 4 == 0
        if bad:
            for _ in range(3):
                text.insert(rng.randint(0, len(text)), rng.choice(["zorg", "blarx"]))
        if i % 7 == 1:
            text.insert(4, 'token = "0123456789abcdef0123456789abcdef"')
        rows.append((i, " ".join(text)))
        labels.append((i, 1, int(bad)))
    rows += [(300 + i, rows[i][1]) for i in range(1, 30)] + [(400, None), (401, ""), (402, "too short"), (403, "same line\n" * 40),
             (1, rows[1][1]), (None, " ".join(words[:30])), (500, " ".join(words) + " tail" + "\n".join(words))]
    # near copies: one word of a hundred differs, so nine in ten shingles are shared
    near = [rng.choice(words) for _ in range(100)]
    rows += [(599 + i, " ".join([*near[:20 * i + 5], f"other{i}", *near[20 * i + 6:]]) if i else " ".join(near)) for i in range(4)]
    df = spark.createDataFrame([(k, t, "en", "s", len(t or "")) for k, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    df.write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def test_stages_and_result(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    model = toxicity.fit(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    rows = [tuple(r) for r in docs.collect()]
    scores = model.scorer().scores([t or "" for _, t, *_ in rows])
    kept = [r for r, s in zip(rows, scores, strict=True) if s < 0.5]
    assert 20 < len(rows) - len(kept) < 150
    kept = [r for r in kept if repetition.measure(r[1] or "")["kept"]]
    stay = plain_stay([(k, t) for k, t in dict((r[0], r[1]) for r in sorted(kept, key=str, reverse=True) if r[0] is not None).items()])
    assert not stay & {600, 601, 602} and stay & set(range(1, 30))
    thinned = {r[0]: r for r in sorted(kept, key=str, reverse=True) if r[0] in stay}
    want = [*thinned.values(), *(r for r in kept if r[0] is None)]
    assert len(want) < len(kept)
    want = [(k, m := secrets.mask(t), a, b, n if m == t else len(m)) for k, t, a, b, n in want]
    assert any("[secret]" in r[1] for r in want)

    now = docs
    for name, stage in C.STAGES[:-1]:
        now = stage(spark, now, folder)
        assert now.columns == docs.columns, name
    assert sorted(map(str, map(tuple, now.collect()))) == sorted(map(str, want))

    encode = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")).encode
    ids = {k: np.array([*encode(t, add_special_tokens=False).ids, 1], "<u4").tobytes() for k, t, *_ in want}
    parts, ends = {}, {}
    for r in C.run(spark, folder).collect():
        assert r.ids_crc32 == zlib.crc32(ids[r.doc_id][4 * r.start:4 * (r.start + r.length)]) and r.doc_tokens == len(ids[r.doc_id]) // 4
        parts.setdefault(r.doc_id, []).append((r.start, r.length))
        ends.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert parts.keys() == ids.keys()
    for key, found in [*parts.items(), *((None, x) for x in ends.values())]:
        at = 0
        for start, n in sorted(found):
            assert start == at
            at += n
        assert at <= 2048 if found in ends.values() else at == len(ids[key]) // 4


def test_empty_tables(spark, tmp_path):
    for name, schema in (("documents", "doc_id long, text string, lang string, source string, n_chars long"), ("labels", "doc_id long, quality int, toxic int")):
        spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/{name}.parquet")
    assert C.run(spark, str(tmp_path)).count() == 0
