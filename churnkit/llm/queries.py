"""The registered queries of this subpackage, with SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from churnkit.llm import debruijn, extraction, idfiles, learned_index, packing, pieces, repair, repetition, secrets, simhash, spans, toxicity, warc
from churnkit.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function under its own name, with the equivalent SQL."""
    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            SQL[fn.__name__] = sql
        return fn
    return add


def tokenizer_file(name: str) -> str:
    """Where a public tokenizer's vocabulary lies on this machine; executors have the same package."""
    import public_tokenizers
    return public_tokenizers.path(name)


@query()
def op1_token_id_files(spark: SparkSession, folder: str) -> DataFrame:
    return idfiles.corpus_ids(table(spark, folder, "documents"), tokenizer_file("byte_bpe_50k.json"))


@query()
def op4_unigram_pieces(spark: SparkSession, folder: str) -> DataFrame:
    return pieces.piece_ids(table(spark, folder, "documents"), tokenizer_file("piece_bpe_32k.model"))


@query()
def op6_minimum_bin_slack(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(table(spark, folder, "documents"), tokenizer_file("word_bpe_49k.json"))


@query()
def op7_toxicity_windows(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, folder, "labels")))


@query()
def op8_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents"))


def _repetition_sql(rules: repetition.RepetitionRules) -> str:
    """The figures of ``repetition_quality`` by window functions over words: a window of n words is the word and the n - 1
    that lead it, and a word is covered if one of the n windows ending at or after it repeats."""
    sizes = sorted({repetition.BASE_GRAM, *rules.max_covered})
    grams = ", ".join("CASE WHEN lead(word, {1}) OVER o IS NOT NULL THEN concat_ws(' ', word, {0}) END AS g{2}".format(
        ", ".join(f"lead(word, {k}) OVER o" for k in range(1, n)), n - 1, n) for n in sizes)
    starts = ", ".join(f"g{n} IS NOT NULL AND count(*) OVER (PARTITION BY doc_id, g{n}) > 1 AS s{n}" for n in sizes)
    marks = ", ".join(f"bool_or(s{n}) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW) "
                      f"AS m{n}" for n in sizes)
    spans = ", ".join(f"coalesce(sum(chars) FILTER (m{n}), 0)::BIGINT AS covered_{n}" for n in rules.max_covered)
    over = " OR ".join([*(f"100 * coalesce(covered_{n}, 0) > {most} * coalesce(word_chars, 0)" for n, most in rules.max_covered.items()),
                        f"100 * coalesce(line_chars, 0) > {rules.max_line_chars} * coalesce(word_chars, 0)"])
    base = (f"coalesce(n_words, 0) < {rules.min_words} OR 100 * coalesce(n_repeat_words, 0) > "
            f"{rules.max_repeat_words} * coalesce(n_words, 0)")
    return rf"""
    WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
    split AS (SELECT doc_id, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM d),
    word AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS pos FROM split),
    gram AS (SELECT doc_id, pos, length(word) AS chars, {grams} FROM word WINDOW o AS (PARTITION BY doc_id ORDER BY pos)),
    start AS (SELECT doc_id, pos, chars, {starts} FROM gram),
    mark AS (SELECT doc_id, chars, {marks} FROM start),
    per_doc AS (SELECT doc_id, count(*) AS n_words, sum(chars)::BIGINT AS word_chars,
        count(*) FILTER (m{repetition.BASE_GRAM}) AS n_repeat_words, {spans} FROM mark GROUP BY doc_id),
    line AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d),
    lines AS (SELECT doc_id, line, count(*) AS n FROM line WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
        GROUP BY doc_id, line HAVING count(*) > 1),
    per_line AS (SELECT doc_id, sum(n - 1)::BIGINT AS n_dup_lines,
        sum(n * length(regexp_replace(line, '[\x20\x09-\x0D]+', '', 'g')))::BIGINT AS line_chars FROM lines GROUP BY doc_id)
    SELECT doc_id, coalesce(n_words, 0)::BIGINT AS n_words, coalesce(word_chars, 0)::BIGINT AS word_chars,
        length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines,
        coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words, ({base}) AS base_failed, NOT ({base} OR {over}) AS kept,
        {", ".join(f"coalesce(covered_{n}, 0)::BIGINT AS covered_{n}" for n in rules.max_covered)},
        coalesce(line_chars, 0)::BIGINT AS line_chars
    FROM d LEFT JOIN per_doc USING (doc_id) LEFT JOIN per_line USING (doc_id)
    """


@query()
def op2_learned_partitions(spark: SparkSession, folder: str) -> DataFrame:
    return learned_index.nearest_neighbours(table(spark, folder, "embeddings"))


@query()
def op3_wrapper_induction(spark: SparkSession, folder: str) -> DataFrame:
    return extraction.extract_pages(table(spark, folder, "pages"))


@query(_repetition_sql(repetition.DEFAULT))
def op5_repetition_quality(spark: SparkSession, folder: str) -> DataFrame:
    return repetition.repetition_quality(table(spark, folder, "documents"))


@query()
def op10_secret_scans(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.find_secrets(table(spark, folder, "documents"))


_ARCHIVE_SQL = """
WITH page AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
hashed AS (SELECT page_id, octet_length(encode(html))::BIGINT AS payload_bytes, sha1(html) AS h FROM page),
coded AS (SELECT page_id, payload_bytes, array_to_string(list_transform(range(0, 32), lambda i: substr(
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
        ((('0x' || substr(h, (i // 4)::BIGINT * 5 + 1, 5))::BIGINT >> (15 - 5 * (i % 4))::INTEGER) & 31)::BIGINT + 1, 1)), '') AS payload_digest,
    max(page_id) OVER (PARTITION BY h) AS head FROM hashed)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = head THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id <> head THEN head END AS refers_to
FROM coded
"""


@query(_ARCHIVE_SQL)
def op9_warc_archives(spark: SparkSession, folder: str) -> DataFrame:
    return warc.archive_pages(table(spark, folder, "pages")).drop("url")


_REPEATS_SQL = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
begins AS (SELECT doc_id, w, unnest(range(1, len(w) - {debruijn.WINDOW - 2})) AS i FROM d WHERE len(w) >= {debruijn.WINDOW}),
edge AS (SELECT doc_id, i, md5(array_to_string(w[i:i + {debruijn.WINDOW - 1}], ' ')) AS g FROM begins),
source AS (SELECT g, min(doc_id) AS least FROM edge GROUP BY g),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + {debruijn.WINDOW})) AS pos FROM edge JOIN source USING (g) WHERE least < doc_id),
word AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS pos FROM d),
kept AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY pos) AS t FROM word ANTI JOIN gone USING (doc_id, pos) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""


@query(_REPEATS_SQL)
def op11_de_bruijn_repeats(spark: SparkSession, folder: str) -> DataFrame:
    return debruijn.remove_repeats(table(spark, folder, "documents")).drop("kept")


@query()
def op12_tokenizer_spans(spark: SparkSession, folder: str) -> DataFrame:
    a, b = tokenizer_file("byte_bpe_50k.json"), tokenizer_file("piece_bpe_32k.model")
    return spans.align_tokens(table(spark, folder, "documents"), a, b, keep_groups=False).drop("groups")


@query()
def op13_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    return repair.damaged_and_repaired(table(spark, folder, "conversations"))
