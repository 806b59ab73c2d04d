"""Toxicity scores of documents by the network of ``gru``, learned from labelled documents."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnkit.llm.common import keep_rows, map_batches, text_of
from churnkit.llm.gru import Model, train

# At most so many labelled documents of either class are learned from, and none longer than this.
MAX_TOXIC, MAX_CLEAN, MAX_CHARS = 600, 2400, 40_000
FOLDS = 5
THRESHOLD = 0.5


def held_out(key: str):
    """Whether a document's label is kept from learning: the remainder of the CRC-32 of its key as text is 0."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % FOLDS == 0, F.lit(True))


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic") -> Model:
    """A model learned from labelled documents that are not held out.

    Of each class the documents whose key has the least hash are taken, up to the stated numbers, whatever the number of
    labels; the sample is joined to ``docs`` as a side of bounded size. A document with several labels has the largest. A
    null label is none; a null key is held out. Training runs on the driver, on the sample alone.
    """
    known = (labels.where(F.col(label).isNotNull() & F.col(key).isNotNull()).where(~held_out(key))
             .groupBy(key).agg((F.max(label) > 0).cast("int").alias("label")))
    counts = {r.label: r.n for r in known.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return Model(None, 0.0)
    draw = F.xxhash64(F.lit("sample"), F.col(key))
    parts = [known.where(F.col("label") == y).orderBy(draw, key).limit(n) for y, n in ((1, MAX_TOXIC), (0, MAX_CLEAN))]
    sample = parts[0].union(parts[1])
    rows = (docs.select(F.col(key).alias("sampled"), text_of(text).alias("text")).where(F.length("text") <= MAX_CHARS)
            .join(F.broadcast(sample), F.col("sampled") == F.col(key))
            .groupBy(key).agg(F.min(F.struct("text", "label")).alias("row")).orderBy(key).collect())
    return train([r.row.text for r in rows], [r.row.label for r in rows], counts.get(1, 0) / sum(counts.values()))


class SharedModel:
    """A model sent to executors once. A process keeps the scorer, with the words it has seen, for its later tasks."""

    def __init__(self, docs: DataFrame, model: Model):
        self.sent = docs.sparkSession.sparkContext.broadcast(model)
        self.name = uuid.uuid4().hex

    def scorer(self):
        if self.name not in _SCORERS:
            _SCORERS.clear()
            _SCORERS[self.name] = self.sent.value.scorer()
        return _SCORERS[self.name]


_SCORERS: dict[str, object] = {}


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, held_out, score, predicted) for every row of ``docs``: the score of the whole text, from 0 to 1, over all its
    overlapping windows. Only the text enters it. A null text is empty; empty texts have the score of the empty word. Null
    and repeated keys get a row each; an empty table gives none."""
    kind = docs.schema[key].dataType.simpleString()
    shared = SharedModel(docs, model)

    def run(batches):
        scorer = shared.scorer()
        for b in batches:
            yield {"key": b["key"], "score": scorer.scores(b["text"])}

    rows = map_batches(docs.select(F.col(key).alias("key"), text_of(text).alias("text")), run, f"key {kind}, score double")
    return rows.select(F.col("key").alias(key), held_out("key").alias("held_out"), "score",
                       (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that the model does not call toxic, all columns as they are."""
    shared = SharedModel(docs, model)
    return keep_rows(docs, text, lambda texts: (shared.scorer().scores([t or "" for t in texts]) < THRESHOLD).tolist())
