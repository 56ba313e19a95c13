"""Ordinal quality grades by cumulative-link regression over hashed words.

P(grade > k) = sigmoid(w.x - t_k): one weight vector for all grades and ordered thresholds. The model is fitted on a
bounded sample of rated documents and scores every document: expected grade and the probability of the top grade.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewarden.llm.common import kept, table, text_batches

BUCKETS = 1 << 21
SAMPLE_ROWS = 8000
GRADES = 3
EPOCHS = 300
RATE = 0.05
# The weights are drawn to zero as strongly as by so many documents: few ratings are trusted less.
PRIOR = 1.0
LEAST_DOCS = 4
MIN_TOP = 0.55
# Weight of a word in a text of n words: n to minus this power.
DAMPING = 0.35


class Model(NamedTuple):
    weights: np.ndarray
    thresholds: np.ndarray


def features(texts, buckets: int = BUCKETS):
    """Sparse rows (indptr, bucket, value): presence of lower-cased words, and the share of characters by class.

    Words are cut at ASCII white space and stripped of punctuation; long texts are damped, the shares come on top.
    """
    import pyarrow as pa
    import pyarrow.compute as pc

    split = pc.ascii_split_whitespace(texts.cast(pa.large_string()))
    counts = pc.list_value_length(split).to_numpy(zero_copy_only=False).astype(np.int64)
    coded = split.flatten().dictionary_encode()
    if isinstance(coded, pa.ChunkedArray):
        coded = coded.combine_chunks()
    bare = pc.utf8_trim(pc.utf8_lower(coded.dictionary), characters=".,;:!?\"'()[]")
    words = bare.to_pylist()
    word_bucket = np.fromiter((_hash(w) % buckets for w in words), dtype=np.int64, count=len(words))
    shape = np.array([[any(c in "#*$%&|<>" for c in w), "!!" in w or (len(w) > 2 and w.isupper())]
                      for w in coded.dictionary.to_pylist()], dtype=float).reshape(-1, 2)
    codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    doc = np.repeat(np.arange(len(counts)), counts)
    key = np.unique(doc * buckets + word_bucket[codes])
    rows, cols = key // buckets, key % buckets
    per = np.bincount(rows, minlength=len(counts))
    values = np.maximum(per[rows], 1) ** -DAMPING
    n = np.maximum(counts, 1)
    dense = np.stack([
        np.bincount(doc, weights=shape[codes, 0], minlength=len(counts)) / n,
        np.bincount(doc, weights=shape[codes, 1], minlength=len(counts)) / n,
        1 - per / n,
        np.log1p(counts) / 10,
    ], axis=1)
    return rows, cols, values, dense


def _hash(word: str) -> int:
    import zlib

    return zlib.crc32(word.encode())


def raw_scores(model: Model, texts) -> np.ndarray:
    rows, cols, values, dense = features(texts, len(model.weights) - 4)
    return np.bincount(rows, weights=values * model.weights[cols], minlength=len(texts)) + dense @ model.weights[-4:]


def fit(texts, grades: np.ndarray, n_grades: int = GRADES, buckets: int = BUCKETS, epochs: int = EPOCHS) -> Model:
    """Full-batch Adam on the cumulative-link likelihood; thresholds are a first one plus positive steps."""
    rows, cols, values, dense = features(texts, buckets)
    # Words of very few rated documents say nothing about others.
    often = np.bincount(cols, minlength=buckets)[cols] >= LEAST_DOCS
    rows, cols, values = rows[often], cols[often], values[often]
    used, local = np.unique(cols, return_inverse=True)
    n, k = len(grades), n_grades - 1
    decay = PRIOR / max(n, 1)
    w, tail = np.zeros(len(used) + dense.shape[1]), np.r_[-1.0, np.zeros(k - 1)]
    above = (grades[:, None] > np.arange(k)[None, :]).astype(float)
    # Rare grades weigh more, by the root of their rarity.
    weight = np.sqrt(n / (n_grades * np.maximum(np.bincount(grades, minlength=n_grades), 1)))[grades][:, None]
    state = [np.zeros(len(w) + k), np.zeros(len(w) + k)]
    for step in range(1, epochs + 1):
        score = np.bincount(rows, weights=values * w[local], minlength=n) + dense @ w[len(used):]
        t = np.cumsum(np.r_[tail[0], np.exp(tail[1:])])
        p = 1 / (1 + np.exp(-np.clip(score[:, None] - t[None, :], -30, 30)))
        g = weight * (p - above) / n
        gs = g.sum(axis=1)
        gw = np.r_[np.bincount(local, weights=values * gs[rows], minlength=len(used)), dense.T @ gs] + decay * w
        gt = -g.sum(axis=0)
        gtail = np.r_[gt.sum(), [gt[j:].sum() * np.exp(tail[j]) for j in range(1, k)]]
        grad = np.r_[gw, gtail]
        state[0] = 0.9 * state[0] + 0.1 * grad
        state[1] = 0.999 * state[1] + 0.001 * grad * grad
        move = RATE * (state[0] / (1 - 0.9**step)) / (np.sqrt(state[1] / (1 - 0.999**step)) + 1e-9)
        w, tail = w - move[: len(w)], tail - move[len(w):]
    weights = np.zeros(buckets + dense.shape[1])
    weights[used] = w[: len(used)]
    weights[buckets:] = w[len(used):]
    return Model(weights, np.cumsum(np.r_[tail[0], np.exp(tail[1:])]))


def probabilities(model: Model, texts) -> np.ndarray:
    """P(grade > k) for each text and k."""
    return 1 / (1 + np.exp(-np.clip(raw_scores(model, texts)[:, None] - model.thresholds[None, :], -30, 30)))


def graded_sample(documents: DataFrame, ratings: DataFrame, rows: int = SAMPLE_ROWS):
    """At most ``rows`` rated documents (text, grade), the first by a hash of the id: an Arrow table on the driver."""
    chosen = (ratings.where("grade is not null and doc_id is not null").groupBy("doc_id").agg(F.min("grade").alias("grade"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows))
    chosen = kept(chosen, "rated-ids")
    return documents.where("text is not null").join(F.broadcast(chosen), "doc_id").select("text", "grade").toArrow()


def scored(documents: DataFrame, model: Model) -> DataFrame:
    """(doc_id, expected_grade, p_top) of every document; a null text is an empty one.

    The weights have a fixed size, so they travel as a broadcast. Other columns are not read; repeated rows are
    scored alike.
    """
    shared = documents.sparkSession.sparkContext.broadcast((model.weights, model.thresholds))

    def score(batches):
        import pyarrow as pa

        own = Model(*shared.value)
        for batch in batches:
            for part in text_batches([batch], "text"):
                p = probabilities(own, part.column(1))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(p.sum(axis=1)), pa.array(p[:, -1].copy())],
                    names=["doc_id", "expected_grade", "p_top"])

    return documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).mapInArrow(
        score, "doc_id long, expected_grade double, p_top double")


def op7_ordinal_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected grade and tail probability of every document. Grades: 0 toxic, 1 poor, 2 good."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    ratings = table(spark, sf_dir, "labels").select(
        "doc_id", F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1).when(F.col("quality") == 1, 2).alias("grade"))
    sample = graded_sample(documents, ratings).combine_chunks()
    if not sample.num_rows:
        model = Model(np.zeros(BUCKETS + 4), np.arange(GRADES - 1, dtype=float))
    else:
        model = fit(sample["text"].combine_chunks(), sample["grade"].to_numpy().astype(int))
    return scored(documents, model).withColumn("kept", F.col("p_top") >= MIN_TOP)
