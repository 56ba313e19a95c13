"""Cross parsing against a greedy parse with ``in``, held-out accuracy, and odd inputs."""

import random
import zlib

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidewarden.llm import cross_parsing as cp

SHAPE = "doc_id long, text string, lang string"


def parser(samples):
    rows = pd.concat([cp._learnt(pd.DataFrame({"lang": k, "place": range(len(v)), "piece": v})) for k, v in samples.items()])
    return cp.Parser([tuple(r) for r in rows.itertuples(index=False)])


def greedy(data, pieces):
    count, at = 0, 0
    while at < len(data):
        end = at + 1
        while end < len(data) and any(data[at: end + 1] in p for p in pieces):
            end += 1
        count, at = count + 1, end
    return count


@pytest.mark.parametrize("segment", [7, 1024])
def test_phrases_are_longest_matches(monkeypatch, segment):
    monkeypatch.setattr(cp, "SEGMENT", segment)
    rng = random.Random(segment)
    make = lambda letters, n: "".join(rng.choice(letters) for _ in range(n))
    samples = {"a": [make("abc é", 60) for _ in range(4)], "b": [make("bcdß ", 90) for _ in range(3)]}
    own = {k: [cp.normal(p) for p in dict.fromkeys(v)] for k, v in samples.items()}
    texts = [cp.normal(make("abcdéßz ", n)) for n in (0, 1, 2, 9, 30, 200, 2500)]
    got = parser(samples).phrases(texts)
    for k, lang in enumerate(sorted(samples)):
        want = [sum(greedy(t[i: i + segment], own[lang]) for i in range(0, len(t), segment)) for t in texts]
        assert got[k].tolist() == want


def test_the_automaton_knows_all_substrings():
    data = list(b"abcabxabcabcabd")
    follow = cp.suffix_automaton(data)
    for i in range(len(data)):
        state = 0
        for c in data[i:]:
            state = follow[state][c]
    assert len(follow) <= 2 * len(data) and ord("z") not in follow[0]


def test_held_out_rows_are_recognised(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    got = cp.op12_language(spark, folder).join(docs.select("doc_id", "lang"), "doc_id")
    right, n = got.where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert right >= 0.98 and n > 150
    for r in got.take(50):
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1


def test_held_out_labels_are_not_learnt(spark):
    out = [i for i in range(400) if zlib.crc32(str(i).encode()) % 5 == 0]
    rows = [(i, "kalt wald haus", "wrong") if i in out else (i, "kalt wald haus" if i % 2 else "sun sea wind", "de" if i % 2 else "en") for i in range(400)]
    docs = spark.createDataFrame(rows, SHAPE)
    model = cp.learnt(docs)
    assert {r.lang for r in model.collect()} == {"de", "en"}
    assert {r.lang_pred for r in cp.identified(docs, model).where("held_out").collect()} == {"de"}


def test_the_sample_is_bounded_and_copies_do_not_fill_it(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "copy " * 100).otherwise(
        F.concat(F.lit("text "), F.sha2(F.col("id").cast("string"), 512))).alias("text"), F.lit("en").alias("lang"))
    assert cp.sample(docs).count() == cp.SAMPLE_ROWS
    assert cp.learnt(docs).first().n_bytes <= cp.SAMPLE_BYTES
    assert cp.sample(docs).where("length(piece) > 200").count() == 0


def test_odd_rows(spark):
    rows = [(i, "der wald und das haus am see", "de") for i in range(1, 30)] + [(i, "the sea and the sun and a house", "en") for i in range(30, 60)]
    odd = [(None, "der wald", None), (None, "der wald", "en"), (70, None, "de"), (70, "", "de"), (71, "12 34 !?", "en"), (72, "日本語", None),
           (73, "the sun " * 60_000, None)]
    docs = spark.createDataFrame(rows + odd + odd, SHAPE).selectExpr("*", "1 AS held_out", "2 AS score", "3 AS piece", "4 AS place", "5 AS rank", "'x' AS source")
    got = cp.identified(docs, cp.learnt(docs))
    assert got.count() == 59 + 14
    by = {}
    for r in got.collect():
        by.setdefault(r.doc_id, set()).add((r.held_out, r.lang_pred, r.score if r.lang_pred == "und" else None))
    assert by[None] == {(True, "de", None)} and {x[1:] for x in by[70] | by[71]} == {("und", 0.0)}
    assert {x[1] for x in by[73]} == {"en"} and {x[1] for x in by[72]} <= {"de", "en"}


def test_nothing_to_learn(spark):
    docs = spark.createDataFrame([(1, "text", None), (2, None, "en")], SHAPE)
    assert {(r.lang_pred, r.score) for r in cp.identified(docs, cp.learnt(docs)).collect()} == {("und", 0.0)}
    none = spark.createDataFrame([], SHAPE)
    assert cp.identified(none, cp.learnt(none)).count() == 0
