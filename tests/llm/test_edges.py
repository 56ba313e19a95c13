"""Nulls in any column, empty tables, repeated rows and clashing names: a defined result, no failure."""

from collections import Counter

import pytest
from fixtures import DOCUMENTS

from tidewarden.llm import (divergence, embedding_dedup, grading, line_dedup, mixing, ngram_join, packing, quality_rules, sharding,
                            substring_dedup, token_counts)

CLASHING = "doc_id long, text string, lang string, source string, n_chars long, key long, id long, size int, words string, n int, copies int, shard int, component int, `gone id` int, `gone lines` int, node int, first_node int"


def operators():
    import public_tokenizers

    return {
        "line_dedup": line_dedup.line_verdicts,
        "line_text": line_dedup.without_repeated_lines,
        "sharding": sharding.sharded,
        "quality": quality_rules.filtered,
        "ngram_join": ngram_join.jaccard_groups,
        "mixing": lambda d: mixing.mixed_copies(d, mixing.F.array("source"))[0].select("document.doc_id", "copies"),
        "one_of_each_group": ngram_join.one_of_each_group,
        "divergence_input": lambda d: d.join(divergence.groups(divergence.group_terms(d, 1)).select("source", "found"), "source", "left"),
        "packing": lambda d: packing.packed(d, public_tokenizers.path(packing.TOKENIZER)),
        "tokens": lambda d: token_counts.token_counts(d, public_tokenizers.path(token_counts.TOKENIZER)),
        "substrings": substring_dedup.without_repeats,
    }


@pytest.mark.parametrize("name", operators())
def test_empty_table(spark, name):
    assert operators()[name](spark.createDataFrame([], DOCUMENTS)).count() == 0


@pytest.mark.parametrize("name", operators())
def test_all_texts_null(spark, name):
    rows = [(i, None, None, None, None) for i in range(5)]
    got = operators()[name](spark.createDataFrame(rows, DOCUMENTS)).collect()
    assert len(got) == (0 if name == "quality" else 5)


@pytest.mark.parametrize("name", operators())
def test_extra_columns_do_no_harm(spark, name):
    text = " ".join(f"word{k}" for k in range(40))
    rows = [(i, f"{text} {i}\nline {i}", "en", "s", None, 7, 8, 9, "w", 1, 2, 3, 4, 5, 6, 7, 8) for i in range(6)]
    got = operators()[name](spark.createDataFrame(rows, CLASHING)).collect()
    # The texts are near copies: of a group of these one stays.
    assert {r.doc_id for r in got} == ({0} if name == "one_of_each_group" else set(range(6)))


@pytest.mark.parametrize("name", ["sharding", "quality", "packing", "tokens", "mixing", "ngram_join", "one_of_each_group", "line_dedup", "substrings"])
def test_repeated_rows_are_all_handled(spark, name):
    text = " ".join(f"word{k}" for k in range(40))
    got = operators()[name](spark.createDataFrame([(1, text, "en", "s", None)] * 4 + [(None, text, "en", "s", None)], DOCUMENTS)).collect()
    if name == "packing":  # a document may be cut into several pieces
        per_document = Counter(r.doc_id for r in got if r.start == 0)
        assert per_document == {1: 4, None: 1}
    elif name == "one_of_each_group":
        assert [r.doc_id for r in got] == [1]
    elif name == "ngram_join":
        assert [(r.component_id, r.n_copies) for r in got] == [(1, 5)] * 5
    else:
        assert len(got) == 5


def test_documents_without_an_id_are_grouped(spark):
    texts = [" ".join(f"{p}{k}" for k in range(40)) for p in "abc"]
    rows = [(None, texts[0], None, None, None), (None, texts[0], None, None, None), (7, texts[1], None, None, None),
            (None, texts[1], None, None, None), (None, None, None, None, None), (None, texts[2], None, None, None), (9, None, None, None, None)]
    df = spark.createDataFrame(rows, DOCUMENTS)
    got = ngram_join.jaccard_groups(df).collect()
    assert sorted((str(r.doc_id), str(r.component_id), r.n_copies) for r in got) == sorted([
        ("None", "None", 2), ("None", "None", 2), ("7", "7", 2), ("None", "7", 2), ("None", "None", 1), ("None", "None", 1), ("9", "9", 1)])
    once = ngram_join.one_of_each_group(df).collect()
    assert sorted((str(r.doc_id), r.text or "") for r in once) == sorted([
        ("None", texts[0]), ("7", texts[1]), ("None", ""), ("None", texts[2]), ("9", "")])


def test_a_row_without_an_id_shares_a_passage(spark):
    from fixtures import cut_repeats

    passage = "".join(f"{k:04d} " for k in range(120))
    docs = [(None, "x" * 50 + passage + "end one", None, None, None), (7, "some other start " + passage + "and end", None, None, None),
            (8, "nothing shared here", None, None, None), (None, "another without one " + passage[:450], None, None, None)]
    got = substring_dedup.without_repeats(spark.createDataFrame(docs, DOCUMENTS)).collect()
    want = cut_repeats([(k, d[1]) for k, d in enumerate(docs)], 400)
    assert sorted((r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == sorted(want.values())
    assert sorted(str(r.doc_id) for r in got) == ["7", "8", "None", "None"]


def test_no_vectors(spark):
    assert embedding_dedup.similar_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0


def test_no_ratings(spark, tmp_path):
    spark.createDataFrame([(1, "x y"), (2, None)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert grading.op7_ordinal_quality(spark, str(tmp_path)).count() == 2
