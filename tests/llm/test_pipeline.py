"""Every stage of the pipeline on what its predecessor kept, against brute force or the laws of its contract."""

from collections import Counter

import corpus_pipeline
from fixtures import DOCUMENTS, WORD, base_signals, corpus, jaccard_components, line_components

from tidewarden.llm.common import kept


def without_repeated_lines(docs):
    first = line_components(docs)
    out = {}
    for i, text, *_ in docs:
        lines = (text or "").split("\n")
        left = [x for k, x in enumerate(lines) if first.get((i, k), (i, k)) == (i, k)]
        if left == lines:
            out[i] = text
        elif WORD.search("\n".join(left)):
            out[i] = "\n".join(left)
    return out


def test_stages_follow_each_other(spark, tmp_path):
    docs = corpus(4)
    junk = (999, "spam " * 400, "en", "s0", None)
    spark.createDataFrame([*docs, junk], DOCUMENTS).write.parquet(f"{tmp_path}/documents.parquet")
    frame = spark.read.parquet(f"{tmp_path}/documents.parquet")
    held = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        frame = kept(stage(spark, frame, str(tmp_path)), "stage")
        assert frame.columns == [c.split()[0] for c in DOCUMENTS.split(", ")]
        held.append([tuple(r) for r in frame.collect()])
    rules, lines, unique, mix = held

    passed = {d[0] for d in rules}
    assert passed <= {d[0] for d in docs if not base_signals(d[1])[5]}
    # Prose differs from its group in nothing: clean documents stay.
    assert len(passed) > 25 and 999 not in passed
    assert {d[0]: d[1] for d in lines} == without_repeated_lines(rules)
    assert all(d[4] in (None, len(d[1])) for d in lines)
    least = jaccard_components(lines)
    assert sorted(d[0] for d in unique) == sorted(i for i in least if least[i][1] == i)
    copies = Counter(d[0] for d in mix)
    assert set(copies) <= {d[0] for d in unique} and max(copies.values()) <= 3

    pieces = corpus_pipeline.run(spark, str(tmp_path)).collect()
    ids = Counter()
    for r in pieces:
        ids[r.doc_id] += r.length
    tokens = {r.doc_id: r.doc_tokens for r in pieces}
    assert ids == Counter({i: n * tokens[i] for i, n in copies.items()})
