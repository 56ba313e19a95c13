"""Token counts, packing, shards, mixing, quality rules and grades."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from fixtures import DOCUMENTS, base_signals, corpus
from tokenizers import Tokenizer

from tidewarden.llm import grading, mixing, packing, quality_rules, sharding, token_counts


def odd_texts():
    rng = random.Random(3)
    texts = ["", " ", "a" * 500, "<|endoftext|>x<|endoftext|>", "it's   \n\n  x", "日本語 🎉🎉", "á́ x" * 9, "a\x1cb\x85c\xa0e"]
    return texts + ["".join(rng.choice("ab c\n'st1é%") for _ in range(rng.randint(0, 200))) for _ in range(200)]


def test_token_counts_equal_the_library(spark):
    path = public_tokenizers.path(token_counts.TOKENIZER)
    texts = odd_texts()
    want = [len(e.ids) for e in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(9999, None)]
    got = {r.doc_id: r for r in token_counts.token_counts(spark.createDataFrame(rows, "doc_id long, text string"), path, 50).collect()}
    assert [got[i].n_tokens for i in range(len(texts))] == want
    assert all(got[i].n_bytes == len(t.encode()) and got[i].over_limit == (want[i] > 50) for i, t in enumerate(texts))
    assert (got[9999].n_bytes, got[9999].n_tokens) == (0, 0)


def test_packing_encodes_as_the_library():
    path = public_tokenizers.path(packing.TOKENIZER)
    texts = odd_texts()
    ids, offsets = packing.encode(texts, path)
    for i, e in enumerate(Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)):
        assert ids[offsets[i]: offsets[i + 1]].tolist() == [*e.ids, 1]


@pytest.mark.parametrize("shard_bytes", [2000, 10**9])
def test_every_token_lies_in_one_piece(spark, shard_bytes):
    path = public_tokenizers.path(packing.TOKENIZER)
    docs = corpus(6)
    tokenizer = Tokenizer.from_file(path)
    want = {i: tokenizer.encode(t or "", add_special_tokens=False).ids + [1] for i, t, *_ in docs}
    rows = packing.packed(spark.createDataFrame(docs, DOCUMENTS), path, 256, shard_bytes).collect()
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    assert set(pieces) == set(want)
    for i, parts in pieces.items():
        at = 0
        for r in sorted(parts, key=lambda r: r.start):
            assert r.start == at and r.ids == want[i][at: at + r.length] and r.doc_tokens == len(want[i])
            assert r.ids_crc32 == zlib.crc32(np.array(r.ids, dtype="<u4").tobytes())
            at += r.length
        assert at == len(want[i])
    for parts in sequences.values():
        at = 0
        for r in sorted(parts, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 256 and at & (at - 1) == 0


def test_neighbours_follow_their_seed():
    rng = random.Random(5)
    topics = [[f"t{k}w{j}" for j in range(12)] for k in range(4)]
    texts = [" ".join(rng.choice(topics[i % 4]) for _ in range(20)) for i in range(40)]
    ids, offsets = packing.encode(texts, public_tokenizers.path(packing.TOKENIZER))
    index = packing.Index(ids, offsets)
    for seed in range(40):
        score = bm25(ids, offsets, seed)
        found = index.neighbours(seed).tolist()
        assert set(found) == {d for d, s in score.items() if s > 0}
        assert all(score[a] >= score[b] - 1e-9 for a, b in zip(found, found[1:]))
    order = list(packing.retrieval_order(index, np.diff(offsets), 10**9))
    assert sorted(order) == list(range(40)) and order[1:] == index.neighbours(0).tolist()


def bm25(ids, offsets, seed):
    """Score of every other document for the terms of the seed that some other document has."""
    docs = [Counter(ids[a:b].tolist()) for a, b in zip(offsets[:-1], offsets[1:])]
    df = Counter(t for d in docs for t in d)
    mean = sum(sum(d.values()) for d in docs) / len(docs)
    out = {}
    for i, d in enumerate(docs):
        if i != seed:
            norm = packing.K1 * (1 - packing.B + packing.B * sum(d.values()) / mean)
            out[i] = sum(np.log1p((len(docs) - df[t] + 0.5) / (df[t] + 0.5)) * d[t] * (packing.K1 + 1) / (d[t] + norm)
                         for t in docs[seed] if df[t] >= 2 and d[t])
    return out


def test_shards_are_even_and_gapless(spark):
    docs = corpus(2, 400) + [(10**6 + k, "same text", "en", "s", None) for k in range(200)]
    rows = sharding.sharded(spark.createDataFrame(docs, DOCUMENTS), 8).collect()
    text = {d[0]: d[1] for d in docs}
    assert len(rows) == len(docs)
    places, load = defaultdict(list), defaultdict(int)
    for r in rows:
        data = (text[r.doc_id] or "").encode()
        assert r.size == len(data) + 16 and r.text_crc32 == zlib.crc32(data)
        places[r.shard].append(r.slot)
        load[r.shard] += r.size
    assert all(sorted(p) == list(range(len(p))) for p in places.values()) and len(places) == 8
    assert max(load.values()) - min(load.values()) <= max(r.size for r in rows)


def test_rebalancing_edits_the_map(spark):
    loads = spark.createDataFrame([(s, 100 + s, 1) for s in range(200)], "virtual_slot int, bytes long, rows long")
    old = sharding.first_map(spark, loads, 4)
    new = sharding.rebalanced(spark, old, loads, 5)
    where = {r.virtual_slot: r.shard for r in old.collect()}
    moved = [r for r in new.collect() if r.shard != where[r.virtual_slot]]
    assert all(r.version == 2 for r in new.collect()) and len(moved) <= 50
    held = defaultdict(int)
    for r in new.collect():
        held[r.shard] += r.bytes
    assert len(held) == 5 and max(held.values()) - min(held.values()) < 400
    assert sharding.rebalanced(spark, new, loads, 5).select("virtual_slot", "shard").exceptAll(new.select("virtual_slot", "shard")).count() == 0


def test_targets_stop_at_the_copies():
    goal = mixing.targets({"a": 100, "b": 1000, "c": 10}, {"a": 5, "b": 2, "c": 1})
    assert goal["a"] == 300 and goal["c"] == 30 and goal["b"] == pytest.approx(780)
    assert mixing.targets({}, {}) == {} and mixing.targets({"a": 0}, {"a": 1}) == {"a": 0}


def test_flow_spreads_repetition_and_uses_overlaps():
    flow = mixing.min_cost_flow({("a",): 100, ("a", "b"): 100}, {"a": 150, "b": 50})
    assert sum(v for (p, s), v in flow.items() if s == "a") == 150 and flow[(("a", "b"), "b")] == 50
    assert all(sum(v for (q, _), v in flow.items() if q == p) <= 100 for p in [("a",), ("a", "b")])
    assert sum(mixing.min_cost_flow({("a",): 10}, {"a": 99}).values()) == 30


def test_mix_meets_its_targets(spark):
    docs = corpus(7, 900)
    rows, sizes, goal = mixing.mixed_copies(spark.createDataFrame(docs, DOCUMENTS), mixing.F.array("source"))
    got = rows.select("document.*", "size", "copies").collect()
    taken, left = defaultdict(int), defaultdict(set)
    for r in got:
        assert 0 <= r.copies <= 3 and r.size == base_signals(next(d[1] for d in docs if d[0] == r.doc_id))[0]
        taken[r.source] += r.copies * r.size
        left[r.source].add((r.copies, r.size))
    assert len(got) == len(docs) and list(goal)[-1] is None
    for s in goal:
        # What is missing is less than the shortest document that is left.
        fewest = min(c for c, size in left[s] if size)
        short = min((size for c, size in left[s] if size and c == fewest), default=0)
        assert 0 <= round(goal[s]) - taken[s] < max(short, 1), (s, goal[s], taken[s], short)
    again = mixing.mixed_copies(spark.createDataFrame(docs, DOCUMENTS).repartition(5), mixing.F.array("source"))[0]
    assert sorted((r.doc_id, r.copies) for r in again.select("document.*", "copies").collect()) == sorted((r.doc_id, r.copies) for r in got)


def test_base_signals_equal_brute_force(spark):
    phrase = "one two three four five six seven eight nine "
    docs = corpus(4) + [(900, phrase * 4, "en", "s", None), (901, phrase + "x " + phrase + "y z " * 40, "en", "s", None)]
    got = quality_rules.with_signals(spark.createDataFrame(docs, DOCUMENTS)).collect()
    want = {d[0]: base_signals(d[1]) for d in docs}
    assert {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got} == want


def test_fences_reject_outliers_of_their_group(spark):
    rng = random.Random(2)
    docs = []
    for i in range(300):
        words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 8))) for _ in range(60)]
        if i % 10 == 0:
            words = [w + "###" for w in words]
        docs.append((i, " ".join(words), "en" if i % 3 else None, f"s{i % 2}" if i < 290 else "rare", None))
    df = spark.createDataFrame(docs, DOCUMENTS)
    kept = {r.doc_id for r in quality_rules.filtered(df).collect()}
    assert kept == {i for i in range(300) if i % 10}
    assert quality_rules.filtered(df).columns == df.columns


def test_fences_are_those_of_sorted_values(spark):
    docs = [(i, " ".join(["abc"] * 0 + ["x" * (1 + i % 9)] * 1 + [f"w{i}{k}" for k in range(30)]), "en", "s", None) for i in range(50)]
    signals = quality_rules.with_signals(spark.createDataFrame(docs, DOCUMENTS))
    limit = quality_rules.fences(quality_rules.sketches(signals)).first()
    values = sorted(r.mean_word for r in signals.collect())
    low, mid = values[4], values[24]
    assert limit.high_mean_word == pytest.approx(mid + 6 * (mid - low) + 1)


def test_grades_are_learnt_and_ordered(spark):
    rng = random.Random(1)
    words = [f"w{k}" for k in range(200)]
    texts, grades = [], []
    for i in range(600):
        g = i % 3
        text = [rng.choice(words) for _ in range(40)] + [["bad", "meh", "good"][g]] * 2
        rng.shuffle(text)
        texts.append(" ".join(text))
        grades.append(g)
    model = grading.fit(pa.array(texts[:450]), np.array(grades[:450]), buckets=1 << 14)
    assert model.thresholds[0] < model.thresholds[1]
    p = grading.probabilities(model, pa.array(texts[450:]))
    held = np.array(grades[450:])
    assert ((p > 0.5).sum(axis=1) == held).mean() > 0.9 and (p[:, 0] >= p[:, 1]).all()
    df = spark.createDataFrame([(1, None), (2, "good good"), (2, "good good")], "doc_id long, text string")
    rows = grading.scored(df, model).collect()
    assert len(rows) == 3 and all(0 <= r.expected_grade <= 2 for r in rows)
