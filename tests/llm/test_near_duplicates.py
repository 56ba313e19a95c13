"""Lines, documents, vectors and byte strings that repeat, against brute force."""

import random

import numpy as np
import pytest
from fixtures import DOCUMENTS, corpus, cut_repeats, jaccard_components, least_reachable, line_components

from tidewarden.llm import common, embedding_dedup, hnsw, line_dedup, neardup, ngram_join, substring_dedup, suffixes


def test_components_are_the_least_reachable_ids(spark):
    rng = random.Random(4)
    links = [(rng.randrange(400), rng.randrange(400)) for _ in range(330)] + [(1000, k) for k in range(1001, 1200)]
    links += [(k, k + 1) for k in range(2000, 2060)] + [(5, 5)]
    want = least_reachable({n for e in links for n in e}, links)
    linked = {n for a, b in links if a != b for n in (a, b)}
    got = common.components(spark.createDataFrame(links, "a long, b long").repartition(5)).collect()
    assert {r.id: r.component for r in got} == {n: want[n] for n in linked} and len(got) == len(linked)


def test_components_of_no_links(spark):
    assert common.components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("seed", [1, 2])
def test_ngram_join_is_exact(spark, seed):
    docs = corpus(seed)
    got = ngram_join.jaccard_groups(spark.createDataFrame(docs, DOCUMENTS).repartition(4)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == jaccard_components(docs)


def test_ngram_join_with_few_items_per_set(spark):
    """Small sets fill few segments: the one-deletion neighbours and empty segments are needed."""
    rng = random.Random(8)
    docs = []
    for i in range(300):
        words = [f"w{rng.randrange(4)}{k}" for k in range(rng.randint(4, 16))]
        docs.append((i, " ".join(words), "en", "s", None))
    got = ngram_join.jaccard_groups(spark.createDataFrame(docs, DOCUMENTS)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == jaccard_components(docs)


def test_signatures_meet_for_all_similar_sets():
    rng = np.random.default_rng(3)
    for n in [*range(1, 40), 75, 200, 900]:
        a = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
        for _ in range(4):
            gone = rng.integers(0, n // 9 + 1)
            b = np.unique(np.concatenate([rng.permutation(a)[gone:], rng.integers(0, 2**63, gone).astype(np.uint64)]))
            common_ = len(np.intersect1d(a, b))
            if not len(b) or 100 * common_ < 80 * (len(a) + len(b) - common_):
                continue
            keys, docs, chosen = ngram_join.signatures(np.concatenate([a, b]), np.array([len(a), len(b)]))
            mine = {k: c for k, d, c in zip(keys.tolist(), docs, chosen) if d == 0}
            assert any(d == 1 and k in mine and (c or mine[k]) for k, d, c in zip(keys.tolist(), docs, chosen)), n


def test_similar_sets_share_a_key_that_neither_spares():
    """Whatever the frequencies are: here the keys that both have are the most frequent ones, and so spared first."""
    rng = np.random.default_rng(6)
    for n in [*range(1, 40), 75, 200, 900, 3000]:
        a = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
        for _ in range(4):
            gone = rng.integers(0, n // 9 + 1)
            b = np.unique(np.concatenate([rng.permutation(a)[gone:], rng.integers(0, 2**63, gone).astype(np.uint64)]))
            common_ = len(np.intersect1d(a, b))
            if not len(b) or 100 * common_ < 80 * (len(a) + len(b) - common_):
                continue
            keys, docs, _, level, spare = ngram_join.spared_signatures(np.concatenate([a, b]), np.array([len(a), len(b)]))
            both = set(keys[docs == 0].tolist()) & set(keys[docs == 1].tolist())
            left = {0: set(), 1: set()}
            for d in (0, 1):
                for step in (False, True):
                    own = [(k in both, k, s) for k, s in zip(keys[(docs == d) & (level == step)].tolist(), spare[(docs == d) & (level == step)].tolist())]
                    left[d] |= {k for i, (_, k, s) in enumerate(sorted(own, reverse=True)) if i >= s}
            assert left[0] & left[1], n


def test_parities_never_tell_more_than_the_difference():
    rng = np.random.default_rng(7)
    for n in (1, 20, 150, 2000):
        a, b = (np.unique(rng.integers(0, 2**63, n).astype(np.uint64)) for _ in range(2))
        b = np.unique(np.concatenate([a[n // 4:], b[: n // 8]]))
        x, y = neardup.parities(np.concatenate([a, b]), np.repeat([0, 1], [len(a), len(b)]), 2).view(np.uint64)
        apart = sum(int(p ^ q).bit_count() for p, q in zip(x, y))
        assert apart <= len(np.setxor1d(a, b)) and (apart > 0) == (n > 1)


def test_members_that_do_not_link_are_not_paired(spark, monkeypatch):
    """Far copies of one text share keys with all its near copies; pairs that cannot link never become rows."""
    rng = random.Random(12)
    origin = [f"w{k}" for k in range(150)]
    docs = []
    for i in range(240):
        words = list(origin)
        for k in rng.sample(range(150), 1 + i % 2 * 8):
            words[k] = f"x{i}y{k}"
        docs.append((i, " ".join(words), "en", "s", None))
    pairs, stored = {}, common.Scratch.kept

    def counted(self, frame, purpose):
        out = stored(self, frame, purpose)
        pairs[purpose] = out.count()
        return out

    monkeypatch.setattr(common.Scratch, "kept", counted)
    got = ngram_join.jaccard_groups(spark.createDataFrame(docs, DOCUMENTS).repartition(4)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == jaccard_components(docs)
    assert len({r.component_id for r in got}) > 100 and pairs["rest"] < 10 * len(docs)


def test_lines_that_met_the_head_of_their_key_are_done(spark, monkeypatch):
    """Lines that share keys two by two and do not link: once the two are compared nothing is left for the last round."""
    rng = random.Random(5)
    docs = []
    for i in range(80):
        words = [f"{rng.randrange(10**6):06d}" for _ in range(40)]
        changed = [f"{rng.randrange(10**6):06d}" if k in (7, 15, 22, 30, 36) else w for k, w in enumerate(words)]
        docs += [(2 * i, " ".join(words), "en", "s", None), (2 * i + 1, " ".join(changed), "en", "s", None)]
    stored, tables = common.Scratch.kept, {}

    def counted(self, frame, purpose):
        out = stored(self, frame, purpose)
        tables[purpose] = out.count()
        return out

    monkeypatch.setattr(common.Scratch, "kept", counted)
    got = line_dedup.line_verdicts(spark.createDataFrame(docs, DOCUMENTS).repartition(3)).collect()
    assert len(got) == len(docs) and all(r.kept for r in got)
    assert tables["first"] > 20 and tables["marked"] == 0


def test_stored_buckets_stay_where_they_are(spark):
    """Of a join by the key of a bucketed table only the other side moves; the table goes with its folder."""
    scratch = common.Scratch()
    texts = scratch.bucketed(spark.range(500).groupBy("id").agg(common.F.first(common.F.lit("text")).alias("text")), "texts", "id")
    few = spark.range(0, 1000, 7).hint("merge")
    met = texts.join(few, "id", "left_semi")
    assert met.count() == 72
    plan = met._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1, plan
    name = next(iter(scratch.names.values()))
    assert spark.catalog.tableExists(name)
    scratch.drop_all()
    assert not spark.catalog.tableExists(name) and not scratch.names


def test_packed_postings_keep_all_entries():
    keys = np.repeat(np.arange(5, dtype=np.uint64) << np.uint64(41), [1, 2, 3, 200, 70])
    ids = np.arange(len(keys)) + 2**40
    batch = neardup.pack_postings(keys, ids, ids % 2 == 0, 7)
    found, hot = [], 0
    for bucket, blob in zip(*(c.to_pylist() for c in batch.columns)):
        k, i = neardup._unblob(blob)
        hot += len(k) if bucket == neardup.HOT else 0
        found += zip((k >> np.uint64(1) << np.uint64(1)).tolist(), i.tolist(), (k & np.uint64(1)).astype(bool).tolist())
    # Of the two hot keys two entries each stay in a bucket.
    assert hot == 200 + 70 - 4
    assert sorted(found) == sorted(zip(keys.tolist(), ids.tolist(), (ids % 2 == 0).tolist()))


def test_lines_are_grouped_as_by_brute_force(spark):
    docs = corpus(3)
    line = "a line of some length that will be changed in one place only"
    docs += [(900 + k, f"{line}\n{line[:30 + k]}X{line[31 + k:]}\n\n{line}", "en", "s", None) for k in range(6)]
    got = line_dedup.line_verdicts(spark.createDataFrame(docs, DOCUMENTS).repartition(3)).collect()
    want = line_components(docs)
    assert len(got) == sum(len((d[1] or "").split("\n")) for d in docs)
    for r in got:
        first = want.get((r.doc_id, r.line_no), (r.doc_id, r.line_no))
        assert (r.first_doc_id, r.first_line_no) == first and r.kept == (first == (r.doc_id, r.line_no))


def test_documents_lose_repeated_lines_only(spark):
    docs = [(1, "first line of text\nsecond line here", "en", "s", 5), (2, "first line of text\nanother one", None, None, 6),
            (3, "second line here", "en", "s", 7), (4, None, "en", "s", None), (5, " ", "en", "s", 1)]
    got = line_dedup.without_repeated_lines(spark.createDataFrame(docs, DOCUMENTS)).collect()
    assert {r.doc_id: r.text for r in got} == {1: "first line of text\nsecond line here", 2: "another one", 4: None, 5: " "}
    assert next(r.n_chars for r in got if r.doc_id == 2) == 11


def test_line_identity_is_the_same_on_both_sides(spark):
    lines = ["", "x", "ä" * 40, "some line 日本", "a" * 33]
    got = spark.createDataFrame([(x,) for x in lines], "line string").select(line_dedup.line_id(line_dedup.F.col("line"))).collect()
    assert [r[0] for r in got] == [line_dedup._identity(x) for x in lines]


def vectors(seed=2, n=400, dim=16):
    rng = np.random.default_rng(seed)
    heads = rng.normal(size=(40, dim))
    out = []
    for i in range(n):
        v = heads[rng.integers(40)] + rng.normal(size=dim) * rng.choice([0.02, 0.2, 0.35])
        out.append((i, [float(x) for x in v.astype(np.float32)], int(rng.integers(3))))
    out += [(n + k, out[0][1], out[0][2]) for k in range(50)]
    out += [(1000, None, 1), (1001, [0.0] * dim, 1), (1002, [float("nan")] * dim, 1), (1003, out[0][1], None), (1004, [], 1),
            (1005, [None] * dim, 1), (1006, [1.0, 2.0], 1), (1007, [2.0, 4.0], 1), (1008, [float("inf")] * dim, 1)]
    return out


def cosine_links(rows, least=0.93):
    good = [(i, np.array(v, dtype=float), label) for i, v, label in rows
            if v and label is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    return [(a[0], b[0]) for k, a in enumerate(good) for b in good[k + 1:] if a[2] == b[2] and len(a[1]) == len(b[1])
            and a[1] @ b[1] / np.linalg.norm(a[1]) / np.linalg.norm(b[1]) >= least]


def test_vectors_link_as_by_brute_force(spark):
    rows = vectors()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(4)
    got = embedding_dedup.similar_vectors(df, shard_rows=60).collect()
    links = cosine_links(rows)
    least = least_reachable([r[0] for r in rows], links)
    degree = {r[0]: 0 for r in rows}
    for a, b in links:
        degree[a] += 1
        degree[b] += 1
    assert len(got) == len(rows)
    assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got} == {i: (degree[i], least[i], least[i] == i) for i in degree}


def test_graph_finds_what_brute_force_finds():
    rng = np.random.default_rng(9)
    heads = rng.normal(size=(150, 32))
    x = heads[rng.integers(150, size=3000)] + rng.normal(size=(3000, 32)) * 0.15
    x = (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)
    graph = hnsw.Graph.load(hnsw.Graph.build(x).dump())
    rows, nodes = graph.near(x, 0.93, 32)
    found = set(zip(rows.tolist(), nodes.tolist()))
    truth = set(zip(*(a.tolist() for a in graph.exact(x, 0.93))))
    assert found <= truth and len(found) >= 0.98 * len(truth)


def test_suffix_order_and_repeats():
    rng = np.random.default_rng(1)
    for trial in range(20):
        length = [5, 40, 100, 400][trial % 4]
        n = length + int(rng.integers(0, 2500))
        text = rng.integers(97, 97 + [1, 2, 4, 26][trial % 3], n).astype(np.uint8)
        text[n // 2:] = text[: n - n // 2] if trial % 2 else text[n // 2:]
        starts = np.sort(rng.choice(n - length + 1, size=min(n - length + 1, 900), replace=False))
        data = text.tobytes()
        keys = [data[i: i + length] for i in starts.tolist()]
        want = sorted(i for i, k in zip(starts.tolist(), keys) if keys.count(k) > 1)
        assert sorted(suffixes.repeated_starts(text, starts, length).tolist()) == want
        padded = np.concatenate([text, np.zeros(length + suffixes.PREFIX, np.uint8)])
        ordered = suffixes.sorted_suffixes(padded, starts, length).tolist()
        assert [data[i: i + length] for i in ordered] == sorted(keys)


@pytest.mark.parametrize("hot", [512, 1])
def test_repeated_strings_go_as_by_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(substring_dedup, "HOT_SNIPPETS", hot)
    docs = corpus(5)
    got = substring_dedup.without_repeats(spark.createDataFrame(docs, DOCUMENTS).repartition(3)).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got} == cut_repeats(docs, 400)


def test_long_texts_are_cut_into_pieces(monkeypatch):
    monkeypatch.setattr(substring_dedup, "PIECE", 700)
    offsets = np.array([0, 300, 3000])
    pieces = substring_dedup._pieces(offsets, 400)
    covered = [s + k for _, _, s, e in pieces for k in range(e - s - 399)]
    assert covered == list(range(300, 3000 - 399))


def test_an_audit_is_not_passed_on_self_matches(monkeypatch):
    """A search that finds only the query itself must widen its beam, however rare links are."""
    rng = np.random.default_rng(3)
    vectors = rng.normal(size=(600, 32))
    vectors[590:] = vectors[:10] + 0.01 * rng.normal(size=(10, 32))
    vectors = (vectors / np.linalg.norm(vectors, axis=1)[:, None]).astype(np.float32)
    graph = hnsw.Graph.build(vectors)
    near, beams = hnsw.Graph.near, []

    def blind(self, q, least, beam):
        beams.append(beam)
        rows, nodes = near(self, q, least, beam)
        if beam < 128:
            lost = (vectors[nodes] != q[rows]).any(axis=1)
            rows, nodes = rows[~lost], nodes[~lost]
        return rows, nodes

    monkeypatch.setattr(hnsw.Graph, "near", blind)
    own = np.arange(600)
    rows, nodes, beam = graph.audited(vectors, own, 0.93, 32, 64, 0.98)
    found = {(a, b) for a, b in zip(rows.tolist(), nodes.tolist()) if a != b}
    assert beam >= 128 and {(k, 590 + k) for k in range(10)} | {(590 + k, k) for k in range(10)} == found
    # Queries that are not in the shard, and a shard without any link.
    rows, nodes, beam = graph.audited(-vectors[:5], np.full(5, -1), 0.93, 32, 64, 0.98)
    assert len(rows) == 0 and beam == 32
