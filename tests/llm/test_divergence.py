"""Source divergence against a plain version, the SQL, and odd inputs."""

import re
from collections import Counter, defaultdict

import oracle
import pytest
from fixtures import DOCUMENTS, corpus

from tidewarden.llm import divergence

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
SMALL = "/root/testdata/sf0.001"


def plain(docs, least=3, top=200):
    lower = {c: c + 32 for c in range(65, 91)}
    counts, df, langs = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for _, text, lang, source, *_ in docs:
        terms = TERM.findall((text or "").translate(lower))
        counts[lang or "", source or ""].update(terms)
        df[lang or ""].update(set(terms))
        langs[lang or ""].add(source or "")
    out = []
    for lang, sources in langs.items():
        kept = [t for t, n in df[lang].items() if n >= least]

        def p(count):
            total = sum(count[t] for t in kept)
            return {t: 1 + 10**9 * (count[t] + 1) // (total + len(kept)) for t in kept}

        by = {s: p(counts[lang, s]) for s in sources}
        q = p(sum((counts[lang, s] for s in sources), Counter()))
        f = lambda a, b: (a - b) * (a - b) // b
        for s in sources:
            pairs = [(o, sum(f(by[s][t], by[o][t]) for t in kept)) for o in sources if o != s]
            terms = [(t, f(by[s][t], q[t])) for t in kept if counts[lang, s][t] and by[s][t] > q[t]]
            for part, found, limit in (("pair", pairs, None), ("term", terms, top)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, i, v, k) for k, (i, v) in enumerate(found[:limit], start=1)]
    return sorted(out)


def got(df):
    return sorted(tuple(r) for r in df.select("lang", "source", "part", "item", "value", "rank").collect())


@pytest.mark.parametrize("seed", [1, 2])
def test_divergence_agrees_with_brute_force(spark, seed):
    docs = corpus(seed)
    assert got(divergence.source_divergence(spark.createDataFrame(docs, DOCUMENTS), top_terms=7)) == plain(docs, top=7)


def test_divergence_agrees_with_sql(spark):
    assert oracle.differences(divergence.op11_source_divergence(spark, SMALL), oracle.connect(SMALL), divergence.OP11_SQL) is None


def test_small_blocks_change_nothing(spark, monkeypatch):
    text = " ".join(f"Tërm{k % 50}-x{k % 7}" for k in range(2000)).encode()
    whole = divergence.document_terms(text)
    monkeypatch.setattr(divergence, "BLOCK", 13)
    assert divergence.document_terms(text) == whole and sum(whole.values()) == 4000


def test_many_pairs_are_summed_in_parts(spark, monkeypatch):
    docs = [(i, " ".join(f"w{chr(97 + k)}" for k in range(i % 11 + 1)), "en", f"s{i % 13}", None) for i in range(130)]
    monkeypatch.setattr(divergence, "PAIRS_AT_ONCE", 1)
    assert got(divergence.source_divergence(spark.createDataFrame(docs, DOCUMENTS))) == plain(docs)


def test_groups_without_terms_and_languages_without_vocabulary(spark):
    docs = [(1, None, "en", "a", None), (1, "", "en", "b", None), (None, "one two", "en", None, None), (2, "zwei", None, "a", None),
            (2, "zwei", None, "a", None), (3, "X" * 300_000 + " zwei", None, "b", None), (4, "123 ???", "xx", "only", None)]
    assert got(divergence.source_divergence(spark.createDataFrame(docs, DOCUMENTS))) == plain(docs)


def test_empty_and_clashing_columns(spark):
    assert divergence.source_divergence(spark.createDataFrame([], DOCUMENTS)).count() == 0
    docs = [(i, f"same words here {i}", "en", f"s{i % 2}", 7) for i in range(6)]
    named = spark.createDataFrame(docs, DOCUMENTS).selectExpr("*", "1 AS term", "2 AS place", "3 AS p", "4 AS n", "5 AS value", "6 AS other", "7 AS total")
    assert got(divergence.source_divergence(named)) == plain(docs)
