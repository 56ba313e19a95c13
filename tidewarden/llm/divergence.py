"""How the sources of a language differ in their words, by exact integer arithmetic.

A text is lowered and its separators are blanked by one ``bytes.translate``; ``bytes.split`` and a ``Counter`` per
document give its terms. Counts are summed per task before they are shuffled. What follows is sparse: a term that a
source does not have has the group's base probability, so that pairs of sources are summed from histograms of
probabilities, and from the terms that both have.
"""

from __future__ import annotations

import string
from collections import Counter

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewarden.llm.common import kept, table, text_batches

# Fixed by the contract: what separates terms, the lowered letters, and the scale of the probabilities.
SEPARATORS = bytes([*range(0x00, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])
TRANSLATE = bytes.maketrans(
    SEPARATORS + string.ascii_uppercase.encode(), b" " * len(SEPARATORS) + string.ascii_lowercase.encode())
SCALE = 1_000_000_000
MIN_DOCUMENTS = 3
TOP_TERMS = 200

BLOCK = 1 << 20
HELD_TERMS = 200_000
PAIRS_AT_ONCE = 1 << 20
COUNTS = "lang string, source string, term binary, n long, df long"


def document_terms(text: bytes) -> Counter:
    """Terms of one text with their frequencies; a long text is split block by block, between terms."""
    lowered = text.translate(TRANSLATE)
    counts: Counter = Counter()
    lo = 0
    while lo < len(lowered):
        hi = lowered.find(b" ", lo + BLOCK)
        hi = len(lowered) if hi < 0 else hi
        counts.update(lowered[lo:hi].split())
        lo = hi
    return counts


def _task_counts(batches):
    """Frequencies and document counts of one task, given out whenever many terms are held.

    Every group also gives a row without a term, so that groups whose texts have no term are known.
    """
    import pyarrow as pa

    held: dict[tuple[str, str], tuple[Counter, Counter]] = {}

    def given():
        for (lang, source), (documents, more) in held.items():
            terms = [None, *documents]
            df = [0, *documents.values()]
            n = [0, *(d + more.get(t, 0) for t, d in documents.items())]
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(terms)), pa.array([source] * len(terms)), pa.array(terms, pa.binary()),
                 pa.array(n, pa.int64()), pa.array(df, pa.int64())], names=["lang", "source", "term", "n", "df"])
        held.clear()

    for batch in batches:
        for part in text_batches([batch], "text"):
            for lang, source, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), part.column(2)):
                counts = document_terms(text.as_py())
                documents, more = held.setdefault((lang, source), (Counter(), Counter()))
                documents.update(counts.keys())
                more.update({t: n - 1 for t, n in counts.items() if n > 1})
            if sum(len(d) for d, _ in held.values()) > HELD_TERMS:
                yield from given()
    yield from given()


def probability(count: Column, total: Column, vocabulary: Column) -> Column:
    """1 + floor(SCALE * (count + 1) / (total + vocabulary)), in decimals: counts may be beyond 2**33."""
    scaled = (count + 1).cast("decimal(20,0)") * F.lit(SCALE).cast("decimal(10,0)")
    whole = (total + vocabulary).cast("decimal(20,0)")
    return F.when(whole > 0, F.lit(1).cast("long") + F.call_function("div", scaled, whole)).otherwise(F.lit(1).cast("long"))


def divergence(p: Column, q: Column) -> Column:
    """floor((p - q)**2 / q); both are at most SCALE + 1, so the square fits a long."""
    return F.call_function("div", (p - q) * (p - q), q)


def group_terms(documents: DataFrame, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """(lang, source, term, n, n_lang, first) of the kept terms, and a row with a null term per group.

    One exchange by language and term carries the tasks' sums. A term has a row per source and task there, however
    often it occurs. ``first`` marks one source of a term. Null texts, languages and sources are read as ''.
    """
    texts = documents.select(
        F.coalesce("lang", F.lit("")).alias("lang"), F.coalesce("source", F.lit("")).alias("source"),
        F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    counts = texts.mapInArrow(_task_counts, COUNTS).repartition("lang", "term")
    summed = counts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("df").alias("df"))
    term = Window.partitionBy("lang", "term")
    known = summed.select(
        "lang", "source", "term", "n", F.sum("n").over(term).alias("n_lang"), F.sum("df").over(term).alias("df_lang"),
        (F.col("source") == F.min("source").over(term)).alias("first"))
    return known.where(F.col("term").isNull() | (F.col("df_lang") >= min_documents)).drop("df_lang")


def groups(terms: DataFrame) -> DataFrame:
    """(lang, source, total, place, vocabulary, lang_total, base, found): a row per language and source.

    ``place`` numbers the sources of a language, ``base`` is the probability of a term that the source does not
    have, ``found`` counts the terms that it has.
    """
    is_term = F.col("term").isNotNull()
    one = terms.groupBy("lang", "source").agg(
        F.sum("n").alias("total"), F.count_if(is_term).alias("found"), F.count_if(is_term & F.col("first")).alias("firsts"))
    lang = Window.partitionBy("lang")
    numbered = one.select(
        "lang", "source", "total", "found", F.sum("firsts").over(lang).alias("vocabulary"),
        F.sum("total").over(lang).alias("lang_total"), (F.row_number().over(lang.orderBy("source")) - 1).alias("place"))
    return numbered.withColumn("base", probability(F.lit(0), F.col("total"), F.col("vocabulary")))


def _shared(batches):
    """Of each term the pairs of sources that have it: what they add to the sums from histograms."""
    import pyarrow as pa

    f = lambda p, q: (p - q) ** 2 // q
    for batch in batches:
        langs, lang_of = np.unique(np.array(batch.column(0).to_pylist(), dtype=object), return_inverse=True)
        lists = batch.column(1)
        size = np.diff(lists.offsets.to_numpy())
        flat = lists.flatten()
        place, p, base = (flat.field(k).to_numpy().astype(np.int64) for k in range(3))
        begin = np.repeat(np.cumsum(size) - size, size)
        count = np.repeat(size, size)
        lang = np.repeat(lang_of, size)
        width = int(place.max(initial=0)) + 1
        cuts = np.flatnonzero(np.diff(np.cumsum(count) // PAIRS_AT_ONCE)) + 1
        for lo, hi in zip([0, *cuts], [*cuts, len(count)]):
            n = count[lo:hi]
            if not n.sum():
                continue
            a = np.repeat(np.arange(lo, hi), n)
            b = np.repeat(begin[lo:hi] - np.cumsum(n) + n, n) + np.arange(n.sum())
            a, b = a[a != b], b[a != b]
            value = f(p[a], p[b]) - f(p[a], base[b]) - f(base[a], p[b]) + f(base[a], base[b])
            key, at = np.unique((lang[a] * width + place[a]) * width + place[b], return_inverse=True)
            sums = np.zeros(len(key), dtype=np.int64)
            np.add.at(sums, at, value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(langs[key // width // width].tolist(), pa.string()), pa.array((key // width % width).astype(np.int32)),
                 pa.array((key % width).astype(np.int32)), pa.array(sums)], names=["lang", "place", "other", "value"])


def pair_values(terms: DataFrame, known: DataFrame) -> DataFrame:
    """(lang, place, other, value): the summed divergence of each source of a language from each other one.

    With base b and probability p, the sum over all kept terms of f(p_s, p_t) is that of f(p_s, b_t) as if t had no
    term, plus f(b_s, p_t) - f(b_s, b_t) over the terms of t, plus f(p_s, p_t) - f(p_s, b_t) - f(b_s, p_t) + f(b_s, b_t)
    over the terms of both. The first two follow from how many terms of a source have each probability. All sums
    stay below 2**62, since probabilities of a group sum to about SCALE and the number of terms.
    """
    p, base, n, other_base = F.col("p"), F.col("base"), F.col("n_terms"), F.col("o.base")
    others = known.groupBy("lang").agg(F.collect_list(F.struct("place", "base")).alias("others"))
    absent = known.select("lang", "place", "base", base.alias("p"), (F.col("vocabulary") - F.col("found")).alias("n_terms"), F.lit(False).alias("has"))
    present = terms.groupBy("lang", "place", "base", "p").agg(F.count("*").alias("n_terms")).withColumn("has", F.lit(True))
    crossed = present.unionByName(absent).join(others, "lang").select(
        "lang", "place", "base", "p", "n_terms", "has", F.explode("others").alias("o")).where("place <> o.place")
    ways = F.explode(F.array(
        F.struct(F.col("place").alias("place"), F.col("o.place").alias("other"), (n * divergence(p, other_base)).alias("value")),
        F.struct(F.col("o.place").alias("place"), F.col("place").alias("other"),
                 F.when(F.col("has"), n * (divergence(other_base, p) - divergence(other_base, base))).otherwise(0).alias("value"))))
    apart = crossed.select("lang", ways.alias("w")).select("lang", "w.*").groupBy("lang", "place", "other").agg(F.sum("value").alias("value"))
    both = terms.groupBy("lang", "term").agg(F.collect_list(F.struct("place", "p", "base")).alias("having")).where(
        F.size("having") > 1).select("lang", "having").mapInArrow(_shared, "lang string, place int, other int, value long")
    return apart.unionByName(both).groupBy("lang", "place", "other").agg(F.sum("value").alias("value"))


def source_divergence(documents: DataFrame, min_documents: int = MIN_DOCUMENTS, top_terms: int = TOP_TERMS) -> DataFrame:
    """(lang, source, part, item, value, rank): sources against each other and against their language.

    Part ``pair``: every other source of the language. Part ``term``: the terms that a source has more often than its
    language, the ``top_terms`` with the largest divergence. Null texts, languages and sources are read as '', empty
    texts make their group occur, repeated rows count each, equal values are ranked by the item's bytes. An empty
    table gives no rows. Other columns are not read.
    """
    stored = kept(group_terms(documents, min_documents), "group-terms")
    known = kept(groups(stored), "term-groups")
    terms = stored.where("term IS NOT NULL").join(known, ["lang", "source"]).select(
        "lang", "source", "term", "place", "base",
        probability(F.col("n"), F.col("total"), F.col("vocabulary")).alias("p"),
        probability(F.col("n_lang"), F.col("lang_total"), F.col("vocabulary")).alias("q"))
    ranked = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    names = known.select("lang", "place", "source")
    pairs = (
        pair_values(terms, known).join(names, ["lang", "place"])
        .join(names.select("lang", F.col("place").alias("other"), F.col("source").alias("item")), ["lang", "other"])
        .select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(ranked).alias("rank")))
    above = terms.where("p > q").select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").cast("string").alias("item"),
        divergence(F.col("p"), F.col("q")).alias("value"))
    top = above.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= top_terms)
    return pairs.unionByName(top)


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Divergence of the sources of every language, over all documents."""
    return source_divergence(table(spark, sf_dir, "documents"))


OP11_SQL = rf"""
    WITH d AS (SELECT row_number() OVER () AS k, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                      translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}') AS text FROM documents),
    g AS (SELECT DISTINCT lang, source FROM d),
    w AS (SELECT k, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
    v AS (SELECT lang, term, count(*) AS n FROM w GROUP BY lang, term HAVING count(DISTINCT k) >= {MIN_DOCUMENTS}),
    q AS (SELECT lang, term, 1 + ({SCALE}::HUGEINT * (n + 1)) // (sum(n) OVER l + count(*) OVER l) AS q
          FROM v WINDOW l AS (PARTITION BY lang)),
    c AS (SELECT lang, source, term, count(*) AS n FROM w GROUP BY lang, source, term),
    n AS (SELECT g.lang, g.source, v.term, coalesce(c.n, 0) AS n
          FROM g JOIN v ON v.lang = g.lang LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = v.term),
    p AS (SELECT lang, source, term, n, 1 + ({SCALE}::HUGEINT * (n + 1)) // (sum(n) OVER s + count(*) OVER s) AS p
          FROM n WINDOW s AS (PARTITION BY lang, source)),
    found AS (
        SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(sum(((x.p - y.p) * (x.p - y.p)) // y.p), 0) AS value
        FROM g a JOIN g b ON b.lang = a.lang AND b.source <> a.source
        LEFT JOIN p x ON x.lang = a.lang AND x.source = a.source
        LEFT JOIN p y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term
        GROUP BY a.lang, a.source, b.source
        UNION ALL
        SELECT p.lang, p.source, 'term', p.term, ((p - q) * (p - q)) // q
        FROM p JOIN q ON q.lang = p.lang AND q.term = p.term WHERE n > 0 AND p > q)
    SELECT lang, source, part, item, CAST(value AS BIGINT) AS value,
           CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
    FROM found QUALIFY part = 'pair' OR rank <= {TOP_TERMS}"""
