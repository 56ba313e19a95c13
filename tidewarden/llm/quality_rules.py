"""Quality rules with thresholds learnt per language and source, DataFrame functions only.

Mergeable KLL sketches of each signal are built per (language, source), merged to languages and to the corpus for
groups too small to judge by themselves, and turned into fences around the median. A joined filter applies them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewarden.llm.common import WORD, kept, table

SYMBOLS = r"[#*$%&|<>]"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30

# Signal -> (least width of the fence, whether low values are judged too).
SIGNALS = {
    "symbol_ratio": (0.02, False),
    "dup_line_ratio": (0.30, False),
    "repeat_ratio": (0.30, False),
    "stutter_ratio": (0.10, False),
    "upper_ratio": (0.10, False),
    "mean_word": (1.0, True),
}
SPREAD = 6.0
SKETCH_K = 2048
LEAST_ROWS = 30
RANKS = (0.1, 0.5, 0.9)


def _base(text: Column) -> dict[str, Column]:
    text = F.coalesce(text, F.lit(""))
    return {
        "words": F.regexp_extract_all(text, F.lit(f"({WORD})"), F.lit(1)),
        "lines": F.filter(F.split(text, "\n", -1), lambda x: x.rlike(WORD)),
        "n_symbols": F.regexp_count(text, F.lit(SYMBOLS)).cast("long"),
        "n_upper": F.regexp_count(text, F.lit(r"\p{Lu}")).cast("long"),
    }


def _repeat_words(hashes: str) -> Column:
    """Words inside windows that occur twice or more, from the array of word hashes named ``hashes``.

    A repeated window repeats its first, fourth and last word at the same distances; texts in which no such triple
    repeats are done. For the others the windows' (hash, place) are sorted, places of hashes with a neighbour alike
    are sorted again, and every place adds as many words as lie before the next one, a window's length at most.
    """
    n = f"size({hashes})"
    triples = f"transform({hashes}, (h, i) -> xxhash64(h, get({hashes}, i + 3), get({hashes}, i + {WINDOW - 1})))"
    windows = f"transform(sequence(1, {n} - {WINDOW - 1}), i -> xxhash64(slice({hashes}, i, {WINDOW})))"
    return F.expr(f"""
        case when {n} <= {WINDOW} then 0L else
          aggregate(array({triples}), 0L, (o, t) -> case when size(array_distinct(t)) = size(t) then 0L else
            aggregate(array(array_sort(transform({windows}, (h, i) -> struct(h as h, i as i)))), 0L, (q, s) ->
              aggregate(array(array_sort(transform(filter(
                  transform(s, (x, i) -> struct(x.i as i,
                    (i > 0 and x.h = get(s, i - 1).h) or (i < size(s) - 1 and x.h = get(s, i + 1).h) as twice)),
                  x -> x.twice), x -> x.i))), 0L, (r, p) ->
                aggregate(transform(p, (x, i) -> if(i = size(p) - 1, {WINDOW}, least({WINDOW}, get(p, i + 1) - x))),
                  0L, (a, x) -> a + x)))
          end)
        end""")


def with_signals(documents: DataFrame) -> DataFrame:
    """Add the counts and ratios of the text to every row; a null text counts as empty.

    Columns of the input that clash with those added are replaced; keep what you need under another name.
    """
    df = documents
    for name, column in _base(F.col("text")).items():
        df = df.withColumn(name, column)
    df = df.withColumn("hashes", F.transform("words", lambda x: F.xxhash64(x)))
    df = (
        df.withColumn("n_words", F.size("words").cast("long"))
        .withColumn("word_chars", F.aggregate("words", F.lit(0).cast("long"), lambda a, x: a + F.length(x)))
        .withColumn("n_lines", F.size("lines").cast("long"))
        .withColumn("n_dup_lines", (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"))
        .withColumn("n_stutters", F.size(F.filter("hashes", lambda x, i: x == F.get("hashes", i + 1))).cast("long"))
        .withColumn("n_repeat_words", _repeat_words("hashes").cast("long"))
        .drop("words", "lines", "hashes")
    )
    per = lambda a, b: F.col(a) / F.greatest(F.col(b), F.lit(1))
    return (
        df.withColumn("base_failed", (F.col("n_words") < MIN_WORDS)
                      | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))
        .withColumn("symbol_ratio", per("n_symbols", "word_chars"))
        .withColumn("dup_line_ratio", per("n_dup_lines", "n_lines"))
        .withColumn("repeat_ratio", per("n_repeat_words", "n_words"))
        .withColumn("stutter_ratio", per("n_stutters", "n_words"))
        .withColumn("upper_ratio", per("n_upper", "word_chars"))
        .withColumn("mean_word", per("word_chars", "n_words"))
    )


def group_key(lang: str = "lang", source: str = "source") -> Column:
    """Text that tells (language, source) pairs apart, nulls included."""
    return F.to_json(F.array(F.col(lang).cast("string"), F.col(source).cast("string")))


def sketches(signals: DataFrame) -> DataFrame:
    """One KLL sketch per signal, language and source, of the rows that passed the base rules."""
    return (
        signals.where(~F.col("base_failed"))
        .groupBy("lang", "source")
        .agg(F.count("*").alias("n"), *(F.kll_sketch_agg_double(s, SKETCH_K).alias(s) for s in SIGNALS))
    )


def fences(sketched: DataFrame, spread: float = SPREAD, least_rows: int = LEAST_ROWS) -> DataFrame:
    """(group_key, low_<signal>, high_<signal>) per language and source.

    A group with fewer than ``least_rows`` rows uses the merged sketch of its language, and the corpus's if that is
    small too. Upper fences use the spread below the median and lower fences the one above it, so that junk on one
    side, up to half of a group, does not move the fence on that side.
    """
    merged = [F.sum("n").alias("n"), *(F.kll_merge_agg_double(s).alias(s) for s in SIGNALS)]
    own = sketched.withColumnsRenamed({s: f"own_{s}" for s in SIGNALS} | {"n": "own_n"})
    by_lang = sketched.groupBy(F.col("lang").alias("l")).agg(*merged)
    by_lang = by_lang.withColumnsRenamed({s: f"lang_{s}" for s in SIGNALS} | {"n": "lang_n"})
    every = sketched.groupBy().agg(*merged).withColumnsRenamed({s: f"all_{s}" for s in SIGNALS} | {"n": "all_n"})
    wide = own.join(by_lang, F.col("lang").eqNullSafe(F.col("l"))).withColumn("one", F.lit(1)).join(
        every.withColumn("one", F.lit(1)), "one")
    out = [group_key().alias("group_key")]
    for signal, (margin, both) in SIGNALS.items():
        chosen = (F.when(F.col("own_n") >= least_rows, F.col(f"own_{signal}"))
                  .when(F.col("lang_n") >= least_rows, F.col(f"lang_{signal}")).otherwise(F.col(f"all_{signal}")))
        low, mid, high = (F.kll_sketch_get_quantile_double(chosen, F.lit(r)) for r in RANKS)
        out.append((mid + spread * (mid - low) + margin).alias(f"high_{signal}"))
        out.append((mid - spread * (high - mid) - margin if both else F.lit(float("-inf"))).alias(f"low_{signal}"))
    return wide.select(*out)


def judged(signals: DataFrame, limits: DataFrame) -> DataFrame:
    """Add ``kept`` to rows with signals: base rules passed and every signal inside its group's fences."""
    inside = F.lit(True)
    for s in SIGNALS:
        inside &= F.col(s).between(F.col(f"low_{s}"), F.col(f"high_{s}"))
    joined = signals.withColumn("group_key", group_key()).join(limits, "group_key", "left")
    return joined.withColumn("kept", ~F.col("base_failed") & F.coalesce(inside, F.lit(False))).select(
        *signals.columns, "kept")


def filtered(documents: DataFrame) -> DataFrame:
    """The documents that pass, with their own columns only.

    Null and short texts fail the base rules; empty input gives none; repeated rows are judged alike. The signals are
    stored beside the rows, so that the fences and the filter read them and neither computes them again.
    """
    own = [F.col(f"`{c}`").alias(f"own {i}") for i, c in enumerate(documents.columns)]
    signals = kept(with_signals(documents.select(*own, "text", "lang", "source")).drop("text"), "quality-signals")
    # A row per language and source: broadcast only if Spark knows it to be small.
    limits = kept(fences(sketches(signals)), "quality-fences")
    passed = judged(signals, limits).where("kept")
    return passed.select(*(F.col(f"own {i}").alias(c) for i, c in enumerate(documents.columns)))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, base rules and the learnt verdict of every document."""
    signals = kept(with_signals(table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")).drop("text"),
                   "quality-signals")
    limits = kept(fences(sketches(signals)), "quality-fences")
    return judged(signals, limits).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "lang", "source", *SIGNALS)
