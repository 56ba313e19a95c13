"""Language identification by cross parsing.

A suffix automaton of labelled text per language recognises all substrings of that text. A text is cut greedily
into the longest phrases that a language's automaton knows, and the language that needs the fewest, weighted by
the cost of pointing into its text, wins.
"""

from __future__ import annotations

import functools
import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewarden.llm.common import kept, ranges, table, text_batches

FOLDS = 5
UNKNOWN = "und"
# The sample that a language is learnt from: pieces of so many of its rows, each of so many characters, and of the
# distinct pieces so many bytes in all. These bound the model, whatever the number of labelled rows.
SAMPLE_ROWS = 512
PIECE = 200
SAMPLE_BYTES = 40_000
SPREAD = 64
# Texts are parsed in segments of so many bytes, all side by side; a phrase ends where its segment does.
SEGMENT = 1024
BATCH_BYTES = 2 << 20

# ASCII is lowered, what is no ASCII letter separates; bytes of other characters stand for themselves.
LETTERS = b"abcdefghijklmnopqrstuvwxyz"
NORMAL = bytes(b if b >= 0x80 or b in LETTERS else b + 32 if b + 32 in LETTERS and b < 0x5B else 0x20 for b in range(256))
BARRIER = 256


def normal(text: str) -> bytes:
    """Lower-case words between single spaces, with a space at either end; nothing for a text without a word."""
    words = text.lower().encode().translate(NORMAL).split()
    return b" " + b" ".join(words) + b" " if words else b""


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def suffix_automaton(symbols: list[int]) -> list[dict[int, int]]:
    """Transitions of the smallest automaton that accepts the substrings of ``symbols``; state 0 is the start."""
    follow: list[dict[int, int]] = [{}]
    link, length = [-1], [0]
    last = 0
    for c in symbols:
        new = len(follow)
        follow.append({})
        length.append(length[last] + 1)
        link.append(0)
        at = last
        while at >= 0 and c not in follow[at]:
            follow[at][c] = new
            at = link[at]
        if at >= 0:
            to = follow[at][c]
            if length[to] == length[at] + 1:
                link[new] = to
            else:
                copy = len(follow)
                follow.append(dict(follow[to]))
                length.append(length[at] + 1)
                link.append(link[to])
                while at >= 0 and follow[at].get(c) == to:
                    follow[at][c] = copy
                    at = link[at]
                link[to] = link[new] = copy
        last = new
    return follow


def held_out(doc_id: Column, folds: int = FOLDS) -> Column:
    """Whether crc32 of the id as text is a multiple of ``folds``; a null id counts as an empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds == 0


def sample(documents: DataFrame) -> DataFrame:
    """(lang, place, piece) of at most ``SAMPLE_ROWS`` rows a language, chosen by a hash of their ids.

    A piece starts at a place that the text's hash chooses, so copies give equal pieces. Tasks keep their first
    rows before the exchange, so a language with most rows sends no more than another; the tasks' rows of a
    language meet in ``SPREAD`` groups first, so that their number does not matter either.
    """
    start = F.pmod(F.xxhash64("text"), F.greatest(F.length("text") - PIECE, F.lit(0)) + 1).cast("int") + 1
    labelled = documents.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    group = F.pmod(F.spark_partition_id(), F.lit(SPREAD)).alias("group")
    pieces = labelled.select("lang", group, F.xxhash64("doc_id").alias("place"), F.substring(F.col("text"), start, F.lit(PIECE)).alias("piece"))
    for keys in (["lang", "group"], ["lang"]):
        rank = F.row_number().over(Window.partitionBy(*keys).orderBy("place", "piece"))
        pieces = pieces.withColumn("rank", rank).where(F.col("rank") <= SAMPLE_ROWS).drop("rank")
    return pieces.drop("group")


def _learnt(rows: pd.DataFrame) -> pd.DataFrame:
    """The automaton of one language's sample: its transitions as arrays, and the bytes it was built from."""
    rows = rows.sort_values(["place", "piece"]).drop_duplicates("piece")
    symbols: list[int] = []
    n_bytes = 0
    for piece in rows["piece"]:
        data = normal(piece)
        if n_bytes + len(data) > SAMPLE_BYTES:
            continue
        symbols += [*data, BARRIER]
        n_bytes += len(data)
    follow = suffix_automaton(symbols)
    moves = [(s, c, t) for s, by in enumerate(follow) for c, t in by.items() if c != BARRIER]
    state, symbol, to = (np.array(x, dtype=d).tobytes() for x, d in zip(list(zip(*moves)) or [(), (), ()], ("<i4", "u1", "<i4")))
    return pd.DataFrame([(rows["lang"].iloc[0], n_bytes, len(follow), state, symbol, to)],
                        columns=["lang", "n_bytes", "states", "state", "symbol", "target"])


def learnt(documents: DataFrame) -> DataFrame:
    """A row per language: the automaton of its sample. A task holds one language's sample."""
    model = sample(documents).groupBy("lang").applyInPandas(
        _learnt, "lang string, n_bytes long, states int, state binary, symbol binary, target binary")
    return model.where("n_bytes > 0")


class Parser:
    """The automata of all languages as one table: next state and whether a phrase ends, by state and symbol.

    Takes 4 bytes per state and byte value seen in the samples: 2 * ``SAMPLE_BYTES`` states a language at most.
    """

    def __init__(self, model: list[tuple]):
        model = sorted(model)
        self.langs = [m[0] for m in model]
        self.cost = np.array([math.log2(m[1] + 1) for m in model])
        moves = [(np.frombuffer(m[3], "<i4"), np.frombuffer(m[4], "u1"), np.frombuffer(m[5], "<i4")) for m in model]
        seen = np.unique(np.concatenate([m[1] for m in moves]))
        self.width = len(seen) + 1
        self.symbol = np.zeros(256, dtype=np.int32)  # 0: not in any sample
        self.symbol[seen] = np.arange(1, self.width)
        # Two more states a language: before a segment, and after a byte that no phrase can hold.
        first = np.cumsum([0, *(m[2] + 2 for m in model)])
        out = np.empty((first[-1], self.width), dtype=np.int32)
        self.start = np.empty(len(model), dtype=np.int32)
        for k, (state, symbol, to) in enumerate(moves):
            lo, hi = first[k], first[k + 1]
            begin, lost = hi - 2, hi - 1
            goes = np.full((hi - lo, self.width), -1, dtype=np.int64)
            goes[state, self.symbol[symbol]] = to + lo
            afresh = np.where(goes[0] >= 0, goes[0], lost)
            out[lo:hi] = np.where(goes >= 0, goes << 1, (afresh << 1) | 1)
            out[begin], out[lost] = afresh << 1, (afresh << 1) | 1
            self.start[k] = begin
        self.table = out.ravel()

    def phrases(self, texts: list[bytes]) -> np.ndarray:
        """Phrases of each text in each language."""
        lengths = np.array([len(t) for t in texts], dtype=np.int64)
        data = self.symbol[np.frombuffer(b"".join(texts), dtype=np.uint8)]
        pieces = -(-lengths // SEGMENT)
        owner = np.repeat(np.arange(len(texts)), pieces)
        start = np.repeat(np.cumsum(lengths) - lengths, pieces) + SEGMENT * ranges(np.zeros(len(texts), dtype=np.int64), pieces)
        size = np.minimum(np.repeat(np.cumsum(lengths), pieces) - start, SEGMENT)
        order = np.argsort(-size, kind="stable")
        owner, start, size = owner[order], start[order], size[order]
        active = len(size) - np.searchsorted(size[::-1], np.arange(int(size.max(initial=0))), side="right")
        state = np.repeat(self.start[:, None], len(size), axis=1)
        ends = np.ones((len(self.langs), len(size)), dtype=np.int32)
        for i, n in enumerate(active.tolist()):
            move = self.table[state[:, :n] * np.int32(self.width) + data[start[:n] + i]]
            ends[:, :n] += move & 1
            state[:, :n] = move >> 1
        counts = np.zeros((len(self.langs), len(texts)), dtype=np.int64)
        for k in range(len(self.langs)):
            counts[k] = np.bincount(owner, ends[k], len(texts)).astype(np.int64)
        return counts

    def judged(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, score and phrases of each text. Equal costs go to the language that sorts first.

        The score is the winner's share if a language weighs 2 to the minus its bits: phrases times bits a phrase.
        """
        known = np.array([has_letter(t) for t in texts], dtype=bool)
        counts = self.phrases([normal(t) if k else b"" for t, k in zip(texts, known)])
        bits = counts * self.cost[:, None]
        best = bits.argmin(axis=0)
        least = bits.min(axis=0)
        score = 1 / np.exp2(np.maximum(least - bits, -1000)).sum(axis=0)
        langs = [self.langs[b] if k else UNKNOWN for b, k in zip(best, known)]
        return langs, np.where(known, score, 0.0), np.where(known, counts[best, np.arange(len(texts))], 0)


@functools.lru_cache(maxsize=1)
def _parser(model) -> Parser:
    return Parser(model.value)


def identified(documents: DataFrame, model: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, phrases) of every row, from its whole text alone.

    A text that is null or has no letter, and any text when nothing was learnt, is ``und`` with score 0. Repeated rows
    are all judged; a null id counts as held out. ``model`` has a row of bounded size per language and goes to
    every task.
    """
    spark = documents.sparkSession
    rows = [tuple(r) for r in model.collect()]
    texts = documents.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    if not rows:
        return texts.select("doc_id", "held_out", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(0).cast("long").alias("phrases"))
    shared = spark.sparkContext.broadcast(rows)

    def judged(batches):
        import pyarrow as pa

        parser = _parser(shared)
        for batch in batches:
            for part in text_batches([batch], "text", BATCH_BYTES):
                langs, score, phrases = parser.judged(part.column(2).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(langs, pa.string()), pa.array(score), pa.array(phrases, pa.int64())],
                    names=["doc_id", "held_out", "lang_pred", "score", "phrases"])

    kind = documents.schema["doc_id"].dataType.simpleString()
    return texts.mapInArrow(judged, f"doc_id {kind}, held_out boolean, lang_pred string, score double, phrases long")


def op12_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learnt from the documents that are not held out."""
    documents = table(spark, sf_dir, "documents")
    return identified(documents, kept(learnt(documents), "languages"))
