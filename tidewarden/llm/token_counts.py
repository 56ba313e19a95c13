"""Token counts of a byte-level BPE by rank-synchronous merging of arrays.

Texts are cut into pre-tokens by the tokenizer's pattern. The distinct ones of a batch are held as ragged numpy
arrays of symbols; each round applies to every pre-token all occurrences of its own lowest-rank pair at once.
What survives is counted and summed per text.
"""

from __future__ import annotations

import functools
import json

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewarden.llm.common import table, text_batches

TOKENIZER = "byte_bpe_50k.json"
LIMIT = 512
CACHE_WORDS = 400_000


def byte_letters() -> dict[int, str]:
    """Letter of each byte in byte-level vocabularies: printable Latin-1 stands for itself, the rest follow from 256."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class PairTable:
    """Merges as sorted arrays: pair of symbols -> rank and merged symbol."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        letters = byte_letters()
        self.first = np.array([vocab[letters[b]] for b in range(256)], dtype=np.int64)
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        pairs = np.array([(vocab[a] << 32) | vocab[b] for a, b in merges], dtype=np.int64)
        order = np.argsort(pairs, kind="stable")
        self.pairs, self.ranks = pairs[order], order
        self.merged = np.array([vocab[a + b] for a, b in merges], dtype=np.int64)
        self.special = [t["content"] for t in spec["added_tokens"]]

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, or the number of merges where there is none."""
        wanted = (left << 32) | right
        at = np.minimum(np.searchsorted(self.pairs, wanted), len(self.pairs) - 1)
        return np.where(self.pairs[at] == wanted, self.ranks[at], len(self.pairs))


def merged_counts(data: np.ndarray, lengths: np.ndarray, pairs: PairTable) -> np.ndarray:
    """Symbols left of each pre-token, given their bytes in one buffer."""
    none = len(pairs.pairs)
    out = lengths.astype(np.int64).copy()
    owner = np.repeat(np.arange(len(lengths)), lengths)
    symbols = pairs.first[data]
    ranks = np.full(len(symbols), none, dtype=np.int64)
    if len(symbols) > 1:
        ranks[:-1] = pairs.rank(symbols[:-1], symbols[1:])
        ranks[:-1][owner[:-1] != owner[1:]] = none
    while len(symbols):
        starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
        counts = np.diff(np.r_[starts, len(owner)])
        low = np.minimum.reduceat(ranks, starts)
        live = low < none
        out[owner[starts[~live]]] = counts[~live]
        if not live.any():
            break
        keep = np.repeat(live, counts)
        symbols, ranks, owner = symbols[keep], ranks[keep], owner[keep]
        low = np.repeat(low[live], counts[live])
        hit = ranks == low
        # Of overlapping occurrences ("aaa") the first, third, ... are merged.
        run = np.flatnonzero(hit[1:] & hit[:-1]) + 1
        if len(run):
            at = np.flatnonzero(hit)
            first = np.r_[True, np.diff(at) > 1]
            begin = np.maximum.accumulate(np.where(first, at, 0))
            hit[at[(at - begin) % 2 == 1]] = False
        symbols[hit] = pairs.merged[low[hit]]
        gone = np.r_[False, hit[:-1]]
        left = ~gone
        # Pairs next to a merge change: recompute those of merged symbols and of the symbols before them.
        symbols, ranks, owner, hit = symbols[left], ranks[left], owner[left], hit[left]
        touched = np.flatnonzero(hit | np.r_[hit[1:], False])
        nxt = np.minimum(touched + 1, len(symbols) - 1)
        fresh = pairs.rank(symbols[touched], symbols[nxt])
        fresh[(touched == nxt) | (owner[touched] != owner[nxt])] = none
        ranks[touched] = fresh
    return out


@functools.cache
def _worker(path: str):
    import public_tokenizers
    import regex

    pairs = PairTable(path)
    special = regex.compile("|".join(map(regex.escape, pairs.special))) if pairs.special else None
    return pairs, regex.compile(public_tokenizers.PATTERN), special, {}


def count_tokens(texts: list[str], path: str) -> np.ndarray:
    """Tokens of each text. Special strings count as one token each, wherever they stand, as the library has it."""
    pairs, pattern, special, cache = _worker(path)
    if len(cache) > CACHE_WORDS:
        cache.clear()
    words, counts, extra = [], np.zeros(len(texts), dtype=np.int64), np.zeros(len(texts), dtype=np.int64)
    for i, text in enumerate(texts):
        found = 0
        if special and special.search(text):
            parts = special.split(text)
            extra[i] = len(parts) - 1
            for part in parts:
                own = pattern.findall(part)
                words += own
                found += len(own)
        else:
            own = pattern.findall(text)
            words += own
            found = len(own)
        counts[i] = found
    new = [w for w in set(words) if w not in cache]
    if new:
        data = [w.encode() for w in new]
        lengths = np.fromiter(map(len, data), dtype=np.int64, count=len(data))
        left = merged_counts(np.frombuffer(b"".join(data), dtype=np.uint8), lengths, pairs)
        cache.update(zip(new, left.tolist()))
    sums = np.concatenate([[0], np.cumsum(np.fromiter(map(cache.__getitem__, words), dtype=np.int64, count=len(words)))])
    ends = np.cumsum(counts)
    return sums[ends] - sums[ends - counts] + extra


def token_counts(documents: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of whole texts, a null text counting as empty.

    One pass, no shuffle; a batch holds a few megabytes of text, or one longer text. Other columns are not read.
    """

    def counted(batches):
        import pyarrow as pa

        for batch in batches:
            for part in text_batches([batch], "text", 2 << 20):
                ids, texts = part.column(0), part.column(1).to_pylist()
                n = count_tokens(texts, path)
                sizes = [len(t.encode()) for t in texts]
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(sizes, pa.int64()), pa.array(n, pa.int64()), pa.array(n > limit, pa.bool_())],
                    names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).mapInArrow(
        counted, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every document."""
    import public_tokenizers

    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))
