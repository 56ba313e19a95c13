"""Lexical retrieval packing.

Documents are dealt to shards of a few megabytes. A shard builds a BM25 inverted index over its token ids; a seed
document fills a window, and its best unused neighbours follow until the window is full. A document that does not fit
is cut there and seeds the next window. What remains of a shard is cut at powers of two, so nothing is padded.
"""

from __future__ import annotations

import functools
import itertools
import os
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewarden.llm.common import ranges, table

TOKENIZER = "word_bpe_49k.json"
WINDOW = 2048
END_ID = 1
SHARD_BYTES = 1 << 20
QUERY_TERMS = 24
K1, B = 1.2, 0.75
CACHE_WORDS = 300_000
SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


@functools.cache
def _worker(path: str):
    # A task has one core: the tokenizer's own threads would only wait for each other.
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path), {}


def encode(texts: list[str], path: str, end_id: int = END_ID) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts, each closed by ``end_id``, in one array, and the n + 1 offsets.

    The vocabulary drops white space, so runs without ASCII white space are encoded alone, the distinct ones once.
    """
    import pyarrow as pa
    import pyarrow.compute as pc

    tokenizer, known = _worker(path)
    if len(known) > CACHE_WORDS:
        known.clear()
    split = pc.ascii_split_whitespace(pa.array(texts, pa.large_string()))
    counts = pc.list_value_length(split).to_numpy(zero_copy_only=False).astype(np.int64)
    coded = split.flatten().dictionary_encode()
    if isinstance(coded, pa.ChunkedArray):
        coded = coded.combine_chunks()
    words = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
    new = [w for w in words if w not in known]
    known.update(zip(new, (e.ids for e in tokenizer.encode_batch_fast(new, add_special_tokens=False))))
    used = [known[w] for w in words]
    lengths = np.fromiter(map(len, used), dtype=np.int64, count=len(used))
    flat = np.fromiter(itertools.chain.from_iterable(used), dtype=np.uint32, count=int(lengths.sum()))
    starts = np.cumsum(lengths) - lengths
    codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    tokens = flat[ranges(starts[codes], lengths[codes])] if len(codes) else flat
    sums = np.concatenate([[0], np.cumsum(lengths[codes])])
    ends = sums[np.cumsum(counts)]
    ids = np.insert(tokens, ends, end_id).astype("<u4")
    return ids, np.concatenate([[0], ends + np.arange(1, len(texts) + 1)])


class Index:
    """BM25 inverted index of the documents of a shard, over token ids."""

    def __init__(self, ids: np.ndarray, offsets: np.ndarray):
        n = len(offsets) - 1
        owner = np.repeat(np.arange(n), np.diff(offsets))
        key, tf = np.unique((ids.astype(np.int64) << 32) | owner, return_counts=True)
        term, self.doc = key >> 32, (key & 0xFFFFFFFF).astype(np.int64)
        self.terms, first = np.unique(term, return_index=True)
        self.first = np.append(first, len(term))
        df = np.diff(self.first)
        idf = np.log1p((n - df + 0.5) / (df + 0.5))
        length = np.diff(offsets)[self.doc]
        mean = max(1.0, len(ids) / max(n, 1))
        self.weight = np.repeat(idf, df) * tf * (K1 + 1) / (tf + K1 * (1 - B + B * length / mean))
        self.weight[np.repeat(df < 2, df)] = 0  # a term of one document finds nobody
        # The heaviest terms of each document are its query.
        order = np.lexsort((term, -self.weight, self.doc))
        begin = np.searchsorted(self.doc[order], np.arange(n + 1))
        slot = np.repeat(np.arange(len(self.terms)), df)
        self.query = [slot[order[a: min(b, a + QUERY_TERMS)]] for a, b in zip(begin[:-1], begin[1:])]
        self.n = n
        self.latest: tuple[int, np.ndarray] = (-1, np.zeros(0, dtype=np.int64))

    def neighbours(self, seed: int) -> np.ndarray:
        """Documents that share a query term with the seed, best first, ties by place."""
        if self.latest[0] != seed:
            self.latest = (seed, self._ranked(seed))
        return self.latest[1]

    def _ranked(self, seed: int) -> np.ndarray:
        slots = self.query[seed]
        counts = self.first[slots + 1] - self.first[slots]
        at = ranges(self.first[slots], counts)
        score = np.bincount(self.doc[at], weights=self.weight[at], minlength=self.n)
        score[seed] = 0
        found = np.flatnonzero(score > 0)
        return found[np.lexsort((found, -score[found]))]


def retrieval_order(index: Index, lengths: np.ndarray, window: int = WINDOW):
    """Documents in packing order: a seed, then its unused neighbours while the window lasts."""
    used = np.zeros(index.n, dtype=bool)
    fill, nxt, seed = 0, 0, -1
    while True:
        if seed < 0:
            while nxt < index.n and used[nxt]:
                nxt += 1
            if nxt == index.n:
                return
            seed = nxt
            used[seed] = True
            yield seed
            fill += lengths[seed]
        last, crossed = seed, fill >= window
        fill %= window
        if not crossed or fill:
            for d in index.neighbours(seed):
                if used[d]:
                    continue
                used[d] = True
                yield int(d)
                last = int(d)
                fill += lengths[d]
                if fill >= window:
                    break
        # The document that crossed the edge seeds the next window; else the next unused one does.
        seed = last if fill >= window and fill % window else -1
        fill %= window
        if seed >= 0 and not len(index.neighbours(seed)):
            seed = -1


def sequences(total: int, window: int = WINDOW) -> list[int]:
    """Lengths that add up to ``total``: full windows, then powers of two, largest first."""
    full, rest = divmod(total, window)
    out, power = [window] * full, 1
    tail = []
    while rest:
        if rest & 1:
            tail.append(power)
        rest >>= 1
        power <<= 1
    return out + tail[::-1]


def pack_shard(shard: int, doc_ids: list, texts: list[str], path: str, window: int = WINDOW,
               with_ids: bool = True) -> dict[str, list]:
    """Pieces of one shard in order: every id in exactly one piece."""
    ids, offsets = encode(texts, path)
    lengths = np.diff(offsets)
    out: dict[str, list] = {k.split()[0]: [] for k in SCHEMA.split(", ")}
    held: list[np.ndarray] = []
    limits = sequences(int(len(ids)), window)
    place, room, filled = 0, limits[0], 0
    for d in retrieval_order(Index(ids, offsets), lengths, window):
        start, n = 0, int(lengths[d])
        while start < n:
            take = min(n - start, room - filled)
            piece = ids[offsets[d] + start: offsets[d] + start + take]
            for name, value in zip(out, (doc_ids[d], start, take, zlib.crc32(piece.tobytes()), n,
                                         (shard << 32) | place, filled)):
                out[name].append(value)
            if with_ids:
                held.append(piece.astype(np.int32))
            start += take
            filled += take
            if filled == room and place + 1 < len(limits):
                place, room, filled = place + 1, limits[place + 1], 0
    return out | {"ids": held} if with_ids else out


def packed(documents: DataFrame, path: str, window: int = WINDOW, shard_bytes: int = SHARD_BYTES,
           with_ids: bool = True) -> DataFrame:
    """Pieces (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, ids) of all documents.

    ``with_ids=False`` leaves the last column out.

    A null text is an empty one: its end id alone. Empty input gives no rows; repeated rows are packed each; a null
    id stays null. Documents are dealt to shards by a hash of id and text, one shard per ``shard_bytes`` of text; a
    task holds one shard, or one longer document. Other columns are not read.
    """
    plain = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    total = plain.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).cast("long")).first()[0]
    shards = max(1, -(-total // shard_bytes))
    dealt = plain.withColumn("shard", F.pmod(F.xxhash64("doc_id", F.length("text")), F.lit(shards)))

    def pack(key, frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["doc_id", "text"], kind="stable")
        ids = [None if pd.isna(x) else int(x) for x in frame["doc_id"]]
        out = pd.DataFrame(pack_shard(int(key[0]), ids, frame["text"].tolist(), path, window, with_ids))
        return out.astype({"doc_id": "Int64"})

    return dealt.groupBy("shard").applyInPandas(pack, SCHEMA + ", ids array<int>" if with_ids else SCHEMA)


def op8_retrieval_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where every piece of every document lies."""
    import public_tokenizers

    return packed(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), with_ids=False)
