"""Removal of long byte strings that occur more than once, by suffix sorting in blocks.

The block of a suffix is decided by its content: the 64-byte string of least hash among those in its first 400 bytes
(its anchor), which is the same wherever the 400 bytes occur. Suffixes whose anchor occurs once are unique and never
sorted. For the others the snippets around their anchors are brought together, one copy of each, and sorted block by
block (see :mod:`tidewarden.llm.suffixes`).
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewarden.llm.common import Rolling, byte_table, joined_bytes, kept, known_id, mixed, node, ranges, table, text_batches
from tidewarden.llm.suffixes import repeated_starts

LENGTH = 400
GRAM = 64
BLOCK_BYTES = 1 << 20
PIECE = 4 << 20
# Snippets of an anchor beyond which its suffixes are counted one by one instead of sorted in one block.
HOT_SNIPPETS = 512
_LETTERS = byte_table(23)
_PLACE_BITS = np.uint64(23)


def anchor_runs(data: np.ndarray, begin: np.ndarray, end: np.ndarray, length: int = LENGTH, gram: int = GRAM):
    """Runs (piece, lo, hi, key, snippet, many) of suffix starts with one anchor key, places counted from each piece's begin.

    Pieces are parts [begin, end) of ``data``; a start needs ``length`` bytes. ``snippet`` is a hash of the bytes
    [lo, hi + length). ``many``: the anchor occurs at several places of the run, so the run may repeat itself.
    """
    width = length - gram + 1
    empty = np.zeros(0, np.int64)
    if len(data) < length:
        return empty, empty, empty, empty.astype(np.uint64), empty.astype(np.uint64), empty.astype(bool)
    roll = Rolling(data, _LETTERS)
    grams = roll.windows(np.arange(len(data) - gram + 1), gram)
    low = (np.uint64(1) << _PLACE_BITS) - np.uint64(1)
    value = (grams & ~low) | np.arange(len(grams), dtype=np.uint64)
    # Least of every window of ``width`` values: from running minima of blocks, forwards and backwards.
    blocks = -(-len(value) // width)
    padded = np.full(blocks * width, np.uint64(2**64 - 1))
    padded[: len(value)] = value
    padded = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(padded, axis=1).ravel()
    behind = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    n = len(data) - length + 1
    anchor = (np.minimum(behind[:n], ahead[width - 1: width - 1 + n]) & low).astype(np.int64)
    counts = np.maximum(end - begin - length + 1, 0)
    starts = ranges(begin, counts)
    if not len(starts):
        return empty, empty, empty, empty.astype(np.uint64), empty.astype(np.uint64), empty.astype(bool)
    piece = np.repeat(np.arange(len(begin)), counts)
    key = grams[anchor[starts]]
    head = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (piece[1:] != piece[:-1])])
    last = np.r_[head[1:], len(starts)] - 1
    many = anchor[starts[head]] != anchor[starts[last]]
    lo, hi, piece = starts[head], starts[last], piece[head]
    size = hi - lo + length
    return piece, lo - begin[piece], hi - begin[piece], key[head], mixed(roll.windows(lo, size) ^ size.astype(np.uint64)), many


def _pieces(offsets: np.ndarray, length: int):
    """Texts cut so that the places of a batch fit their bits: (text, place in it, begin, end); overlaps hide no start."""
    out = []
    for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
        if b - a >= length:
            for s in range(a, b - length + 1, PIECE):
                out.append((i, s - a, s, min(b, s + PIECE + length - 1)))
    return out


def _anchors(length: int):
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for part in text_batches([batch], "text", 3 << 20):
                data, offsets = joined_bytes(part.column(1))
                pieces = _pieces(offsets, length)
                ids = part.column(0)
                # A longer text goes through in windows of its own.
                groups = [pieces] if len(data) < PIECE else [[p] for p in pieces]
                for group in groups:
                    if not group:
                        continue
                    text, shift, begin, end = (np.array(x, dtype=np.int64) for x in zip(*group))
                    base = begin[0]
                    piece, lo, hi, key, snippet, many = anchor_runs(data[base: end[-1]], begin - base, end - base, length)
                    move = shift[piece]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(key.view(np.int64)), pa.array(snippet.view(np.int64)), ids.take(pa.array(text[piece])),
                         pa.array(lo + move), pa.array(hi + move), pa.array(many)],
                        names=["key", "snippet", "doc_id", "lo", "hi", "many"])
    return run


def _snippets(length: int):
    """Bytes of the wanted runs of each text: (key, known, doc_id, lo, bytes)."""
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for part in text_batches([batch], "text"):
                out = []
                for doc, text, runs in zip(*(part.column(i).to_pylist() for i in range(3))):
                    data = text.encode()
                    out += [(r["key"], r["known"], doc, r["lo"], data[r["lo"]: r["hi"] + length]) for r in runs]
                for a in range(0, len(out), 5000):
                    columns = list(zip(*out[a: a + 5000]))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.binary()))],
                        names=["key", "known", "doc_id", "lo", "bytes"])
    return run


def _runs_of(doc: np.ndarray, place: np.ndarray):
    """Maximal runs (doc, lo, hi) of consecutive places."""
    order = np.lexsort((place, doc))
    doc, place = doc[order], place[order]
    head = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (place[1:] != place[:-1] + 1)]) if len(doc) else np.zeros(0, int)
    last = np.r_[head[1:], len(doc)] - 1 if len(doc) else head
    return doc[head], place[head], place[last]


def _sorted_block(length: int):
    def run(table):
        import pyarrow as pa

        data, offsets = joined_bytes(table["bytes"].combine_chunks())
        counts = np.diff(offsets) - length + 1
        owner = np.repeat(np.arange(len(counts)), counts)
        found = repeated_starts(data, ranges(offsets[:-1], counts), length)
        owner = np.searchsorted(offsets, found, side="right") - 1
        fresh = ~table["known"].to_numpy()[owner]
        found, owner = found[fresh], owner[fresh]
        doc, lo, hi = _runs_of(table["doc_id"].to_numpy()[owner], table["lo"].to_numpy()[owner] + found - offsets[owner])
        return pa.table({"doc_id": pa.array(doc, pa.int64()), "lo": pa.array(lo, pa.int64()), "hi": pa.array(hi, pa.int64())})
    return run


def _start_hashes(length: int):
    """One row per start of hot snippets: (key, window, doc_id, lo)."""
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for part in text_batches([batch], "bytes", 1 << 20):
                data, offsets = joined_bytes(part.column(4))
                counts = np.diff(offsets) - length + 1
                owner = np.repeat(np.arange(len(counts)), counts)
                at = ranges(offsets[:-1], counts)
                window = Rolling(data, _LETTERS).windows(at, length)
                take = pa.array(owner)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(take), pa.array(window.view(np.int64)), part.column(2).take(take),
                     pa.array(part.column(3).to_numpy()[owner] + at - offsets[owner])], names=["key", "window", "doc_id", "lo"])
    return run


def _cut(length: int):
    """What is left of each text without the bytes that its runs cover."""
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for part in text_batches([batch], "text"):
                out = []
                for doc, text, runs in zip(*(part.column(i).to_pylist() for i in range(3))):
                    data = text.encode()
                    spans, rest, at = [], [], 0
                    for lo, hi in sorted((r["lo"], r["hi"] + length) for r in runs or ()):
                        if spans and lo <= spans[-1][1]:
                            spans[-1][1] = max(spans[-1][1], hi)
                        else:
                            spans.append([lo, hi])
                    for lo, hi in spans:
                        rest.append(data[at:lo])
                        at = hi
                    left = b"".join([*rest, data[at:]])
                    out.append((doc, len(data), len(data) - len(left), len(spans), hashlib.sha256(left).hexdigest(), left, [x for s in spans for x in s]))
                types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.list_(pa.int64()))
                names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_bytes", "spans"]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)
    return run


CUT_SCHEMA = ("doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept_bytes binary, "
              "spans array<long>")


def repeated_runs(documents: DataFrame, length: int = LENGTH) -> DataFrame:
    """(doc_id, lo, hi): starts lo to hi of ``length``-byte strings that start elsewhere too; ids are nodes of the documents."""
    plain = documents.select(node().alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    anchors = kept(plain.mapInArrow(_anchors(length), "key long, snippet long, doc_id long, lo long, hi long, many boolean"), "anchors")
    # An anchor at one place leaves nothing to compare.
    seen = kept(anchors.groupBy("key").agg(F.count("*").alias("n"), F.max("many").alias("many")).where("n > 1 or many").select("key"), "anchor-keys")
    shared = kept(anchors.join(seen, "key", "left_semi"), "shared-anchors")
    classes = kept(shared.groupBy("key", "snippet").agg(
        F.count("*").alias("n"), F.min(F.struct("doc_id", "lo", "hi")).alias("one"), F.max("many").alias("many")), "snippets")
    kinds = kept(classes.groupBy("key").agg(F.count("*").alias("kinds"), F.max("many").alias("itself")), "anchor-kinds")
    # Every start of a snippet that occurs twice is repeated.
    twice = shared.join(classes.where("n > 1").select("key", "snippet"), ["key", "snippet"], "left_semi").select("doc_id", "lo", "hi")
    wanted = classes.join(kinds, "key").where("kinds > 1 or itself").select(
        F.col("one.doc_id").alias("d"),
        F.struct("key", "one.lo", "one.hi", (F.col("n") > 1).alias("known")).alias("run"))
    wanted = wanted.groupBy("d").agg(F.collect_list("run").alias("runs"))
    pieces = kept(plain.join(wanted, F.col("doc_id") == F.col("d")).select("doc_id", "text", "runs").mapInArrow(
        _snippets(length), "key long, known boolean, doc_id long, lo long, bytes binary"), "snippet-bytes")
    hot = kept(kinds.where(f"kinds > {HOT_SNIPPETS}").select("key"), "hot-anchors")
    total = pieces.agg(F.coalesce(F.sum(F.octet_length("bytes")), F.lit(0))).first()[0]
    blocks = max(1, total // BLOCK_BYTES)
    cold = pieces.join(hot, "key", "left_anti").withColumn("block", F.pmod(F.xxhash64("key"), F.lit(blocks)))
    sorted_ = cold.groupBy("block").applyInArrow(_sorted_block(length), "doc_id long, lo long, hi long")
    each = kept(pieces.join(hot, "key", "left_semi").mapInArrow(_start_hashes(length), "key long, window long, doc_id long, lo long"), "hot-starts")
    again = kept(each.groupBy("key", "window").count().where("count > 1").select("key", "window"), "hot-windows")
    counted = each.join(again, ["key", "window"], "left_semi").select("doc_id", "lo", F.col("lo").alias("hi"))
    return twice.unionByName(sorted_).unionByName(counted)


def without_repeats(documents: DataFrame, length: int = LENGTH) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept_bytes, spans) of every document.

    A byte goes if it lies in a ``length``-byte string of the UTF-8 text that starts anywhere else in the corpus, in
    the same text too; all strings are judged on the input. Null texts are empty; shorter ones stay whole. Spans are
    begin and end of the removed runs, in pairs. Cuts may split a character: the rest is bytes. Rows
    that repeat an id and its text are copies of each other, also without an id; different texts need different
    ids, below 2**62. Empty input gives no rows; other columns are not read.
    """
    plain = documents.select(node().alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    runs = kept(repeated_runs(documents, length), "repeated-runs").groupBy(F.col("doc_id").alias("d")).agg(
        F.collect_list(F.struct("lo", "hi")).alias("runs"))
    cut = plain.join(runs, F.col("doc_id") == F.col("d"), "left").select("doc_id", "text", "runs").mapInArrow(_cut(length), CUT_SCHEMA)
    return cut.withColumn("doc_id", known_id("doc_id"))


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes, removed bytes and runs, and the digest of the rest, of every document."""
    return without_repeats(table(spark, sf_dir, "documents")).drop("kept_bytes", "spans")
