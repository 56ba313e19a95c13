"""Jaccard join of documents on word n-grams by universe partition and the pigeonhole principle.

Shingle hashes are dealt to the m segments of a size band. Sets of at least 0.8 similarity differ in H items at most,
so of more than H segments one is equal in both. A document writes the hash of each of its filled segments, under its
own band and under the next smaller one if it can have partners there. Of f filled segments f - H at least are equal
in a partner, so that the f - H - 1 most frequent can be spared. A document with H or fewer filled segments
also writes, in a space that only such documents share, all its filled segments (worth one each), the one-deletion
neighbours of those with two items or more (worth one more) and, if that is not above H yet, its empty segments.
Pairs are verified exactly.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewarden.llm.common import (
    BASE, INVERSE, Scratch, byte_table, joined_bytes, kept, known_id, mixed, node, powers, ranges, table, text_batches,
)
from tidewarden.llm.neardup import PACKED_SCHEMA, SHAPE_SCHEMA, linked_groups, pack_postings, shapes, shared_postings, verifier

WORDS = 5
PERCENT = 80
PER_SEGMENT = 3.6
BUCKET_SHINGLES = 200_000
_LETTERS = byte_table(5)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def shingles(column, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text (sorted, in one array) and the number of them per text.

    A-Z are lowered, words are cut at space and the controls 9 to 13. A text of fewer words has its whole sequence
    as one shingle, one without words has none.
    """
    data, offsets = joined_bytes(column)
    n = len(offsets) - 1
    # A space after every text keeps words apart.
    data = np.insert(data, offsets[1:], 32)
    offsets = offsets + np.arange(n + 1)
    data = _LOWER[data]
    space = _SPACE[data]
    start = np.flatnonzero(~space & np.r_[True, space[:-1]])
    end = np.flatnonzero(space & np.r_[False, ~space[:-1]])
    sums = np.concatenate([[np.uint64(0)], np.cumsum(_LETTERS[data] * powers(BASE, len(data)), dtype=np.uint64)])
    back = powers(INVERSE, len(data) + 1)
    word = mixed((sums[end] - sums[start]) * back[start] + (end - start).astype(np.uint64)) if len(start) else np.zeros(0, np.uint64)
    owner = np.searchsorted(offsets, start, side="right") - 1
    count = np.bincount(owner, minlength=n)
    first = np.cumsum(count) - count
    grams = np.where(count >= words, count - words + 1, np.minimum(count, 1))
    at = ranges(first, grams)
    doc = np.repeat(np.arange(n), grams)
    short = np.minimum(count, words)[doc]
    h = short.astype(np.uint64)
    for k in range(words):
        have = k < short
        h = np.where(have, mixed(h * np.uint64(BASE) + word[np.minimum(at + k, max(len(word) - 1, 0))]), h) if len(at) else h
    order = np.lexsort((h, doc))
    h, doc = h[order], doc[order]
    new = np.r_[True, (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])] if len(h) else np.zeros(0, bool)
    return h[new], np.bincount(doc[new], minlength=n)


def band_starts(largest: int) -> np.ndarray:
    """1, 2, 3, ...: each at least 5/4 of the one before, so similar sets lie in one band or in neighbours."""
    out = [1]
    while out[-1] <= largest:
        out.append(max(out[-1] + 1, -(-out[-1] * 5 // 4)))
    return np.array(out, dtype=np.int64)


def signatures(items: np.ndarray, sizes: np.ndarray):
    """(key, document, chosen) of all signatures of a batch of sets; similar sets share one that either of them chose."""
    return spared_signatures(items, sizes)[:3]


def spared_signatures(items: np.ndarray, sizes: np.ndarray):
    """(key, document, chosen, level, spare) of all signatures of a batch of sets (see the module).

    ``chosen`` are those of the H + 1 segments with the most items. Of a document's signatures of one level any
    ``spare`` can be left out; in the space of documents with few filled segments none.
    """
    starts = band_starts(int(sizes.max()) if len(sizes) else 1)
    band = np.searchsorted(starts, sizes, side="right") - 1
    doc = np.repeat(np.arange(len(sizes)), sizes)
    keys, docs, picks, levels, spares = [], [], [], [], []
    for step in (0, 1):
        level = band - step
        # Under the smaller band only if a partner of 0.8 of the size can be in it.
        use = (sizes > 0) & (level >= 0) & ((step == 0) | (5 * (starts[np.maximum(band, 0)] - 1) >= 4 * sizes))
        if not use.any():
            continue
        top = starts[np.minimum(np.maximum(level, 0) + 1, len(starts) - 1)] - 1
        # Partners under this band: the smaller of the two is at most ``top``.
        partner = np.where(step == 0, np.maximum(sizes * 5 // 4, sizes), top)
        allowed = (sizes + partner) // 9
        # The number of segments depends on the band alone.
        segments = np.maximum((top + top * 5 // 4) // 9 + 1, np.ceil(top / PER_SEGMENT).astype(np.int64))
        take = use[doc]
        x, d = items[take], doc[take]
        part = (mixed(x ^ np.uint64(0x5EED)) % segments[d].astype(np.uint64)).astype(np.int64)
        place = mixed(level.astype(np.uint64) * np.uint64(1 << 32) + np.uint64(7))[d] + part.astype(np.uint64) * np.uint64(BASE)
        group = d * (int(segments.max()) + 1) + part
        order = np.argsort(group, kind="stable")
        x, d, place, group, part = x[order], d[order], place[order], group[order], part[order]
        head = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
        count = np.diff(np.r_[head, len(group)])
        inside = np.add.reduceat(mixed(x), head)
        key, owner = mixed(inside ^ mixed(place[head])), d[head]
        filled = np.bincount(owner, minlength=len(sizes))
        # Most items first: the cheapest H + 1 segments are chosen.
        by_cost = np.lexsort((key, -count, owner))
        begin = np.cumsum(filled) - filled
        rank = np.empty(len(key), dtype=np.int64)
        rank[by_cost] = np.arange(len(key)) - begin[owner[by_cost]]
        keys.append(key)
        docs.append(owner)
        picks.append(rank <= allowed[owner])
        spares.append(np.maximum(filled - allowed - 1, 0)[owner])
        poor = use & (filled <= allowed)
        if poor.any():
            mine = poor[owner]
            tag = np.uint64(0xDEF1C17)
            keys.append(mixed(key[mine] ^ tag))
            docs.append(owner[mine])
            wide = count >= 2
            each = poor[d] & np.repeat(wide, count)
            less = np.repeat(inside, count) - mixed(x)
            keys.append(mixed(mixed(less ^ mixed(place)) ^ tag)[each])
            docs.append(d[each])
            worth = filled + np.bincount(owner[wide], minlength=len(sizes))
            for i in np.flatnonzero(poor & (worth <= allowed)).tolist():
                gone = np.setdiff1d(np.arange(segments[i]), part[d == i])
                where = mixed(level[i: i + 1].astype(np.uint64) * np.uint64(1 << 32) + np.uint64(7)) + gone.astype(np.uint64) * np.uint64(BASE)
                keys.append(mixed(mixed(mixed(where)) ^ tag))
                docs.append(np.full(len(gone), i))
            picks += [np.ones(len(k), dtype=bool) for k in keys[len(picks):]]
            spares += [np.zeros(len(k), dtype=np.int64) for k in keys[len(spares):]]
        levels += [np.full(len(k), step == 1) for k in keys[len(levels):]]
    if not keys:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, bool), np.zeros(0, np.int64)
    return tuple(np.concatenate(x) for x in (keys, docs, picks, levels, spares))


def _packed(buckets: int):
    def run(batches):
        import pyarrow as pa
        import pyarrow.compute as pc

        for batch in batches:
            for part in text_batches([batch], "text"):
                # Of copies in one batch the smallest id speaks for all; the others are linked to it as copies.
                part = pa.table(part).sort_by("doc_id").combine_chunks().to_batches()[0]
                coded = part.column(1).dictionary_encode().indices.to_numpy(zero_copy_only=False)
                part = part.take(pa.array(np.sort(np.unique(coded, return_index=True)[1])))
                items, sizes = shingles(part.column(1))
                keys, docs, _, level, spare = spared_signatures(items, sizes)
                ids = pc.cast(part.column(0), pa.int64()).to_numpy(zero_copy_only=False)
                yield pack_postings(keys, ids[docs], level, buckets, spare)
    return run


def _sets(texts) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, and the text that each belongs to."""
    items, sizes = shingles(texts)
    return items, np.repeat(np.arange(len(sizes)), sizes)


def _measured(batches):
    """(id, size, parities, digest) of each text; the size is the number of shingles."""
    import hashlib

    import pyarrow as pa

    for batch in batches:
        for part in text_batches([batch], "text"):
            digests = [hashlib.blake2b(t.encode(), digest_size=16).digest() for t in part.column(1).to_pylist()]
            yield shapes(part.column(0), *_sets(part.column(1))).append_column("digest", pa.array(digests, pa.binary()))


def jaccard_groups(documents: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id, n_copies, node, first_node) of every document.

    Documents link when 100 * intersection >= 80 * union of their shingle sets. Copies of a text are known by their
    digest and not compared. Null and wordless texts have no shingles and link with nothing. The smallest id
    stands for a component; a null id is never it, so a component of documents without an id has a null one. Rows that
    repeat an id and its text all get the result; different texts need different ids, below 2**62. ``first_node``
    is the node (see :func:`node`) that stands for the component. Empty input gives no rows; other columns are not read.
    """
    if percent != PERCENT:
        raise ValueError("bands and segments are laid out for a similarity of 0.8")
    plain = documents.select(node().alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    scratch, held = Scratch(), Scratch()
    measured = held.kept(plain.mapInArrow(_measured, f"{SHAPE_SCHEMA}, digest binary").select(
        F.col("id").alias("doc_id"), "digest", F.col("size").cast("long").alias("n_shingles"), "parities"), "measured")
    total = measured.agg(F.coalesce(F.sum("n_shingles"), F.lit(0))).first()[0]
    several = measured.where("n_shingles > 0").groupBy("digest").agg(F.min("doc_id").alias("first"), F.count("*").alias("n_copies")).where("n_copies > 1")
    several = held.kept(several, "copied")
    facts = kept(measured.select("doc_id", "digest", "n_shingles").join(several, "digest", "left").drop("digest"), "facts")
    buckets = max(1, int(total) // BUCKET_SHINGLES)
    postings = shared_postings(plain.mapInArrow(_packed(buckets), PACKED_SCHEMA), scratch)

    def rows_of(ids: DataFrame, frame: DataFrame) -> DataFrame:
        return frame.join(ids.select(F.col("id").alias("doc_id")), "doc_id", "left_semi")

    groups = linked_groups(
        postings,
        lambda ids: rows_of(ids, measured).groupBy(F.col("doc_id").alias("id")).agg(
            F.first("n_shingles").cast("int").alias("size"), F.first("parities").alias("parities")),
        lambda ids: scratch.bucketed(rows_of(ids, plain).groupBy(F.col("doc_id").alias("id")).agg(F.first("text").alias("items")), "texts", "id"),
        lambda pairs: pairs.mapInArrow(verifier(percent, _sets), "a long, b long"),
        percent, scratch, facts.where("first < doc_id").select(F.col("first").alias("a"), F.col("doc_id").alias("b")),
        sparing=True)
    held.drop_all()
    placed = facts.join(groups.withColumnRenamed("id", "doc_id"), "doc_id", "left").withColumn(
        "first_node", F.coalesce("component", "doc_id"))
    return placed.select(
        known_id("doc_id").alias("doc_id"), "n_shingles", known_id("first_node").alias("component_id"),
        F.coalesce("n_copies", F.lit(1)).alias("n_copies"), F.col("doc_id").alias("node"), "first_node")


def one_of_each_group(documents: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Of every group of similar documents one, that with the smallest id; all columns are kept.

    Of rows that repeat an id one stays. A document without an id stays if its group has none with one.
    """
    firsts = jaccard_groups(documents, percent).where("node = first_node").select("node").distinct()
    own = documents.select(node().alias("node"), F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("document"))
    met = own.join(firsts, "node", "left_semi")
    once = met.withColumn("nth", F.row_number().over(Window.partitionBy("node").orderBy("node"))).where("nth = 1")
    return once.select("document.*")


def op5_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shingles and component of every document."""
    return jaccard_groups(table(spark, sf_dir, "documents")).drop("node", "first_node")
