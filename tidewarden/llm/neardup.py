"""Groups of similar sets from shared signatures: central members first, then only what they left open.

Both near-duplicate operators write postings (key, id): one of the signatures of ``id`` is ``key``; two sets are
candidates when they share a key. Where similar sets must share several keys, all but one of the most frequent of them
can be spared: a set leaves out its ``spare`` most frequent keys, in an order that is the same for all sets, and the
rarest key that two similar sets share is left in both. All pairs of a key would grow with the square
of a group of near copies. Instead every member is compared with a central one. A key whose members are then all known
to be of one component has nothing left to say; only members not known to be connected are compared with each other.
The components are those of all links.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewarden.llm.common import Scratch, components, text_batches

POSTING_SCHEMA = "key long, id long, level boolean, spare int, weight int"
# Words of 64 parity bits each.
PARITIES = 16
SHAPE_SCHEMA = "id long, size int, parities array<long>"
PACKED_SCHEMA = "bucket int, packed binary"
# Entries of one key that one batch packs; the rest of them go unpacked, so that a bucket stays small.
LOCALLY_HOT = 64
# Bucket number of postings known to be shared.
HOT = -1
# Weight of every posting of a key that is hot in some batch; other keys weigh as many postings as they have.
HOT_WEIGHT = 4096
# A posting's last byte: how many keys its set can spare, and whether the key is hot in the batch.
MOST_SPARED = 127
_HOT_BIT = np.uint8(128)


def _blob(keys: np.ndarray, ids: np.ndarray, marks: np.ndarray) -> bytes:
    """Keys, ids as 4-byte distances from the smallest where they fit, then a byte each."""
    low = int(ids.min())
    width = 4 if int(ids.max()) - low < 1 << 32 else 8
    far = (ids - low).astype("<u4") if width == 4 else ids.astype("<i8")
    return np.array([low, width], dtype="<i8").tobytes() + keys.astype("<u8").tobytes() + far.tobytes() + marks.tobytes()


def _unblob(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    low, width = np.frombuffer(blob, "<i8", 2).tolist()
    n = (len(blob) - 16) // (9 + width)
    keys = np.frombuffer(blob, "<u8", n, 16)
    ids = np.frombuffer(blob, "<u4" if width == 4 else "<i8", n, 16 + 8 * n).astype(np.int64)
    return keys, ids + low if width == 4 else ids


def _marks(blob: bytes) -> np.ndarray:
    width = int(np.frombuffer(blob, "<i8", 1, 8)[0])
    n = (len(blob) - 16) // (9 + width)
    return np.frombuffer(blob, np.uint8, n, len(blob) - n)


def parities(items: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """Of each of n sets whether it has an odd number of items, for each of 64 * :data:`PARITIES` classes, as bits in a row per set.

    An item that one of two sets lacks changes one bit: sets differ in as many items at least as in bits.
    """
    bits = np.uint64(64 * PARITIES)
    place = (items >> np.uint64(20)) % bits
    out = np.zeros(n * PARITIES, dtype=np.uint64)
    np.bitwise_xor.at(out, owner * PARITIES + (place >> np.uint64(6)).astype(np.int64), np.uint64(1) << (place & np.uint64(63)))
    return out.view(np.int64).reshape(n, PARITIES)


def pack_postings(keys: np.ndarray, ids: np.ndarray, level: np.ndarray, buckets: int, spare: np.ndarray | None = None):
    """Postings of a batch as an Arrow batch (bucket, packed), one row per bucket of keys.

    The lowest bit of a packed key is the ``level``: of the keys of one id and level ``spare`` can be left out, none
    by default. A key with more than :data:`LOCALLY_HOT` entries in the batch leaves two of them in its bucket, to be
    seen there, and the others as postings already known to be shared.
    """
    import pyarrow as pa

    keys = (keys & ~np.uint64(1)) | level.astype(np.uint64)
    order = np.argsort(keys, kind="stable")
    keys, ids = keys[order], ids[order]
    marks = np.zeros(len(keys), np.uint8) if spare is None else np.clip(spare[order], 0, MOST_SPARED).astype(np.uint8)
    bare = keys >> np.uint64(1)
    starts = np.flatnonzero(np.r_[True, bare[1:] != bare[:-1]]) if len(keys) else np.zeros(0, int)
    counts = np.diff(np.r_[starts, len(keys)])
    # Leave one from either end.
    place = np.arange(len(keys)) - np.repeat(starts, counts)
    hot = np.repeat(counts > LOCALLY_HOT, counts)
    marks |= np.where(hot, _HOT_BIT, np.uint8(0))
    loose = hot & (place > 0) & (place < np.repeat(counts, counts) - 1)
    bucket = np.where(loose, HOT, (keys >> np.uint64(40)).astype(np.int64) % buckets)
    order = np.argsort(bucket, kind="stable")
    keys, ids, marks, bucket = keys[order], ids[order], marks[order], bucket[order]
    cuts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]) if len(keys) else np.zeros(0, int)
    numbers, blobs = [], []
    for a, b in zip(cuts, np.r_[cuts[1:], len(keys)]):
        for c in range(a, b, 100_000):
            numbers.append(int(bucket[a]))
            part = slice(c, min(b, c + 100_000))
            blobs.append(_blob(keys[part], ids[part], marks[part]))
    return pa.RecordBatch.from_arrays([pa.array(numbers, pa.int32()), pa.array(blobs, pa.binary())], names=["bucket", "packed"])


def _shared(table):
    """Of one bucket: the postings whose key another id has too, with the key's weight: it is the same for all of them."""
    import pyarrow as pa

    blobs = [x.as_py() for x in table.column("packed")]
    parts = [_unblob(x) for x in blobs]
    keys, ids, marks = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]), np.concatenate([_marks(x) for x in blobs])
    level = (keys & np.uint64(1)).astype(bool)
    keys = keys >> np.uint64(1)
    weight = np.full(len(keys), HOT_WEIGHT)
    if table.column("bucket")[0].as_py() != HOT:
        order = np.lexsort((ids, keys))
        keys, ids, level, marks = keys[order], ids[order], level[order], marks[order]
        starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        counts = np.diff(np.r_[starts, len(keys)])
        take = np.repeat(ids[starts] != ids[starts + counts - 1], counts)
        heavy = np.where(np.bitwise_or.reduceat(marks, starts) & _HOT_BIT, HOT_WEIGHT, counts)
        keys, ids, level, marks, weight = keys[take], ids[take], level[take], marks[take], np.repeat(heavy, counts)[take]
    return pa.table([pa.array(keys.view(np.int64)), pa.array(ids), pa.array(level), pa.array((marks & ~_HOT_BIT).astype(np.int32)),
                     pa.array(weight.astype(np.int32))], names=["key", "id", "level", "spare", "weight"])


def shared_postings(packed: DataFrame, scratch: Scratch) -> DataFrame:
    """Postings (key, id, level, spare, weight) of keys that at least two ids have, from (bucket, packed). Stored.

    Keys are hashes, so buckets are even; hot entries are spread over tasks by a salt.
    """
    salt = F.when(F.col("bucket") < 0, F.pmod(F.xxhash64("packed"), F.lit(4096))).otherwise(0)
    grouped = packed.where(f"bucket >= {HOT}").withColumn("salt", salt).groupBy("bucket", "salt")
    return scratch.kept(grouped.applyInArrow(_shared, POSTING_SCHEMA), "postings")


def shapes(ids, items: np.ndarray, owner: np.ndarray):
    """Arrow batch of :data:`SHAPE_SCHEMA`: the number of items and the parities of the set of each id."""
    import pyarrow as pa

    n = len(ids)
    ends = np.arange(n + 1, dtype=np.int32)
    return pa.RecordBatch.from_arrays(
        [ids, pa.array(np.bincount(owner, minlength=n).astype(np.int32)),
         pa.ListArray.from_arrays(pa.array(ends * PARITIES), pa.array(parities(items, owner, n).ravel()))], names=["id", "size", "parities"])


def verifier(percent: int, sets: Callable):
    """Pairs (a, b) of those with texts x and y whose sets have 100 * intersection >= percent * union.

    ``sets`` gives the distinct items of each text and the text that each item belongs to.
    """
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for part in text_batches([batch], "x", 1 << 20):
                n = part.num_rows
                x, own_x = sets(part.column("x"))
                y, own_y = sets(part.column("y"))
                # An item that a pair has in both texts comes twice among the pair's items.
                items, pair = np.concatenate([x, y]), np.concatenate([own_x, own_y])
                order = np.lexsort((items, pair))
                items, pair = items[order], pair[order]
                twice = (items[1:] == items[:-1]) & (pair[1:] == pair[:-1])
                common = np.bincount(pair[1:][twice], minlength=n)
                union = np.bincount(pair, minlength=n) - common
                ok = pa.array(100 * common >= percent * union)
                yield pa.RecordBatch.from_arrays([part.column("a").filter(ok), part.column("b").filter(ok)], names=["a", "b"])
    return run


def _bits(prefix: str) -> list[Column]:
    return [F.get("parities", F.lit(k)).alias(f"{prefix}_bits{k}") for k in range(PARITIES)]


def _near_bits(percent: int) -> Column:
    """Whether the sizes and parities of sets a and b allow the similarity."""
    # |A xor B| <= (1 - s) / (1 + s) * (|A| + |B|), and it is the difference of the sizes at least.
    bits = sum((F.bit_count(F.col(f"a_bits{k}").bitwiseXOR(F.col(f"b_bits{k}"))) for k in range(PARITIES)), F.lit(0))
    most = (100 - percent) * (F.col("a_size") + F.col("b_size"))
    return ((100 + percent) * F.abs(F.col("a_size") - F.col("b_size")) <= most) & ((100 + percent) * bits <= most)


def linked_groups(postings: DataFrame, shapes: Callable[[DataFrame], DataFrame], texts: Callable[[DataFrame], DataFrame],
                  verify: Callable[[DataFrame], DataFrame], percent: int, scratch: Scratch, copies: DataFrame | None = None,
                  sparing: bool = False) -> DataFrame:
    """(id, component) of the ids that have a link, from stored postings and the links (a, b) of known copies.

    All tables of ``scratch`` are dropped on the way, the postings too.

    ``shapes`` maps a frame of distinct ids to (id, size, parities), the number of items in the id's set and what
    :func:`parities` says; ``texts`` to (id, items), from which ``verify`` tells what links: it maps (a, b, x, y), where
    x and y are the items of a and b, to the pairs (a, b) with 100 * intersection >= percent * union. Shapes rule most
    other candidates out before texts are moved. Both tables are large: they are joined by id, the texts as they were
    stored, in buckets of the id, so that pairs go to them and they stay where they are.

    With ``sparing`` every id leaves out as many of its keys of each level as it can spare, the most frequent ones. A
    key that only one id has is not among the postings; it is rarer than all that are.

    A key's head is its most central member, the one whose keys have most members: of a group of near copies that is
    the one nearest to their common origin. First every id is compared with the most central of its keys' heads, one
    pair per id, which unites a group of near copies however many keys they share. Of the keys that still hold several
    components, members are compared with the head of their key; of those that are left, with all members of other
    components but the head, which has been compared with all of them. There a key of many members that do not link has
    very many pairs: each takes a comparison of sizes and parities inside the join, and only those that may link become rows.
    """
    weighed = postings.withColumn("central", F.sum("weight").over(Window.partitionBy("id")))
    if sparing:
        frequent = Window.partitionBy("id", "level").orderBy(F.desc("weight"), F.desc("key"))
        weighed = weighed.withColumn("nth", F.row_number().over(frequent)).where("nth > spare")
    ranked = scratch.kept(weighed.select("key", "id", "central"), "ranked")
    heads = ranked.groupBy("key").agg(F.max(F.struct("central", (-F.col("id")).alias("minus"))).alias("top"))
    # Heads grow with the postings: merged at every size.
    headed = scratch.kept(ranked.drop("central").join(heads.hint("merge"), "key").select(
        "key", "id", F.col("top.central").alias("central"), (-F.col("top.minus")).alias("head")), "headed")
    scratch.drop(ranked, postings)
    best = headed.groupBy("id").agg(F.max(F.struct("central", (-F.col("head")).alias("minus"))).alias("top"))
    shape = scratch.bucketed(shapes(headed.select("id").distinct()), "shapes", "id")
    text = texts(headed.select("id").distinct())

    def both_ends(pairs: DataFrame, table: DataFrame, a: list[Column], b: list[Column], name: str) -> tuple[DataFrame, DataFrame]:
        """Pairs with columns of both ids, and what they read. Many pairs may have one b: rows of b are dealt anew, so that Spark can split them."""
        ends = scratch.kept(table.join(pairs.select(F.col("b").alias("id")).distinct(), "id", "left_semi"), f"{name}-ends")
        near_a = table.select(F.col("id").alias("a"), *a)
        return pairs.join(near_a, "a").join(ends.select(F.col("id").alias("b"), *b), "b"), ends

    def may_link(pairs: DataFrame, name: str) -> DataFrame:
        met, ends = both_ends(pairs, shape, [F.col("size").alias("a_size"), *_bits("a")], [F.col("size").alias("b_size"), *_bits("b")], name)
        near = scratch.kept(met.where(_near_bits(percent)).select("a", "b"), f"{name}-possible")
        scratch.drop(ends)
        return near

    def verified(near: DataFrame, name: str) -> DataFrame:
        met, ends = both_ends(near, text, [F.col("items").alias("x")], [F.col("items").alias("y")], f"{name}-text")
        found = scratch.kept(verify(met.select("a", "b", "x", "y")), f"{name}-links")
        scratch.drop(ends)
        return found

    first = scratch.kept(_pairs(best.select("id", (-F.col("top.minus")).alias("other"))).select("a", "b"), "first")
    links = verified(may_link(first, "first"), "first")
    label = scratch.kept(components(links), "first-labels")
    open_ = _open(headed, label, scratch)
    scratch.drop(headed)
    far = label.select(F.col("id").alias("head"), F.col("component").alias("head_label"))
    star = open_.join(far, "head", "left").where(F.col("label") != F.coalesce("head_label", "head"))
    star = scratch.kept(_without(_pairs(star.select("id", F.col("head").alias("other"))), first).select("a", "b"), "star")
    scratch.drop(label)
    links = links.unionByName(verified(may_link(star, "star"), "star"))
    label = scratch.kept(components(links), "star-labels")
    wider, open_ = open_, _open(open_.where("id != head"), label, scratch)
    scratch.drop(wider, label)
    # Members of a key's largest component need not meet each other: only the others look for partners.
    counts = open_.groupBy("key", "label").count()
    major = counts.groupBy("key").agg(F.max(F.struct("count", "label"))["label"].alias("major"))
    marked = scratch.kept(open_.select("key", "id", "label").join(major, "key").join(shape, "id"), "marked")
    scratch.drop(open_, shape)
    a = marked.where("label != major").select("key", *(F.col(c).alias(f"a_{c}") for c in ("id", "label", "size")), *_bits("a"))
    b = marked.select("key", "major", *(F.col(c).alias(f"b_{c}") for c in ("id", "label", "size")), *_bits("b"))
    rest = a.join(b, "key").where(((F.col("b_label") == F.col("major")) | (F.col("a_label") < F.col("b_label"))) & _near_bits(percent))
    rest = _pairs(rest.select(F.col("a_id").alias("id"), F.col("b_id").alias("other")))
    for done in (first, star):
        rest = _without(rest, done)
    rest = scratch.kept(rest.select("a", "b"), "rest")
    scratch.drop(marked, first, star)
    found = links.unionByName(verified(rest, "rest"))
    groups = components(found.unionByName(copies) if copies is not None else found)
    scratch.drop_all()
    return groups


def _unordered(a: str, b: str) -> list[Column]:
    return [F.least(a, b).alias("low"), F.greatest(a, b).alias("high")]


def _pairs(met: DataFrame) -> DataFrame:
    """(low, high, a, b) of (id, other), each pair once: a is the id, b the other."""
    once = met.where("id != other").groupBy(*_unordered("id", "other")).agg(F.min("id").alias("a"))
    return once.withColumn("b", F.when(F.col("a") == F.col("low"), F.col("high")).otherwise(F.col("low")))


def _without(pairs: DataFrame, done: DataFrame) -> DataFrame:
    return pairs.join(done.select(*_unordered("a", "b")), ["low", "high"], "left_anti")


def _open(postings: DataFrame, components: DataFrame, scratch: Scratch) -> DataFrame:
    """Postings (key, id, head) of the keys whose members are in several components, with ``label``, the component of each. Stored."""
    label = components.withColumnRenamed("component", "label")
    placed = scratch.kept(postings.select("key", "id", "head").join(label, "id", "left").withColumn("label", F.coalesce("label", "id")), "placed")
    split = placed.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo < hi").select("key")
    open_ = scratch.kept(placed.join(split, "key", "left_semi"), "open")
    scratch.drop(placed)
    return open_
