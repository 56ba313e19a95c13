"""Mixing sources to target weights as a min-cost flow over membership patterns.

Documents are summed by the set of sources they belong to. Words flow from patterns to source quotas; the k-th copy
of a document costs k squared, so repetition is spread before it is piled up. Seeded documents then realise the flow.
"""

from __future__ import annotations

import heapq
from collections import defaultdict

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewarden.functions.lookup import constant_frame
from tidewarden.llm.common import WORD, kept, table

MAX_COPIES = 3
WEIGHTS = (5, 2, 1)
BINS = 4096
SEED = 17
# The pattern table is the one thing that visits the driver: sums per distinct set of sources.
MAX_PATTERNS = 1_000_000


def targets(sizes: dict[str | None, int], weights: dict[str | None, float], copies: int = MAX_COPIES) -> dict[str | None, float]:
    """Shares of the total size by weight; a target stops at ``copies`` times its source, the excess is shared again."""
    out = dict.fromkeys(sizes, 0.0)
    left, free = float(sum(sizes.values())), [s for s in sizes if sizes[s] > 0]
    while free:
        total = sum(weights[s] for s in free)
        full = [s for s in free if left * weights[s] / total > copies * sizes[s]]
        if not full:
            for s in free:
                out[s] = left * weights[s] / total
            break
        for s in full:
            out[s] = float(copies * sizes[s])
        left -= sum(out[s] for s in full)
        free = [s for s in free if s not in full]
    return out


def min_cost_flow(supply: dict, quota: dict, copies: int = MAX_COPIES) -> dict:
    """Words each pattern gives each of its sources: {(pattern, source): words}.

    ``supply``: pattern (a tuple of sources) -> words; ``quota``: source -> words. Successive cheapest paths over
    start -> pattern (one arc per copy, cost 1, 4, 9, ...) -> source -> end. A pattern of one source needs no search.
    """
    flow: dict = defaultdict(int)
    need = {s: int(round(q)) for s, q in quota.items()}
    nodes = {"start": 0, "end": 1}
    for p in supply:
        nodes[("p", p)] = len(nodes)
    for s in quota:
        nodes[("s", s)] = len(nodes)
    head: list[list[int]] = [[] for _ in nodes]
    to, cap, cost = [], [], []

    def arc(a, b, c, w):
        for x, y, r, k in ((a, b, c, w), (b, a, 0, -w)):
            head[nodes[x]].append(len(to))
            to.append(nodes[y])
            cap.append(r)
            cost.append(k)

    where = {}
    for p, words in supply.items():
        for k in range(1, copies + 1):
            arc("start", ("p", p), words, k * k)
        for s in p:
            where[(p, s)] = len(to)
            arc(("p", p), ("s", s), copies * words, 0)
    for s, n in need.items():
        arc(("s", s), "end", n, 0)
    potential = [0] * len(nodes)
    while True:
        far = [float("inf")] * len(nodes)
        came = [-1] * len(nodes)
        far[0], heap = 0, [(0, 0)]
        while heap:
            d, u = heapq.heappop(heap)
            if d > far[u]:
                continue
            for e in head[u]:
                if cap[e] > 0 and d + cost[e] + potential[u] - potential[to[e]] < far[to[e]]:
                    far[to[e]] = d + cost[e] + potential[u] - potential[to[e]]
                    came[to[e]] = e
                    heapq.heappush(heap, (far[to[e]], to[e]))
        if far[1] == float("inf"):
            break
        reach = max(x for x in far if x != float("inf"))
        potential = [p + min(x, reach) for p, x in zip(potential, far)]
        path, v = [], 1
        while v:
            path.append(came[v])
            v = to[came[v] ^ 1]
        amount = min(cap[e] for e in path)
        for e in path:
            cap[e] -= amount
            cap[e ^ 1] += amount
    for key, e in where.items():
        if cap[e ^ 1]:
            flow[key] = cap[e ^ 1]
    return dict(flow)


def _draw(*columns: str) -> Column:
    return F.pmod(F.xxhash64(F.lit(SEED), *[F.col(c).cast("string") for c in columns]), F.lit(1 << 40))


def _fitting(open_: DataFrame) -> DataFrame:
    """The rows (row, pattern, size) of the longest seeded start of each pattern that fits its room.

    ``open_``: (row, pattern, size, draw, more). A histogram of the draws says in which of :data:`BINS` bins the room
    ends; only that bin's rows are put in order.
    """
    binned = open_.withColumn("bin", (F.col("draw") / (2**40 // BINS)).cast("int"))
    over = Window.partitionBy("pattern").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    bins = (
        binned.groupBy("pattern", "bin").agg(F.sum("size").alias("held"), F.max("more").alias("room"))
        .withColumn("before", F.coalesce(F.sum("held").over(over), F.lit(0))).where("before < room")
    )
    whole = binned.join(bins.where("before + held <= room").select("pattern", "bin"), ["pattern", "bin"], "left_semi")
    inside = Window.partitionBy("pattern", "bin").orderBy("draw", "size", "row").rowsBetween(Window.unboundedPreceding, 0)
    cut = binned.join(bins.where("before + held > room").select("pattern", "bin", "before"), ["pattern", "bin"]).withColumn(
        "upto", F.col("before") + F.sum("size").over(inside))
    columns = ["row", "pattern", "size"]
    return whole.select(*columns).unionByName(cut.where("upto <= more").select(*columns))


def copies_taken(documents: DataFrame, demand: dict[str, tuple[int, int]]) -> DataFrame:
    """Add ``copies`` to (row, pattern, size, draw, ...): whole copies for all, one more for seeded documents.

    ``demand``: pattern -> (words, wanted). The documents of a pattern are taken in their seeded order as far as they fit
    what is wanted beyond whole copies. Where the next one is too long it is passed over, and the order goes on with those
    that fit what is left, until none does: what is missing then is less than the shortest document left.
    """
    spark = documents.sparkSession
    narrow = documents.where("size > 0").select("row", "pattern", "size", "draw")
    room = {p: wanted % words for p, (words, wanted) in demand.items() if words and wanted % words}
    taken = None
    while room:
        fits = narrow.join(constant_frame(spark, list(room.items()), "pattern string, more bigint"), "pattern").where("size <= more")
        if taken is not None:
            fits = fits.join(taken, "row", "left_anti")
        chosen = kept(_fitting(fits), "mix-taken")
        got = {r["pattern"]: r["got"] for r in chosen.groupBy("pattern").agg(F.sum("size").alias("got")).collect()}
        # A pattern that took nothing has no document left that fits.
        room = {p: more - got[p] for p, more in room.items() if p in got and more > got[p]}
        taken = chosen.select("row") if taken is None else taken.unionByName(chosen.select("row"))
    whole = constant_frame(spark, [(p, wanted // words) for p, (words, wanted) in demand.items() if words], "pattern string, whole bigint")
    out = documents.join(whole, "pattern", "left").withColumn("copies", F.coalesce("whole", F.lit(0)))
    if taken is not None:
        extra = taken.withColumn("extra", F.lit(1))
        out = out.join(extra, "row", "left").withColumn("copies", F.col("copies") + F.coalesce("extra", F.lit(0)))
    return out.withColumn("copies", F.col("copies").cast("long")).select(*documents.columns, "copies")


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def mixed_copies(documents: DataFrame, members: Column, weights=WEIGHTS, copies: int = MAX_COPIES,
                 with_text: bool = False) -> tuple[DataFrame, dict[str | None, int], dict[str | None, float]]:
    """(rows of ``document``, its columns as a struct, ``size`` and ``copies``; size per source; target per source).

    ``members``: array of the sources a document belongs to; a null source is one of its own. A document of several
    sources counts in each source's size and is routed to the quotas that need it. Weights repeat over the sources
    in code point order, null last. Null texts have no words and are taken once for every whole copy.
    Every row is a document of its own, also with a null or repeated id. ``document`` has all columns, but the text
    only ``with_text``. Empty input gives no rows.
    """
    pattern = F.to_json(F.array_sort(F.array_distinct(members)))
    own = documents.columns if with_text else [c for c in documents.columns if c != "text"]
    rows = kept(documents.select(
        F.struct(*own).alias("document"), word_count(F.col("text")).alias("size"), pattern.alias("pattern"),
        members.alias("members"), _draw("doc_id", "text").alias("draw"), F.monotonically_increasing_id().alias("row")), "mix-sizes")
    sums = rows.groupBy("pattern").agg(F.sum("size").alias("words"), F.first("members").alias("members"))
    held = sums.limit(MAX_PATTERNS + 1).collect()
    if len(held) > MAX_PATTERNS:
        raise ValueError(f"more than {MAX_PATTERNS} membership patterns; map rare sources to a common one first")
    supply, named, sizes = {}, {}, defaultdict(int)
    for r in held:
        p = tuple(sorted(set(r["members"]), key=lambda s: (s is None, s or "")))
        supply[p], named[p] = r["words"], r["pattern"]
        for s in p:
            sizes[s] += r["words"]
    order = sorted(sizes, key=lambda s: (s is None, [ord(c) for c in s or ""]))
    sizes = {s: sizes[s] for s in order}
    goal = targets(sizes, {s: weights[i % len(weights)] for i, s in enumerate(order)}, copies)
    flow = min_cost_flow(supply, goal, copies)
    wanted: dict = defaultdict(int)
    for (p, _), words in flow.items():
        wanted[p] += words
    return copies_taken(rows, {named[p]: (supply[p], wanted[p]) for p in supply}).select("document", "size", "copies"), sizes, goal


def op6_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words the mix takes of every document, beside its source's size and target."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    rows, sizes, goal = mixed_copies(documents, F.array("source"))
    facts = kept(spark.createDataFrame(
        [(s, sizes[s], float(goal[s])) for s in sizes], "named string, source_size long, target double"), "mix-sources")
    return rows.join(facts, F.col("document.source").eqNullSafe(F.col("named")), "left").select(
        F.col("document.doc_id").alias("doc_id"), "size", "source_size", "target",
        (F.col("size") * F.col("copies")).alias("taken"), F.col("document.source").alias("source"))
