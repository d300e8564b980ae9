"""Mixing overlapping sources to target weights by a min-cost flow.

Documents are summed up by membership pattern (the set of sources they belong
to). Tokens flow from patterns to the sources' quotas: a pattern offers its
tokens once for free and again at rising costs, so repetition is spent where
it costs least. Each pattern then takes its documents a whole number of times,
and the rest of its flow from documents chosen by a seeded hash.

Only the pattern table (a row per distinct set of sources) and the quotas reach
the driver. The choice is exact without sorting a source: hash buckets fully
below the cut are taken whole, and only the bucket in which the cut lies (a
4096th of a pattern's rows) is put in order.

Defined results: null texts have no words; a null source is a source of its
own, last; a source without words has target 0; rows with equal ids are rows
of their own, told apart by their texts; no documents give no rows; equal
inputs give equal results for a seed; columns other than those named are not
read.
"""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from paneltide.llm import store

WORD = r"[^\x20\x09-\x0D]+"
BUCKET_BITS = 12
REPEAT_COSTS = (0, 1, 3)  # of a token's first, second and third use


def words(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def targets(sizes: dict, weights: dict, most: int = len(REPEAT_COSTS)) -> dict[object, float]:
    """Shares of all sizes by weight; none above ``most`` times its size, the
    excess shared again by weight among the others until none is above."""
    capped: set = set()
    total = float(sum(sizes.values()))
    while True:
        free = total - sum(most * sizes[s] for s in capped)
        weight = sum(weights[s] for s in sizes if s not in capped)
        out = {s: float(most * n) if s in capped else free * weights[s] / weight for s, n in sizes.items()}
        above = {s for s in sizes if s not in capped and out[s] > most * sizes[s]}
        if not above:
            return out
        capped |= above


def route(patterns: dict[tuple, int], quotas: dict[object, int], costs=REPEAT_COSTS) -> dict[tuple, dict[object, int]]:
    """Tokens from each pattern to each of its sources: the cheapest flow that
    fills the quotas as far as they can be filled (successive shortest paths
    with potentials). Arcs into a pattern rise in cost with each use."""
    nodes = {"s": 0, "t": 1}
    graph: list[list[int]] = [[], []]
    arcs: list[list] = []  # head, capacity, cost; arc i ^ 1 is its reverse

    def node(x) -> int:
        if x not in nodes:
            nodes[x] = len(graph)
            graph.append([])
        return nodes[x]

    def arc(a: int, b: int, cap: int, cost: int) -> int:
        graph[a].append(len(arcs))
        arcs.append([b, cap, cost])
        graph[b].append(len(arcs))
        arcs.append([a, 0, -cost])
        return len(arcs) - 2

    links: dict[tuple, dict[object, int]] = {}
    for p, size in patterns.items():
        at = node(("pattern", p))
        for cost in costs:
            arc(0, at, size, cost)
        links[p] = {s: arc(at, node(("source", s)), size * len(costs), 0) for s in p}
    for s, quota in quotas.items():
        arc(node(("source", s)), 1, quota, 0)
    height = [0] * len(graph)
    while True:
        far = [None] * len(graph)
        via = [-1] * len(graph)
        far[0], heap = 0, [(0, 0)]
        while heap:
            d, a = heapq.heappop(heap)
            if d > far[a]:
                continue
            for e in graph[a]:
                b, cap, cost = arcs[e]
                if cap > 0 and (far[b] is None or d + cost + height[a] - height[b] < far[b]):
                    far[b], via[b] = d + cost + height[a] - height[b], e
                    heapq.heappush(heap, (far[b], b))
        if far[1] is None:
            break
        height = [h + (f if f is not None else 0) for h, f in zip(height, far)]
        push, b = None, 1
        while b:
            push = arcs[via[b]][1] if push is None else min(push, arcs[via[b]][1])
            b = arcs[via[b] ^ 1][0]
        b = 1
        while b:
            arcs[via[b]][1] -= push
            arcs[via[b] ^ 1][1] += push
            b = arcs[via[b] ^ 1][0]
    return {p: {s: arcs[e ^ 1][1] for s, e in to.items()} for p, to in links.items()}


def _prefix(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """Adds ``more``: 1 for the documents that, in the order of the hash ``u``,
    end at or before the pattern's ``rest``, up to the first that does not."""
    upto = W.partitionBy("pattern").orderBy("bucket").rowsBetween(W.unboundedPreceding, W.currentRow)
    sums = rows.groupBy("pattern", "bucket").agg(F.sum("size").alias("n")).withColumn("end", F.sum("n").over(upto))
    cut = sums.join(plan, "pattern").filter(F.col("end") > F.col("rest")).groupBy("pattern").agg(
        F.min("bucket").alias("cut"), F.min_by(F.col("end") - F.col("n"), "bucket").alias("base"))
    rows = rows.join(plan.join(cut, "pattern", "left"), "pattern")  # no cut: all are taken
    inside = rows.filter("bucket = cut")
    through = W.partitionBy("pattern", "bucket").orderBy("u", "id", "tie").rowsBetween(W.unboundedPreceding, W.currentRow)
    inside = inside.withColumn("more", F.col("base") + F.sum("size").over(through) <= F.col("rest"))
    outside = rows.filter("cut is null or bucket <> cut").withColumn(
        "more", F.when(F.col("cut").isNull(), F.col("rest") > 0).otherwise(F.col("bucket") < F.col("cut")))
    return inside.unionByName(outside).withColumn("more", F.col("more").cast("int")).drop("rest", "cut", "base")


def select(rows: DataFrame, taken: dict[tuple, tuple[int, int]], seed: int, rounds: int = 3) -> DataFrame:
    """``rows`` has ``pattern``, ``size``, ``id`` and ``tie``; ``taken`` has for
    each pattern how often every document is taken, and the tokens to take
    besides. Adds ``copies`` and ``taken``. What the first cut leaves open, less than one
    document, is filled in further rounds with documents that fit into it, so
    a long document at the cut leaves no gap."""
    spark = rows.sparkSession
    rows = rows.withColumn("u", F.xxhash64(F.lit(seed), "id", "tie"))
    rows = rows.withColumn("bucket", F.shiftrightunsigned("u", 64 - BUCKET_BITS)).withColumn("more", F.lit(0))
    rest = {p: r for p, (_, r) in taken.items()}
    for _ in range(rounds):
        plan = spark.createDataFrame([(list(p), r) for p, r in rest.items()], "pattern array<string>, rest long")
        rows = rows.join(plan, "pattern")
        fits = (F.col("more") == 0) & (F.col("size") <= F.col("rest"))
        tried = _prefix(rows.filter(fits).drop("more", "rest"), plan)
        rows = store.materialise(tried.unionByName(rows.filter(~fits).drop("rest")), "mixing")
        used = rows.groupBy("pattern").agg(F.sum(F.col("more") * F.col("size")).alias("n")).collect()  # a row per pattern
        rest = {p: taken[p][1] for p in taken} | {tuple(r["pattern"]): taken[tuple(r["pattern"])][1] - r["n"] for r in used}
    whole = spark.createDataFrame([(list(p), w) for p, (w, _) in taken.items()], "pattern array<string>, whole long")
    out = rows.join(whole, "pattern").withColumn("copies", F.col("whole") + F.col("more"))
    return out.withColumn("taken", F.col("copies") * F.col("size")).drop("u", "bucket", "more", "whole")


def mix(rows: DataFrame, quotas: dict | None = None, weigh=None, seed: int = 0) -> DataFrame:
    """``rows`` has ``id``, ``tie`` (tells rows with equal ids apart), ``size``
    and ``sources`` (array). Quotas are given, or made by ``targets`` from
    ``weigh(sources in code-point order, null last) -> weights``. Adds
    ``taken``; ``.targets`` of the first source come as ``source_size`` and
    ``target``."""
    spark = rows.sparkSession
    # null is kept apart from any name: names get a prefix
    names = F.transform("sources", lambda s: F.coalesce(F.concat(F.lit("="), s), F.lit("~")))
    rows = rows.withColumn("pattern", F.array_sort(F.array_distinct(names)))
    found = rows.groupBy("pattern").agg(F.sum("size").alias("n")).collect()  # a row per set of sources
    patterns = {tuple(r["pattern"]): r["n"] for r in found}
    sizes: dict[str, int] = {}
    for p, n in patterns.items():
        for s in p:
            sizes[s] = sizes.get(s, 0) + n
    order = sorted(sizes, key=lambda s: (s == "~", s))
    if quotas is None:
        quotas = targets({s: sizes[s] for s in order}, dict(zip(order, weigh(order))))
    else:
        quotas = {("~" if s is None else f"={s}"): q for s, q in quotas.items()}
    flows = route(patterns, {s: int(round(q)) for s, q in quotas.items() if s in sizes})
    taken = {p: divmod(sum(flows[p].values()), n) if n else (0, 0) for p, n in patterns.items()}
    facts = spark.createDataFrame([(s, n, float(quotas.get(s, 0.0))) for s, n in sizes.items()], "s string, source_size long, target double")
    out = select(rows, taken, seed).withColumn("s", F.get("pattern", F.lit(0)))
    return out.join(facts, "s", "left").drop("s", "pattern")


def sized(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row per document with what the mix needs, from one pass over the texts."""
    return docs.select(
        F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("tie"), words(F.col(text_col)).alias("size"),
        F.array(F.col(source_col).cast("string")).alias("sources"))


def one_two_three(order: list) -> list[int]:
    return [k % 3 + 1 for k in range(len(order))]


def mixed(docs: DataFrame, weigh, seed: int = 0, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The documents, each as often as the mix takes it."""
    rows = store.materialise(sized(docs, id_col, text_col, source_col), "mixing")
    # rows equal in id and text share what the mix takes of them
    copies = mix(rows, weigh=weigh, seed=seed).groupBy("id", "tie").agg(F.sum("copies").alias("copies"), F.count("*").alias("rows"))
    held = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.col(id_col).cast("long").alias("id_"), F.xxhash64(text_col).alias("tie_"))
    held = held.withColumn("k", F.row_number().over(W.partitionBy("id_", "tie_").orderBy("tie_")))
    out = held.join(copies, F.col("id_").eqNullSafe(F.col("id")) & (F.col("tie_") == F.col("tie")))
    each = F.floor(F.col("copies") / F.col("rows")) + (F.col("k") <= F.col("copies") % F.col("rows")).cast("int")
    return out.withColumn("each", each.cast("int")).filter("each > 0").select(
        "row", F.explode(F.sequence(F.lit(1), F.col("each"))).alias("copy")).select("row.*")


def q_op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = store.materialise(sized(store.read(spark, sf_dir, "documents")), "mixing")
    return mix(rows, weigh=one_two_three).select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")
