"""Mixing sources to target weights by a min-cost flow over membership patterns.

A document may belong to several sources.  Documents with the same set of sources form a pattern,
and only the words of each pattern reach the driver.  There, every source has a quota of words, and
a flow from patterns to the sources they belong to fills the quotas at the least cost: the first
copy of a word costs 1, each further one more than the one before, so that overlapping patterns go
where they save repetition.  The flow of a pattern then becomes documents: in a seeded order they lie
one after another on a line as long as the pattern's words, and a prefix of the line is copied once
more than the rest.

Positions on the line need no sort of a pattern: documents fall into buckets of the order, buckets
are summed, and only documents in a bucket that holds a cut are ordered exactly.
"""

from __future__ import annotations

import heapq
from collections import defaultdict

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quayline.llm.common import WORD, staged

SEED = 17
# Hex digits of the seeded order that make a bucket.
BUCKET_DIGITS = 3


def source_targets(
    sizes: dict[str | None, int],
    weights: tuple[float, ...] = (5, 2, 1),
    share: float = 1.5,
    most: float = 2.0,
) -> dict[str | None, float]:
    """Words wanted of each source: ``share`` of all words, dealt by ``weights`` (repeating, sources
    in code point order, null last), none above ``most`` times its size; what is above is dealt
    again among the others.

    That end is a level L at which every source gets the smaller of L times its weight and its
    bound; sources reach their bound in the order of bound over weight.
    """
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: float(weights[i % len(weights)]) for i, s in enumerate(order)}
    bound = {s: most * sizes[s] for s in order}
    left = min(share * sum(sizes.values()), sum(bound.values()))
    free = sum(weight.values())
    level = 0.0
    for s in sorted(order, key=lambda s: (bound[s] / weight[s], order.index(s))):
        level = left / free
        if bound[s] > level * weight[s]:
            break
        left -= bound[s]
        free -= weight[s]
        level = float("inf") if free <= 0 else left / free
    return {s: min(bound[s], level * weight[s]) for s in order}


def min_cost_flow(
    words: list[int], members: list[list[int]], quotas: list[int], repeats: int = 2
) -> list[dict[int, int]]:
    """Words of each pattern routed to each of its sources, as one dictionary per pattern.

    Copy ``c`` of a pattern's words (from 1 to ``repeats``) costs 2c - 1 a word.  Fills the quotas
    as far as possible, then at the least cost, by successive shortest paths.
    """
    patterns, sources = len(words), len(quotas)
    start, end = patterns + sources, patterns + sources + 1
    to: list[int] = []
    room: list[int] = []
    cost: list[int] = []
    out: list[list[int]] = [[] for _ in range(end + 1)]

    def arc(a: int, b: int, capacity: int, price: int) -> None:
        for node, other, c, p in ((a, b, capacity, price), (b, a, 0, -price)):
            out[node].append(len(to))
            to.append(other)
            room.append(c)
            cost.append(p)

    for p in range(patterns):
        for copy in range(repeats):
            arc(start, p, words[p], 2 * copy + 1)
        for s in members[p]:
            arc(p, patterns + s, repeats * words[p], 0)
    for s in range(sources):
        arc(patterns + s, end, quotas[s], 0)

    potential = [0] * (end + 1)
    while True:
        # Dijkstra over costs made non-negative by the potentials.
        away = [None] * (end + 1)
        via = [-1] * (end + 1)
        away[start] = 0
        heap = [(0, start)]
        while heap:
            d, node = heapq.heappop(heap)
            if d > away[node]:
                continue
            for a in out[node]:
                if room[a]:
                    reach = d + cost[a] + potential[node] - potential[to[a]]
                    if away[to[a]] is None or reach < away[to[a]]:
                        away[to[a]], via[to[a]] = reach, a
                        heapq.heappush(heap, (reach, to[a]))
        if away[end] is None:
            break
        farthest = max(d for d in away if d is not None)
        potential = [h + (farthest if d is None else d) for h, d in zip(potential, away, strict=True)]
        # Send as much as fits along every shortest path: arcs without reduced cost, depth first.
        while True:
            via = [-1] * (end + 1)
            via[start] = -2
            stack = [start]
            while stack and via[end] == -1:
                node = stack.pop()
                for a in out[node]:
                    b = to[a]
                    if room[a] and via[b] == -1 and not cost[a] + potential[node] - potential[b]:
                        via[b] = a
                        stack.append(b)
            if via[end] == -1:
                break
            path, node = [], end
            while node != start:
                path.append(via[node])
                node = to[via[node] ^ 1]
            sent = min(room[a] for a in path)
            for a in path:
                room[a] -= sent
                room[a ^ 1] += sent
    flows: list[dict[int, int]] = []
    for p in range(patterns):
        routed = {to[a] - patterns: room[a ^ 1] for a in out[p] if not a & 1}
        flows.append({s: f for s, f in routed.items() if f})
    return flows


def mix_sources(
    docs: DataFrame,
    sources: Column | str = "source",
    weights: tuple[float, ...] = (5, 2, 1),
    share: float = 1.5,
    repeats: int = 2,
    seed: int = SEED,
    max_patterns: int = 100_000,
    key: str | None = None,
) -> DataFrame:
    """``docs`` (``doc_id``, ``text``; other columns are ignored) to ``doc_id``, ``members``,
    ``size``, ``copies`` and ``taken`` (words of all copies), and ``routes``: copies by source.

    ``sources`` is a name or an array of names per document; a null name is a source, a null array
    belongs to the null source, repeated names count once.  A null text has no words; documents
    without words take none and are copied as the line falls.  Repeated rows are documents each.
    ``key`` names a column that tells rows apart; it is returned too, and orders rows without an id.
    The driver holds the patterns, at most ``max_patterns``; more raise ``ValueError``.
    """
    column = F.col(sources) if isinstance(sources, str) else sources
    own = [key] if key else []
    sized = docs.select("doc_id", "text", column.alias("members"), *own)
    if sized.schema["members"].dataType.typeName() != "array":
        sized = sized.withColumn("members", F.array("members"))
    # The name of a source as text, null told from any name by an empty list.
    members = F.transform(
        F.sort_array(
            F.array_distinct(
                F.transform(
                    F.coalesce("members", F.array(F.lit(None).cast("string"))),
                    lambda s: F.when(s.isNull(), F.array().cast("array<string>")).otherwise(
                        F.array(s.cast("string"))
                    ),
                )
            )
        ),
        lambda s: s,
    )
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    sized = sized.select("doc_id", members.alias("members"), size.alias("size"), *own)
    named = [F.col("doc_id").cast("string"), *(F.concat(F.lit("row"), c) for c in own), F.lit("")]
    order = F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(*named), "size"))
    sized = staged(
        sized.withColumn("_order", order).withColumn(
            "_bucket", F.substring("_order", 1, BUCKET_DIGITS)
        ),
        "sizes",
    )
    buckets = staged(
        sized.groupBy("members", "_bucket").agg(
            F.sum("size").alias("_words"), F.count(F.lit(1)).alias("_docs")
        ),
        "buckets",
    )
    found = (
        buckets.groupBy("members").agg(F.sum("_words").alias("words")).limit(max_patterns + 1)
    ).collect()
    if len(found) > max_patterns:
        raise ValueError(f"more than {max_patterns} sets of sources")
    plan = _plan(found, weights, share, repeats)
    lines = docs.sparkSession.createDataFrame(
        plan,
        "members array<array<string>>, _total long, _full long, _part long, "
        "_cuts array<struct<until: long, source: string>>, source_size long, target double",
    )
    # At most max_patterns rows, made on the driver.
    before = Window.partitionBy("members").orderBy("_bucket").rowsBetween(
        Window.unboundedPreceding, -1
    )
    spans = buckets.select(
        "members",
        "_bucket",
        F.coalesce(F.sum("_words").over(before), F.lit(0)).alias("_low"),
        "_words",
    ).join(F.broadcast(lines), "members")
    high = F.col("_low") + F.col("_words")
    cut_here = F.exists(
        "_cuts",
        lambda c: (F.col("_low") < c["until"] % F.greatest("_total", F.lit(1)))
        & (c["until"] % F.greatest("_total", F.lit(1)) <= high),
    ) | ((F.col("_low") < F.col("_part")) & (F.col("_part") <= high))
    placed = sized.join(spans.withColumn("_exact", cut_here), ["members", "_bucket"])
    within = (
        Window.partitionBy("members", "_bucket")
        .orderBy("_order", "doc_id", *own)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    exact = placed.filter("_exact").withColumn(
        "_low", F.col("_low") + F.coalesce(F.sum("size").over(within), F.lit(0))
    )
    placed = placed.filter("not _exact").unionByName(exact)
    more = (2 * F.col("_low") + F.col("size") < 2 * F.col("_part")).cast("int")
    placed = placed.withColumn("copies", F.col("_full") + more)
    # Copy c of a document lies c lines further; the first cut beyond its middle names its source.
    routed = F.transform(
        F.sequence(F.lit(0), F.col("copies") - 1),
        lambda c: F.element_at(
            F.filter(
                "_cuts",
                lambda x: 2 * (F.col("_low") + c * F.col("_total")) + F.col("size") < 2 * x["until"],
            ),
            1,
        )["source"],
    )
    last = F.element_at("_cuts", -1)["source"]
    routes = F.when(F.col("copies") > 0, F.transform(routed, lambda s: F.coalesce(s, last)))
    return placed.select(
        "doc_id",
        F.transform("members", lambda s: F.get(s, 0)).alias("members"),
        "size",
        "source_size",
        "target",
        "copies",
        (F.col("size") * F.col("copies")).cast("long").alias("taken"),
        F.coalesce(routes, F.array().cast("array<string>")).alias("routes"),
        *own,
    )


def _plan(found, weights, share, repeats) -> list[tuple]:
    """For each pattern: its words, whole copies of its line, the rest of a copy, where along the
    copies each source's part ends, and size and target of its (first) source."""
    names = [[m[0] if m else None for m in row["members"]] for row in found]
    sizes: dict[str | None, int] = defaultdict(int)
    for row, own in zip(found, names, strict=True):
        for s in own:
            sizes[s] += row["words"]
    # Words shared by sources count once in what the mix holds.
    total = sum(row["words"] for row in found)
    scale = total / sum(sizes.values()) if sum(sizes.values()) else 1.0
    targets = source_targets(sizes, weights, share * scale, float(repeats))
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    index = {s: i for i, s in enumerate(order)}
    flows = min_cost_flow(
        [row["words"] for row in found],
        [[index[s] for s in own] for own in names],
        [int(targets[s]) for s in order],
        repeats,
    )
    plan = []
    for row, own, flow in zip(found, names, flows, strict=True):
        words, sent = row["words"], sum(flow.values())
        cuts, until = [], 0
        for s in sorted(flow):
            until += flow[s]
            cuts.append((until, order[s]))
        full, part = divmod(sent, words) if words else (0, 0)
        plan.append(
            (row["members"], words, full, part, cuts, sizes[own[0]], float(targets[own[0]]))
        )
    return plan
