"""Exact top-k inner products through a pivot-distance index.

Inner products become distances: with M the greatest squared length of a candidate, a vector x gets
one more coordinate sqrt(M - x·x) and a query gets 0 there, so that |q - x|² = q·q + M - 2 q·x, and
the largest product is the nearest vector.  Every vector is keyed by its nearest pivot and its
distance to it.  Sorted by that key, the vectors are cut into shards; the vectors of a pivot within a
shard form annuli.  By the triangle inequality a vector at distance d from a pivot is at least
|d(q, p) - d| away from a query, so a query visits annuli from its own distance outwards and stops
where that bound passes its k-th best so far.

Pivots come from a bounded sample.  The sample also gives each query a first k-th best, which says
what shards a group of queries has to visit at all.  Components are whole numbers and products exact:
64-bit integers where no product can exceed them, Python's own integers else.  Bounds are floating
point, loosened by more than their error at the size that the vectors have.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quayline.llm.common import staged

# Rows of the sample, of a shard and of a group of queries; pivots.
SAMPLE = 4096
SHARD = 4096
GROUP = 1024
PIVOTS = 48
SLACK = 1e-6
VISIT = 512  # vectors of an annulus compared at a time
# Products below this are 64-bit integers; beyond the second, more than a decimal's 38 digits.
NARROW = 2.0**61
WIDEST = 1e37


def whole_vectors(vectors: DataFrame, id_column: str, column: str, scale: int) -> DataFrame:
    """``id`` and ``x``: floor(scale * component), whole numbers as doubles, which hold them exactly
    at any size.  Null vectors, empty ones and those with a null, infinite or not-a-number component
    are left out."""

    def whole(v: Column) -> Column:
        # From 2^53 on a double has no fraction, and a long integer may be too short for it.
        scaled = v * F.lit(float(scale))
        return F.when(F.abs(scaled) < 2.0**53, F.floor(scaled).cast("double")).otherwise(scaled)

    parts = F.transform(F.col(column), lambda v: v.cast("double"))
    sound = F.forall(
        parts, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))
    )
    return vectors.filter(F.col(column).isNotNull() & (F.size(column) > 0) & sound).select(
        F.col(id_column).cast("long").alias("id"),
        F.transform(parts, whole).alias("x"),
    )


def _matrix(column: pd.Series, wide: bool = False) -> np.ndarray:
    """Vectors as rows of integers: 64-bit ones or, if ``wide``, Python's."""
    if not len(column):
        return np.zeros((0, 0), object if wide else np.int64)
    if wide:
        return np.array([[int(v) for v in x] for x in column], object)
    return np.stack(column.to_list()).astype(np.int64)


def _lifted(x: np.ndarray, top: int | None) -> np.ndarray:
    """With the further coordinate of a candidate, or 0 for a query (``top`` None)."""
    lengths = np.zeros(len(x)) if top is None else np.sqrt(
        np.maximum(top - (x * x).sum(axis=1), 0).astype(np.float64)
    )
    return np.hstack([x.astype(np.float64), lengths[:, None]])


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    squares = (a * a).sum(1)[:, None] + (b * b).sum(1)[None] - 2 * a @ b.T
    return np.sqrt(np.maximum(squares, 0))


def _choose_pivots(points: np.ndarray, count: int) -> np.ndarray:
    """Farthest-first: each pivot is the sampled point farthest from those before it."""
    chosen = [0]
    away = _distances(points, points[:1])[:, 0]
    while len(chosen) < min(count, len(points)) and away.max() > 0:
        chosen.append(int(away.argmax()))
        away = np.minimum(away, _distances(points, points[chosen[-1:]])[:, 0])
    return points[chosen]


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best by score, ties to the smaller id."""
    if len(scores) > 4 * k and scores.dtype != object:
        # Everything that ties with the k-th stays until ids decide.
        bound = np.partition(scores, len(scores) - k)[len(scores) - k]
        kept = np.flatnonzero(scores >= bound)
    else:
        kept = np.arange(len(scores))
    return kept[np.lexsort((ids[kept], -scores[kept]))[:k]]


def top_products(
    vectors: DataFrame,
    is_query: Column,
    k: int = 10,
    scale: int = 1024,
    id_column: str = "vec_id",
    column: str = "embedding",
    seed: int = 3,
) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``id`` and ``score``: for every row where ``is_query`` (over
    column ``id``) holds, the ``k`` largest inner products with every other row, or all if there are
    fewer; ties go to the smaller id.

    Components are turned into floor(``scale`` * x).  Rows that ``whole_vectors`` leaves out take no
    part, nor do rows with a null id; other columns are ignored.  Rows that share an id are
    candidates each, except for queries of that id, and ask once, as the row with the least vector.
    ``score`` is a long integer, or decimal(38,0) where some vector of the table is so long that a
    product might exceed 64 bits.  Vectors of several lengths raise ``ValueError``, as do components
    so large that a product might exceed 37 digits.  An empty table, or one without queries, gives no
    rows.
    """
    found = _compared(vectors, is_query, k, scale, id_column, column, seed)
    # Spark keeps k rows of a query per task before it moves them to be ranked.
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "id"))
    return (
        found.filter("id is not null")
        .withColumn("rank", rank)
        .filter(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "id", "score")
    )


def compared_share(
    vectors: DataFrame,
    is_query: Column,
    k: int = 10,
    scale: int = 1024,
    id_column: str = "vec_id",
    column: str = "embedding",
    seed: int = 3,
) -> float:
    """What share of all pairs of a query and a vector the search multiplies; 0 without pairs.  The
    bounds of ``top_products`` exclude the rest."""
    sound = whole_vectors(vectors, id_column, column, scale).filter("id is not null")
    queries = sound.filter(is_query).agg(F.count_distinct("id")).first()[0]
    found = _compared(vectors, is_query, k, scale, id_column, column, seed)
    done = found.filter("id is null").agg(F.sum("compared")).first()[0] or 0
    return done / max(1, queries * sound.count())


def _compared(
    vectors: DataFrame, is_query: Column, k: int, scale: int, id_column: str, column: str, seed: int
) -> DataFrame:
    """``query_id``, ``id``, ``score``: the best of each shard for every query that visits it, and a
    row with a null id that tells how many vectors were ``compared``."""
    spark = vectors.sparkSession
    whole = whole_vectors(vectors, id_column, column, scale).filter("id is not null")
    square = F.aggregate(F.transform("x", lambda v: v * v), F.lit(0.0), lambda s, v: s + v)
    stats = whole.agg(
        F.max(square), F.count(F.lit(1)), F.min(F.size("x")), F.max(F.size("x"))
    ).first()
    longest, rows, least, most = stats
    wide = bool(rows) and longest >= NARROW
    schema = f"query_id long, id long, score {'decimal(38,0)' if wide else 'long'}, compared long"
    empty = spark.createDataFrame([], schema)
    if not rows:
        return empty
    if least != most:
        raise ValueError("vectors differ in length")
    if not longest < WIDEST:
        raise ValueError("components are too large for products of 37 digits")
    # No less than the greatest squared length, which was summed in floating point.
    top = int(longest * (1 + 1e-9)) + 1
    slack = 4 * math.sqrt((most + 8) * 2.0**-51 * top)
    # Twice the wanted share by a hash of the row, cut on the driver: bounded at any size.
    share = min(1.0, 2 * SAMPLE / rows)
    draw = F.xxhash64(F.lit(seed), "id", "x").bitwiseAND(0x7FFFFFFF)
    drawn = whole.filter(draw <= int(share * 0x7FFFFFFF)).withColumn("draw", draw)
    sample = drawn.orderBy("draw", "id", "x").limit(SAMPLE).toPandas()
    sample_ids, sample_x = sample["id"].to_numpy(), _matrix(sample["x"], wide)
    pivots = _choose_pivots(_lifted(sample_x, top), PIVOTS)

    def keyed(as_query: bool):
        def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for frame in frames:
                if not len(frame):
                    continue
                x = _matrix(frame["x"], wide)
                away = _distances(_lifted(x, None if as_query else top), pivots)
                frame["pivot"] = away.argmin(axis=1).astype(np.int32)
                frame["distance"] = away.min(axis=1)
                if as_query:
                    first = x @ sample_x.T
                    bounds = []
                    for i, own in enumerate(frame["id"]):
                        others = np.sort(first[i][sample_ids != own])
                        bounds.append(str(others[-k]) if len(others) >= k else None)
                    frame["bound"] = bounds
                yield frame

        return run

    keys = "id long, x array<double>, pivot int, distance double"
    index = staged(
        _numbered(whole.mapInPandas(keyed(False), keys), keys, SHARD, rows, "shard"), "index"
    )
    asking = whole.filter(is_query).groupBy("id").agg(F.min("x").alias("x"))
    asked = staged(asking.mapInPandas(keyed(True), f"{keys}, bound string"), "asked")
    if asked.isEmpty():
        return empty
    queries = _grouped(asked)

    # What each group of queries may need of each pivot: distances from the least to the greatest.
    def reach(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if not len(frame):
                continue
            x = _matrix(frame["x"], wide)
            away = _distances(_lifted(x, None), pivots)
            radius = np.array(
                [
                    _radius(int(v @ v), None if pd.isna(b) else int(b), top, slack)
                    for v, b in zip(x, frame["bound"], strict=True)
                ]
            )
            for part in frame["part"].unique():
                own = (frame["part"] == part).to_numpy()
                yield pd.DataFrame(
                    {
                        "part": part,
                        "pivot": np.arange(len(pivots), dtype=np.int32),
                        "low": (away[own] - radius[own, None]).min(axis=0),
                        "high": (away[own] + radius[own, None]).max(axis=0),
                    }
                )

    reaches = queries.select("part", "x", "bound").mapInPandas(
        reach, "part long, pivot int, low double, high double"
    )
    reaches = reaches.groupBy("part", "pivot").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    annuli = index.groupBy("shard", "pivot").agg(
        F.min("distance").alias("from"), F.max("distance").alias("to")
    )
    # One row per shard and pivot against one per group and pivot: the blocks that are compared.
    visits = staged(
        annuli.withColumnRenamed("pivot", "_pivot")
        .join(reaches, F.col("pivot") == F.col("_pivot"))
        .filter("from <= high and to >= low")
        .select("shard", "part")
        .distinct(),
        "visits",
    )
    left = visits.join(
        queries.select(F.col("part").alias("_part"), "id", "x", "bound"),
        F.col("part") == F.col("_part"),
    ).select("shard", "part", "id", "x", "bound")
    right = (
        visits.select(F.col("shard").alias("_shard"), F.col("part").alias("_part"))
        .join(index, F.col("shard") == F.col("_shard"))
        .select("_shard", "_part", "id", "x", "pivot", "distance")
    )

    def search(asked_: pd.DataFrame, kept: pd.DataFrame) -> pd.DataFrame:
        return _search(asked_, kept, pivots, top, k, slack, wide)

    return (
        left.groupBy("shard", "part")
        .cogroup(right.groupBy("_shard", "_part"))
        .applyInPandas(search, schema)
    )


def _radius(square: int, bound: int | None, top: int, slack: float) -> float:
    """Distance beyond which a vector scores less than ``bound``; no limit without one.  Loosened by
    more than double precision loses: a squared distance is a difference of numbers up to ``top``."""
    if bound is None:
        return math.inf
    return math.sqrt(max(0, square + top - 2 * bound)) * (1 + SLACK) + SLACK + slack


def _grouped(asked: DataFrame) -> DataFrame:
    """Queries with a number ``part`` that about ``GROUP`` of them share: those of one pivot lie
    together, dealt by a hash where there are more.  Only counts by pivot reach the driver."""
    sizes = {r["pivot"]: r["count"] for r in asked.groupBy("pivot").count().collect()}
    part, before = F.lit(0).cast("long"), 0
    for pivot, size in sorted(sizes.items()):
        place = F.lit(before) + F.pmod(F.xxhash64("id"), F.lit(size))
        part = F.when(F.col("pivot") == pivot, F.floor(place / GROUP)).otherwise(part)
        before += size
    return asked.withColumn("part", part.cast("long"))


def _numbered(rows: DataFrame, schema: str, size: int, total: int, name: str) -> DataFrame:
    """Rows sorted by pivot and distance, with the number of the run of ``size`` rows they are in."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        task, seen = TaskContext.get().partitionId(), 0
        for frame in frames:
            frame[name] = (task << 32) + (seen + np.arange(len(frame))) // size
            seen += len(frame)
            yield frame

    tasks = max(1, math.ceil(total / size))
    # The id parts a large run of equal vectors into several ranges.
    order = ("pivot", "distance", "id")
    return (
        rows.repartitionByRange(tasks, *order)
        .sortWithinPartitions(*order)
        .mapInPandas(run, f"{schema}, {name} long")
    )


def _search(asked, kept, pivots, top, k, slack, wide) -> pd.DataFrame:
    """The k best of a shard for each query of a group, but for those a query's bound excludes, and
    how many vectors each query was compared with."""
    kept = kept.sort_values(["pivot", "distance"], kind="stable")
    ids, x = kept["id"].to_numpy(), _matrix(kept["x"], wide)
    pivot, distance = kept["pivot"].to_numpy(), kept["distance"].to_numpy()
    starts = np.flatnonzero(np.diff(pivot, prepend=-1))
    ends = np.append(starts[1:], len(pivot))
    queries = _matrix(asked["x"], wide)
    away = _distances(_lifted(queries, None), pivots)
    squares = (queries * queries).sum(1)
    out = []
    for i, own in enumerate(asked["id"]):
        bound = asked["bound"].iloc[i]
        bound = None if pd.isna(bound) else int(bound)
        best, compared = np.zeros((0, 2), x.dtype), 0
        # Annuli not visited yet, one inwards and one outwards of each pivot, by their lower bound.
        fronts = []
        for start, end in zip(starts, ends, strict=True):
            at = away[i, pivot[start]]
            middle = start + int(np.searchsorted(distance[start:end], at))
            if middle > start:
                fronts.append([at - distance[middle - 1], start, middle, -1, at])
            if middle < end:
                fronts.append([distance[middle] - at, middle, end, 1, at])
        while fronts:
            nearest = min(range(len(fronts)), key=lambda f: fronts[f][0])
            gap, start, end, way, at = fronts[nearest]
            if gap > _radius(int(squares[i]), bound, top, slack):
                break
            if way > 0:
                stop = min(end, start + VISIT)
                span = slice(start, stop)
                rest = [distance[stop] - at, stop, end, way, at] if stop < end else None
            else:
                stop = max(start, end - VISIT)
                span = slice(stop, end)
                rest = [at - distance[stop - 1], start, stop, way, at] if stop > start else None
            if rest:
                fronts[nearest] = rest
            else:
                fronts.pop(nearest)
            scores = x[span] @ queries[i]
            compared += len(scores)
            usable = ids[span] != own
            if bound is not None:
                usable &= (scores >= bound).astype(bool)
            rows = np.stack([scores[usable], ids[span][usable]], 1)
            best = np.concatenate([best, rows])
            best = best[_best(best[:, 0], best[:, 1], k)]
            if len(best) == k:
                bound = int(best[-1, 0]) if bound is None else max(bound, int(best[-1, 0]))
        scores = [Decimal(s) if wide else int(s) for s in best[:, 0]]
        out += [(own, int(id_), s, None) for id_, s in zip(best[:, 1], scores, strict=True)]
        out.append((own, None, None, compared))
    names = ["query_id", "id", "score", "compared"]
    table = pd.DataFrame(out, columns=names, dtype=object)
    whole = ["query_id", "id", "compared"] if wide else names
    return table.astype(dict.fromkeys(whole, "Int64"))
