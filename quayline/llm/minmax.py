"""Near-duplicate detection by min-max hashing.

Every shingle hash is permuted by a number of odd factors; of each permutation both the least and the
greatest value are kept.  Either agrees between two sets with the chance of their resemblance, so a
permutation gives two values of the signature.  The signature is cut into bands, and sets that agree
in all values of a band share a bucket.

Texts with equal sets are one class, found by a hash of the set, before anything is compared.
Buckets with the same members are compared once.  Within a bucket, links are confirmed on the full
sets by a breadth-first walk: each set met is compared with those not yet reached only, so that a
bucket of one family is settled in about one pass and yet every link between different components
would be found.  What a bucket gives is a star per component, never its pairs.  A bucket too large
for a task is cut into chunks, and each two chunks are walked together.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayline.llm.common import slices, staged, with_row_keys
from quayline.llm.components import connected_components

ROWS = 8
MISSED = 1e-5
# Members, and shingles, of a chunk of a bucket.
CHUNK_SETS = 512
CHUNK_SHINGLES = 2_000_000


def bands_for(similarity: float, rows: int = ROWS, missed: float = MISSED) -> int:
    """Bands of ``rows`` values that leave a pair at ``similarity`` unseen with chance ``missed``."""
    return math.ceil(math.log(missed) / math.log(1 - similarity**rows))


def multipliers(count: int, seed: int = 11) -> np.ndarray:
    """Odd 64-bit factors: multiplying by one permutes the hashes."""
    return np.random.default_rng(seed).integers(0, 1 << 64, count, np.uint64) | np.uint64(1)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A fixed permutation of 64-bit numbers that spreads every bit over all of them."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Sets of hashed word shingles of texts: A-Z lower-cased, words between white space."""

    def __init__(self, words: int, seed: int = 5) -> None:
        rng = np.random.default_rng(seed)
        self.words = words
        letters = rng.integers(0, 1 << 64, 256, np.uint64)
        letters[65:91] = letters[97:123]
        self.letters = letters
        self.base = rng.integers(0, 1 << 64, 1, np.uint64)[0] | np.uint64(1)
        self.places = multipliers(words, seed + 1)
        self.powers = np.ones(1, np.uint64)
        gaps = np.zeros(256, bool)
        gaps[[9, 10, 11, 12, 13, 32]] = True
        self.gaps = gaps

    def _powers(self, count: int) -> np.ndarray:
        while len(self.powers) < count:
            step = np.uint64(pow(int(self.base), len(self.powers), 1 << 64))
            self.powers = np.concatenate([self.powers, self.powers * step])
        return self.powers

    def hashes(self, text: str | None) -> np.ndarray:
        """Distinct shingle hashes in ascending order; none without words.  A text of fewer words
        than a shingle is one shingle."""
        data = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)
        inside = np.flatnonzero(~self.gaps[data])
        if not len(inside):
            return np.zeros(0, np.uint64)
        starts = np.flatnonzero(np.diff(inside, prepend=-2) != 1)
        lengths = np.diff(np.append(starts, len(inside)))
        place = np.arange(len(inside)) - np.repeat(starts, lengths)
        values = self.letters[data[inside]] * self._powers(int(lengths.max()))[place]
        word = _mixed(np.add.reduceat(values, starts) + lengths.astype(np.uint64))
        n = max(1, len(word) - self.words + 1)
        found = np.full(n, np.uint64(min(len(word), self.words)))
        for i in range(min(self.words, len(word))):
            found = _mixed(found + word[i : i + n] * self.places[i])
        return np.unique(found)


def min_max(hashes: np.ndarray, factors: np.ndarray, run: int = 2048) -> np.ndarray:
    """For every factor the least, then for every factor the greatest, permuted hash."""
    low = np.full(len(factors), np.iinfo(np.uint64).max, np.uint64)
    high = np.zeros(len(factors), np.uint64)
    for start in range(0, len(hashes), run):
        permuted = factors[:, None] * hashes[None, start : start + run]
        np.minimum(low, permuted.min(axis=1), out=low)
        np.maximum(high, permuted.max(axis=1), out=high)
    return np.concatenate([low, high])


def band_keys(signature: np.ndarray, bands: int, rows: int = ROWS) -> np.ndarray:
    """A key for each band; a band's values stand ``bands`` places apart, so that the minimum and the
    maximum of one permutation never meet in a band unless there are more rows than bands."""
    parts = signature[: bands * rows].reshape(rows, bands)
    key = np.arange(1, bands + 1, dtype=np.uint64)
    for part in parts:
        key = _mixed(key * np.uint64(0x9E3779B97F4A7C15) + part)
    return key.view(np.int64)


def set_key(hashes: np.ndarray) -> bytes:
    """128 bits that stand for a set."""
    return hashlib.blake2b(hashes.tobytes(), digest_size=16).digest()


def sketches(docs: DataFrame, words: int, percent: int, key: str) -> DataFrame:
    """``doc_id``, ``row`` (the column ``key``), ``n_shingles``, ``node`` (key of the set; null without
    shingles), ``bands``."""
    bands = bands_for(percent / 100)
    count = math.ceil(bands * ROWS / 2)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, factors = Shingler(words), multipliers(count)
        for batch in slices(batches):
            sizes, nodes, keys = [], [], []
            for text in batch.column("text").to_pylist():
                found = shingler.hashes(text)
                sizes.append(len(found))
                nodes.append(set_key(found) if len(found) else None)
                keys.append(band_keys(min_max(found, factors), bands) if len(found) else None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("row"),
                    pa.array(sizes, pa.int64()),
                    pa.array(nodes, pa.binary()),
                    pa.array(keys, pa.list_(pa.int64())),
                ],
                names=["doc_id", "row", "n_shingles", "node", "bands"],
            )

    return docs.select("doc_id", F.col(key).cast("long").alias("row"), "text").mapInArrow(
        run, "doc_id long, row long, n_shingles long, node binary, bands array<long>"
    )


def _walk(sets: list[np.ndarray], percent: int) -> list[int]:
    """For each set the least place of a set in its component, links being pairs with
    100 * intersection >= percent * union."""
    root = [-1] * len(sets)
    sizes = np.array([len(s) for s in sets])
    waiting = np.arange(len(sets))
    while len(waiting):
        first = waiting[0]
        root[first] = int(first)
        waiting = waiting[1:]
        reached = [first]
        while reached and len(waiting):
            one = reached.pop()
            # Only sets of a like size can be linked.
            near = (100 * sizes[waiting] >= percent * sizes[one]) & (
                100 * sizes[one] >= percent * sizes[waiting]
            )
            tried = waiting[near]
            if not len(tried):
                continue
            ends = np.cumsum(sizes[tried])
            pooled = np.concatenate([sets[i] for i in tried])
            place = np.searchsorted(sets[one], pooled)
            place[place == len(sets[one])] = 0
            hits = sets[one][place] == pooled
            shared = np.diff(np.concatenate([[0], np.cumsum(hits)[ends - 1]]))
            union = sizes[one] + sizes[tried] - shared
            linked = tried[100 * shared >= percent * union]
            for i in linked:
                root[i] = int(first)
            reached.extend(linked)
            waiting = waiting[~np.isin(waiting, linked)]
    return root


def _links(members: DataFrame, docs: DataFrame, words: int, percent: int, key: str) -> DataFrame:
    """Links ``a``, ``b`` between keys of sets that share a chunk; a star for each component.  The text
    of a set is that of its ``row``, one text for each member."""
    texts = docs.select(F.col(key).cast("long").alias("_row_of_text"), "text")
    placed = members.join(texts, F.col("row") == F.col("_row_of_text")).select(
        "chunk", "node", "text"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(words)

        def rows():
            for batch in slices(batches):
                columns = (batch.column(c).to_pylist() for c in ("chunk", "node", "text"))
                yield from zip(*columns, strict=True)

        for _, group in groupby(rows(), key=lambda r: r[0]):
            found = {}
            for _, node, text in group:
                if node not in found:
                    found[node] = shingler.hashes(text)
            nodes = sorted(found)
            root = _walk([found[n] for n in nodes], percent)
            pairs = [(nodes[i], nodes[r]) for i, r in enumerate(root) if i != r]
            if pairs:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([p[0] for p in pairs]), pa.array([p[1] for p in pairs])],
                    names=["a", "b"],
                )

    # Chunks are bounded, so no task can be handed more than its share by one key.
    return placed.repartition("chunk").sortWithinPartitions("chunk").mapInArrow(
        run, "a binary, b binary"
    )


def _crossing(placed: DataFrame, roots: DataFrame) -> DataFrame:
    """Members of buckets of several chunks, in cells in which sets of different components meet.

    ``placed`` has ``key``, ``node``, ``row``, ``n``, ``chunks``, ``own`` (the chunk of a set), ``roots`` the
    components found within chunks.  What is not in a bucket's largest component is cut into chunks
    anew; each of those meets each chunk of the largest one, and each other.  A bucket of one component
    needs none of this, one of a large component and a few others little more than its members.
    """
    named = placed.join(roots, F.col("node") == F.col("vertex"), "left").withColumn(
        "component", F.coalesce("root", "node")
    )
    parts = named.groupBy("key", "component").agg(
        F.count(F.lit(1)).alias("sets"), F.sum("n").alias("shingles")
    )
    mixed = (
        parts.groupBy(F.col("key").alias("_key"))
        .agg(
            F.count(F.lit(1)).alias("components"),
            F.max(F.struct("sets", "component", "shingles")).alias("largest"),
            F.sum("sets").alias("sets"),
            F.sum("shingles").alias("shingles"),
        )
        .filter("components > 1")
        .select(
            "_key",
            F.col("largest.component").alias("_largest"),
            F.greatest(
                F.ceil((F.col("sets") - F.col("largest.sets")) / CHUNK_SETS),
                F.ceil((F.col("shingles") - F.col("largest.shingles")) / CHUNK_SHINGLES),
            ).cast("int").alias("others"),
        )
    )
    named = named.join(mixed, F.col("key") == F.col("_key"))
    other = F.pmod(F.xxhash64("node", F.lit(1)), F.col("others")).cast("int")

    def cells(most: str, cell: Callable[[Column], Column]) -> Column:
        return F.transform(F.sequence(F.lit(0), F.col(most) - 1), cell)

    in_largest = cells("others", lambda r: F.xxhash64("key", F.col("own"), r))
    with_largest = cells("chunks", lambda g: F.xxhash64("key", g, other))
    among = cells(
        "others", lambda r: F.xxhash64("key", F.least(other, r), F.greatest(other, r), F.lit("among"))
    )
    meets = F.when(F.col("component") == F.col("_largest"), in_largest)
    return named.select(
        "node", "row", F.explode(meets.otherwise(F.concat(with_largest, among))).alias("chunk")
    )


def near_duplicates(
    docs: DataFrame, words: int = 5, percent: int = 80, key: str | None = None
) -> DataFrame:
    """``docs`` (``doc_id``, ``text``; other columns are ignored) to ``doc_id``, ``n_shingles``,
    ``component_id`` and ``kept``.

    Documents are linked when 100 times the shared shingles are at least ``percent`` times all
    shingles of both.  ``component_id`` is the least id reachable by links, ``kept`` whether it is
    the document's own.  A null text, or one without words, has no shingles and is linked to
    nothing.  Null ids take part but are never the least unless all of a component are null: then its
    ``component_id`` is null and all its rows are kept, copies as well, as no id tells them apart.
    Rows that repeat an id are all kept or all not.  An empty table gives none.  A pair exactly at the
    limit escapes all bands with a chance of ``MISSED``.

    ``key`` is a column of numbers, no two alike, that tells rows apart; without one rows are numbered.
    """
    if key is None:
        key = "_minmax_row"
        docs = with_row_keys(docs, key)
    found = staged(sketches(docs, words, percent, key), "sketches")
    classes = (
        found.filter("node is not null")
        .groupBy("node")
        .agg(
            F.min("doc_id").alias("id"),
            F.min("row").alias("row"),
            F.count(F.lit(1)).alias("copies"),
            F.max("n_shingles").alias("n"),
            F.first("bands").alias("bands"),
        )
    )
    banded = classes.select("node", "row", "n", F.explode("bands").alias("key"))
    buckets = (
        banded.groupBy("key")
        .agg(
            F.count(F.lit(1)).alias("members"),
            F.sum("n").alias("shingles"),
            F.expr("bit_xor(xxhash64(node))").alias("x"),
            F.expr("bit_xor(xxhash64(node, 1))").alias("y"),
        )
        .filter("members > 1")
        .groupBy("members", "x", "y")
        .agg(F.min("key").alias("_key"), F.max("shingles").alias("shingles"))
    )
    chunks = F.greatest(
        F.ceil(F.col("members") / CHUNK_SETS), F.ceil(F.col("shingles") / CHUNK_SHINGLES)
    ).cast("int")
    own = F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int")
    placed = staged(
        banded.join(buckets.select("_key", chunks.alias("chunks")), F.col("key") == F.col("_key"))
        .select("key", "node", "row", "n", "chunks", own.alias("own")),
        "placed",
    )
    # Sets of a bucket first meet within their chunks, each in one; then those that are not connected.
    once = placed.select("node", "row", F.xxhash64("key", "own").alias("chunk"))
    links = staged(_links(once, docs, words, percent, key), "links")
    wide = placed.filter("chunks > 1")
    if not wide.isEmpty():
        crossing = _crossing(wide, connected_components(links))
        links = links.unionByName(_links(crossing, docs, words, percent, key))
    # Links also tie classes whose texts are equal sets: those need none, they are one node.
    roots = connected_components(links)
    named = classes.select("node", "id", "copies").join(
        roots, F.col("node") == F.col("vertex"), "left"
    )
    named = staged(
        named.filter("copies > 1 or root is not null").select(
            "node", "id", F.coalesce("root", "node").alias("root")
        ),
        "classes",
    )
    least = named.groupBy("root").agg(F.min("id").alias("least")).withColumnRenamed("root", "_root")
    named = named.join(least, F.col("root") == F.col("_root")).select(
        F.col("node").alias("_node"), "least"
    )
    component = F.coalesce("least", "doc_id")
    return found.select("doc_id", "n_shingles", "node").join(
        named, F.col("node") == F.col("_node"), "left"
    ).select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"),
    )
