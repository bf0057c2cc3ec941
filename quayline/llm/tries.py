"""The prefix trie of a table of conversations.

A conversation becomes the array of its turns' digests; arrays are sorted across tasks, so that the
conversations below a node of the trie follow each other.  The sorted list is cut into blocks, and
every block is made into a forest by itself: edges between neighbours, as deep as their longest common
prefix (LCP), are taken in descending depth, and a union-find merges the two components an edge
joins.  A merge makes the branching node of that depth; the depths between a component's top and
the edge that takes it up are nodes with one child.

A node may go on in the next block only if it holds the block's first or last conversation and is not
deeper than the LCP across that boundary.  Such open nodes, at most two a depth and block, are all
that leaves a block's forest unfinished: each is contracted to the key of its prefix and to sums, and
those of equal keys are merged.  All figures of a node are sums over its conversations of what each
adds to the one before it, known from the LCP, so that nothing is counted twice across a boundary.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayline.llm.common import staged
from quayline.operators.ordering import dense_positions

# Conversations that are made into a forest at a time.
BLOCK = 512
DIGEST_BYTES = 16
NOTHING = hashlib.sha256().hexdigest()

TURNS = "array<struct<digest: binary, bytes: int>>"
NODES = (
    "depth long, key binary, parent_key binary, conv_id long, parent_conv_id long, n_convs long, "
    "n_children long, n_leaves long, saved_tokens long, n_ends long, ends_sha256 string, "
    "ends string, block long"
)


def conversations(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` to ``conv_id, turns``: the digests of a conversation's turns, and
    the bytes of their texts, by turn.

    A null turn comes first, turns of one number follow by digest.  A null role or text counts as empty.
    Rows without ``conv_id`` belong to no conversation.  A conversation is a row of some 20 bytes a
    turn, which has to fit a task as any row does.
    """
    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    whole = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)
    turn = F.struct(
        "turn",
        F.unhex(F.substring(whole, 1, 2 * DIGEST_BYTES)).alias("digest"),
        F.octet_length(text).alias("bytes"),
    )
    listed = rows.filter("conv_id IS NOT NULL").select(F.col("conv_id").cast("long"), turn.alias("t"))
    grouped = listed.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    bare = F.transform(
        "turns", lambda t: F.struct(t["digest"].alias("digest"), t["bytes"].alias("bytes"))
    )
    return grouped.select("conv_id", bare.alias("turns"))


def continued(convs: DataFrame, source: Column, taken: Column, most: int) -> DataFrame:
    """Conversations rebuilt: the first ``taken`` turns, at most ``most``, of the conversation ``source``
    (none if there is no such one), then their own behind as many."""
    heads = convs.select(
        F.col("conv_id").alias("_source"), F.slice("turns", 1, most).alias("_head")
    )
    none = F.array().cast(TURNS)
    own = F.slice("turns", taken + 1, F.greatest(F.size("turns") - taken, F.lit(0)))
    first = F.slice(F.coalesce("_head", none), F.lit(1), taken)
    return convs.join(heads, source == F.col("_source"), "left").select(
        "conv_id", F.concat(first, own).alias("turns")
    )


def _common(ids: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Of every two neighbours among sequences, given one behind the other, how many first ids agree."""
    sizes = np.diff(offsets)
    shorter = np.minimum(sizes[:-1], sizes[1:])
    ends = np.cumsum(shorter)
    place = np.arange(shorter.sum()) - np.repeat(ends - shorter, shorter)
    a = ids[np.repeat(offsets[:-2], shorter) + place]
    b = ids[np.repeat(offsets[1:-1], shorter) + place]
    other = np.flatnonzero(a != b)
    pair, first = np.unique(np.searchsorted(ends, other, side="right"), return_index=True)
    common = shorter.copy()
    common[pair] = place[other[first]]
    return common


class _Forest:
    """Branching nodes and ends of sorted conversations, by union-find over the edges between them."""

    def __init__(self, conv: list[int], sizes: list[int], common: np.ndarray) -> None:
        n = len(conv)
        # Of components, by their representative.
        self.above = list(range(n))
        self.low, self.high = list(range(n)), list(range(1, n + 1))
        self.top, self.least, self.node = list(sizes), list(conv), [-1] * n
        # Of nodes: members, depth, depth of the branching node above, that node, children inside.
        self.nodes: list[list[int]] = []
        for edge in np.argsort(-common, kind="stable"):
            self._merge(int(edge), int(edge) + 1, int(common[edge]), sizes)
        last = self._find(0)
        if self.top[last] > 0:
            root = self._new(0)
            self._close(last, root, 0)
            self.top[last], self.node[last] = 0, root
        self._close(last, -1, -1)

    def _find(self, i: int) -> int:
        while self.above[i] != i:
            self.above[i] = self.above[self.above[i]]
            i = self.above[i]
        return i

    def _new(self, depth: int) -> int:
        self.nodes.append([0, 0, depth, 0, -1, 0, 0])
        return len(self.nodes) - 1

    def _own(self, c: int) -> int:
        if self.node[c] < 0:
            self.node[c] = self._new(self.top[c])
        return self.node[c]

    def _close(self, c: int, parent: int, depth: int) -> None:
        """Component ``c`` has all its members below ``depth``: enter them at its top node."""
        node = self.nodes[self._own(c)]
        node[0], node[1], node[3], node[4] = self.low[c], self.high[c], depth, parent
        node[6] = self.least[c]

    def _merge(self, i: int, j: int, depth: int, sizes: list[int]) -> None:
        """Join the components of neighbours ``i`` and ``j`` at ``depth``."""
        a, b = self._find(i), self._find(j)
        if self.top[a] == depth:
            target = self._own(a)
        elif self.top[b] == depth:
            target = self._own(b)
        else:
            target = self._new(depth)
        for c in (a, b):
            if self.top[c] > depth:
                self._close(c, target, depth)
        # The component of ``j`` is a child of its own, unless its first conversation ends here.
        self.nodes[target][5] += sizes[j] > depth
        if self.high[a] - self.low[a] < self.high[b] - self.low[b]:
            a, b = b, a
        self.above[b] = a
        self.low[a], self.high[a] = min(self.low[a], self.low[b]), max(self.high[a], self.high[b])
        self.least[a] = min(self.least[a], self.least[b])
        self.top[a], self.node[a] = depth, target


def _prefix_keys(digests: list[bytes], depth: int) -> list[bytes]:
    """The key of each prefix up to ``depth`` turns."""
    keys, chain = [], hashlib.sha256()
    for d in range(depth + 1):
        keys.append(chain.digest()[:DIGEST_BYTES])
        if d < depth:
            chain.update(digests[d])
    return keys


def block_nodes(
    block: int, conv: np.ndarray, turns: pa.ListArray, before: bool, behind: bool
) -> pa.RecordBatch:
    """The nodes of sorted conversations, with the share of this block in those that are open.

    ``before`` and ``behind`` tell whether the first and the last row are of the blocks around: they
    only say how deep those go on.
    """
    offsets = turns.offsets.to_numpy().astype(np.int64)
    flat = turns.values
    digests = flat.field("digest")
    ids = digests.dictionary_encode().indices.to_numpy() if len(digests) else np.zeros(0, np.int64)
    spent = np.concatenate([[0], np.cumsum(flat.field("bytes").to_numpy(zero_copy_only=False))])
    common = _common(ids, offsets)
    first, last = int(before), len(conv) - int(behind)
    n = last - first
    left = int(common[0]) if before else -1
    right = int(common[-1]) if behind else -1
    conv = conv[first:last]
    starts, sizes = offsets[first:last], np.diff(offsets)[first:last]
    inner = common[first : last - 1]
    forest = _Forest(conv.tolist(), sizes.tolist(), inner)
    low, high, top, attach, parent, kids, least = np.array(forest.nodes, np.int64).T

    # What each conversation adds to the one before it, and whether it is the last at its end.
    up = np.concatenate([[left], inner])
    down = np.concatenate([inner, [right]])
    shared = spent[starts + np.maximum(up, 0)] - spent[starts]
    shared_before = np.concatenate([[0], np.cumsum(shared)])
    leaves_before = np.concatenate([[0], np.cumsum(down < sizes)])
    kids = kids + ((sizes[low] > top) & (up[low] <= top))
    # Equal conversations follow each other; the shortest ones of a node come first.
    fresh = np.flatnonzero((up != sizes) | (np.concatenate([[-1], sizes[:-1]]) != sizes))
    stop = np.concatenate([fresh, [n]])[np.searchsorted(fresh, low, side="right")]
    stop = np.where(sizes[low] == top, np.minimum(stop, high), low)

    # A node, and those with one child above it, up to the branching node it hangs on.
    count = top - attach
    at = np.repeat(np.arange(len(top)), count)
    depth = np.repeat(attach, count) + 1 + np.arange(len(at)) - np.repeat(np.cumsum(count) - count, count)
    lo, hi, is_top = low[at], high[at], depth == top[at]
    prefix = spent[starts[lo] + np.maximum(depth - 1, 0)] - spent[starts[lo]]
    left_open = (lo == 0) & (depth <= left)
    right_open = (hi == n) & (depth <= right)
    saved = shared_before[hi] - shared_before[lo + 1] - (hi - lo - 1) * prefix
    saved = saved + np.where(left_open, shared[lo] - prefix, 0)
    children = np.where(is_top, kids[at], up[lo] <= depth)
    chained = depth - 1 > attach[at]
    above = np.where(chained, at, parent[at])
    parent_open = ((low[above] == 0) & (depth - 1 <= left)) | (
        (high[above] == n) & (depth - 1 <= right)
    )

    def spine(k: int, deep: int) -> list[bytes]:
        begin = int(offsets[k])
        return _prefix_keys(digests[begin : begin + max(deep, 0)].to_pylist(), max(deep, 0))

    left_keys, right_keys = spine(first, left), spine(last - 1, right)

    def key(d: int, on_left: bool) -> bytes:
        return left_keys[d] if on_left and d <= left else right_keys[d]

    opened = left_open | right_open
    keys: list[bytes | None] = [None] * len(at)
    for i in np.flatnonzero(opened):
        keys[i] = key(int(depth[i]), bool(left_open[i]))
    parents: list[bytes | None] = [None] * len(at)
    for i in np.flatnonzero(parent_open & (depth > 1)):
        parents[i] = key(int(depth[i]) - 1, bool(low[above[i]] == 0))
    n_ends = np.where(is_top, stop[at] - lo, 0)
    hashes: list[str | None] = [NOTHING] * len(at)
    texts: list[str | None] = [None] * len(at)
    for i in np.flatnonzero(n_ends):
        listed = ",".join(map(str, conv[lo[i] : lo[i] + n_ends[i]].tolist()))
        if opened[i]:
            texts[i] = listed
        else:
            hashes[i] = hashlib.sha256(listed.encode()).hexdigest()
    return pa.RecordBatch.from_arrays(
        [
            pa.array(depth, pa.int64()),
            pa.array(keys, pa.binary()),
            pa.array(parents, pa.binary()),
            pa.array(least[at], pa.int64()),
            pa.array(least[above], pa.int64()),
            pa.array(hi - lo, pa.int64()),
            pa.array(children, pa.int64()),
            pa.array(leaves_before[hi] - leaves_before[lo], pa.int64()),
            pa.array(saved, pa.int64()),
            pa.array(n_ends, pa.int64()),
            pa.array(hashes, pa.string()),
            pa.array(texts, pa.string()),
            pa.array([block] * len(at), pa.int64()),
        ],
        names=[field.split()[0] for field in NODES.split(", ")],
    )


def _forests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows by block and position to the nodes of each block."""

    def pieces() -> Iterator[tuple[int, pa.RecordBatch]]:
        for batch in batches:
            blocks = batch.column("block").to_numpy()
            cuts = np.flatnonzero(np.diff(blocks)) + 1
            for start, end in zip([0, *cuts], [*cuts, len(blocks)], strict=True):
                if end > start:
                    yield int(blocks[start]), batch.slice(start, end - start)

    for block, parts in groupby(pieces(), key=lambda piece: piece[0]):
        rows = pa.Table.from_batches([part for _, part in parts]).combine_chunks()
        position = rows.column("position").to_numpy()
        turns = pa.concat_arrays(rows.column("turns").chunks)
        yield block_nodes(
            block,
            rows.column("conv_id").to_numpy(),
            turns,
            bool(position[0] < block * BLOCK),
            bool(position[-1] >= (block + 1) * BLOCK),
        )


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces of the ids that end at a node, by key and block, to one hash a node.  Pieces pass one by
    one: a node may have any number of them."""
    now, chain = None, None

    def done() -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict(
            {"key": pa.array([now], pa.binary()), "ends_sha256": [chain.hexdigest()]}
        )

    for batch in batches:
        for k, text in zip(*(batch.column(c).to_pylist() for c in ("key", "ends")), strict=True):
            if k == now:
                chain.update(b",")
            else:
                if now is not None:
                    yield done()
                now, chain = k, hashlib.sha256()
            chain.update(text.encode())
    if now is not None:
        yield done()


def prefix_trie(convs: DataFrame) -> DataFrame:
    """``conv_id, turns`` (see ``conversations``) to the nodes of their trie.

    A node is a sequence of first turns that some conversation has, the root that of none; it has as
    members all conversations that start with it.  Columns: ``conv_id``, the smallest member;
    ``depth``; ``parent_conv_id``, its parent's ``conv_id`` (null for the root); ``n_convs``, members;
    ``n_children``; ``n_leaves``, nodes without children in its subtree, itself included;
    ``saved_tokens``, over its subtree, members but one times the bytes of the last text;
    ``n_ends`` and ``ends_sha256``, members of just that many turns, and the hash of their ids, ascending
    and joined by commas.  ``conv_id`` and ``depth`` together are a node's identity.

    Turns are told apart by 128 bits of SHA-256.  Conversations without turns are members of the root
    alone.  No conversations, no nodes.
    """
    order = [F.col("turns"), F.col("conv_id")]
    placed = dense_positions(convs.select("conv_id", "turns"), order)
    block, place = F.floor(F.col("position") / BLOCK), F.col("position") % BLOCK
    # The ends of a block are also shown to the blocks around it.
    shown = F.array_compact(
        F.array(
            block,
            F.when((place == 0) & (block > 0), block - 1),
            F.when(place == BLOCK - 1, block + 1),
        )
    )
    spread = placed.withColumn("block", F.explode(shown)).select("block", "position", "conv_id", "turns")
    # A last block that is shown the end of the one before it, but has no row, is none.
    total, root = convs.agg(F.count(F.lit(1)), F.min("conv_id")).first()
    spread = spread.filter(F.col("block") * BLOCK < total)
    sorted_rows = spread.repartition("block").sortWithinPartitions("block", "position")
    parts = staged(sorted_rows.mapInArrow(_forests, NODES), "forests")

    sums = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens", "n_ends")]
    opened = parts.filter("key IS NOT NULL")
    merged = staged(
        opened.groupBy("key", "depth").agg(
            F.max("parent_key").alias("parent_key"), F.min("conv_id").alias("conv_id"), *sums
        ),
        "merged",
    )
    ends = opened.filter("ends IS NOT NULL").select("key", "block", "ends")
    hashes = (
        ends.repartition("key")
        .sortWithinPartitions("key", "block")
        .mapInArrow(_hashed, "key binary, ends_sha256 string")
    )
    names = merged.select(F.col("key").alias("_key"), F.col("conv_id").alias("_parent_conv_id"))
    merged = merged.join(hashes, "key", "left").withColumn(
        "ends_sha256", F.coalesce("ends_sha256", F.lit(NOTHING))
    )

    def columns(parent: Column) -> list[Column]:
        # The root is the parent of every first turn.
        at_root = F.when(F.col("depth") > 1, parent).when(F.col("depth") == 1, F.lit(root))
        return [
            F.col("conv_id"), F.col("depth"), at_root.cast("long").alias("parent_conv_id"),
            *[F.col(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens", "n_ends")],
            F.col("ends_sha256"),
        ]

    closed = parts.filter("key IS NULL")
    inside = closed.filter("parent_key IS NULL").select(*columns(F.col("parent_conv_id")))
    shared = [c for c in merged.columns if c != "key"]
    outside = closed.filter("parent_key IS NOT NULL").select(*shared).unionByName(merged.select(*shared))
    outside = outside.join(names, F.col("parent_key") == F.col("_key"), "left")
    return inside.unionByName(outside.select(*columns(F.col("_parent_conv_id"))))
