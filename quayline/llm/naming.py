"""Exact duplicates by deterministic naming of blocks.

A text is cut into blocks of ``BLOCK_BYTES`` bytes.  Blocks are sorted, and the place of a block in the
sort is its integer name: equal blocks, and only those, share one.  Then the names of adjacent blocks
are paired and the pairs are sorted and named in the same way, until every text is down to one name.
A name of round r stands for one sequence of up to 2^r blocks, so that round and name together are
the identity of a whole text, without a hash that could collide.  DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quayline.llm.common import staged, with_row_keys

BLOCK_BYTES = 8192
# So many of the most frequent keys are grouped by aggregates that are combined before they move;
# any other key has at most one in so many rows, and its rows meet in one task.
FREQUENT = 1024

ROW = "_naming_row"


def _apart(rows: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """``rows`` whose keys are not, and are, among the most frequent ones.  Frequency is that of a hash
    of the keys: keys that share one go the same way."""
    hashed = rows.withColumn("_hash", F.xxhash64(*keys))
    top = hashed.groupBy("_hash").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    top = top.orderBy(F.desc("_n"), "_hash").limit(FREQUENT).select(F.col("_hash").alias("_top"))
    # At most FREQUENT numbers.
    top, same = F.broadcast(staged(top, "top")), F.col("_hash") == F.col("_top")
    return (
        hashed.join(top, same, "left_anti").drop("_hash"),
        hashed.join(top, same, "left_semi").drop("_hash"),
    )


def _with_groups(frequent: DataFrame, groups: DataFrame, keys: list[str]) -> DataFrame:
    """Frequent rows with what ``groups``, a stored table, has for their keys.  That is a row per
    frequent key, of at most a block, which is broadcast; were there more, because many keys share a
    hash, the tables would be joined by shuffle."""
    table = groups.select(
        *[F.col(k).alias(f"_of_{k}") for k in keys], *[c for c in groups.columns if c not in keys]
    )
    if table.count() <= 2 * FREQUENT:
        table = F.broadcast(table)
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_of_{k}"))
    return frequent.join(table, same).drop(*[f"_of_{k}" for k in keys])


def named(rows: DataFrame, keys: list[str], name: str = "name") -> DataFrame:
    """``rows`` and an integer that rows share exactly if their ``keys`` are equal: the place of their
    first one among the sorted rows of a task.  Frequent keys are sorted once each, and their places
    count downwards from -1."""
    few, frequent = _apart(rows, keys)
    placed = few.repartition(*keys).sortWithinPartitions(*keys)
    placed = placed.withColumn("_at", F.monotonically_increasing_id())
    ours = placed.withColumn(name, F.min("_at").over(Window.partitionBy(*keys))).drop("_at")
    kinds = frequent.select(*keys).distinct().sortWithinPartitions(*keys)
    kinds = staged(kinds.withColumn(name, -1 - F.monotonically_increasing_id()), "frequent")
    return ours.unionByName(_with_groups(frequent, kinds, keys))


def grouped(rows: DataFrame, keys: list[str], aggregates: dict[str, Column]) -> DataFrame:
    """``rows`` and ``aggregates`` of all rows with the same ``keys``."""
    few, frequent = _apart(rows, keys)
    for name, value in aggregates.items():
        few = few.withColumn(name, value.over(Window.partitionBy(*keys)))
    of = frequent.groupBy(*keys).agg(*[v.alias(n) for n, v in aggregates.items()])
    return few.unionByName(_with_groups(frequent, staged(of, "groups"), keys))


def identities(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Every row of ``docs`` as ``row, doc_id, text_sha256, rounds, name``: texts are equal exactly if
    rounds and name are.  ``row`` is a number of its own; a null text counts as empty."""
    content = F.coalesce(F.col(text), F.lit("")).cast("binary")

    def cut(whole: Column) -> Column:
        last = F.greatest(F.ceil(F.length(whole) / BLOCK_BYTES) - 1, F.lit(0)).cast("int")
        starts = F.sequence(F.lit(0), last)
        return F.transform(
            starts, lambda i: F.substring(whole, i * BLOCK_BYTES + 1, F.lit(BLOCK_BYTES))
        )

    # The one-element array binds the bytes to a name, so that they are made once a text.
    blocks = F.transform(F.array(content), cut)[0]
    texts = with_row_keys(docs, ROW).select(
        F.col(ROW).alias("row"), F.col(doc_id).alias("doc_id"), F.sha2(content, 256).alias("sha"),
        F.greatest(F.ceil(F.length(content) / BLOCK_BYTES), F.lit(1)).alias("n"),
        F.posexplode(blocks).alias("pos", "block"),
    )
    # What belongs to the whole text goes with its first block.
    first = F.col("pos") == 0
    rows = texts.withColumn("doc_id", F.when(first, F.col("doc_id"))).withColumn(
        "text_sha256", F.when(first, F.col("sha"))
    )
    names = staged(named(rows.drop("sha"), ["block"]).drop("block"), "names")
    longest = names.agg(F.max("n")).first()[0] or 1

    def done(rounds: int) -> DataFrame:
        return names.filter("n = 1").select(
            "row", "doc_id", "text_sha256", F.lit(rounds).alias("rounds"), "name"
        )

    rounds, found = 0, done(0)
    while longest > 1:
        half = F.col("pos") % 2
        pairs = (
            names.filter("n > 1")
            .groupBy("row", F.floor(F.col("pos") / 2).alias("pos"))
            .agg(
                F.max("doc_id").alias("doc_id"),
                F.max("text_sha256").alias("text_sha256"),
                F.max(F.ceil(F.col("n") / 2)).alias("n"),
                F.max(F.when(half == 0, F.col("name"))).alias("left"),
                F.max(F.when(half == 1, F.col("name"))).alias("right"),
            )
        )
        pairs = staged(pairs, "pairs")
        names = staged(named(pairs, ["left", "right"]).drop("left", "right"), "names")
        longest, rounds = -(-longest // 2), rounds + 1
        found = found.unionByName(done(rounds))
    return found


def exact_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id, keep_id, group_size, kept, text_sha256, rounds, name``.

    Texts are equal if their bytes are.  Of equal texts the row with the largest ``doc_id`` stays; of
    rows that share it, one.  Null ids come before all others, so that ``keep_id`` is null only
    where no row of the group has an id.  A null text counts as empty, and empty texts are equal.  Texts
    may have any length that Spark can hold; an empty table gives no rows; other columns of ``docs``
    are ignored.
    """
    stays = F.max(F.struct("doc_id", "row"))
    found = grouped(
        identities(docs, doc_id, text),
        ["rounds", "name"],
        {"stays": stays, "group_size": F.count(F.lit(1))},
    )
    return found.select(
        F.col("doc_id"),
        F.col("stays.doc_id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("stays.row")).alias("kept"),
        "text_sha256",
        "rounds",
        "name",
    )
