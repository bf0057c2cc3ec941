"""Document fingerprints: the k smallest hashes of a text's shingles, in DataFrame functions only.

A sketch is a sorted array of hashes, each a fixed number of hex digits, so that text order is
number order.  The k smallest hashes of a union are among the k smallest of its parts: sketches of
parts merge into the sketch of the whole.  From two sketches come estimates of resemblance (shared
over all distinct shingles), containment and the number of distinct shingles; all three are exact
where a sketch holds the whole set, that is for fewer than k distinct shingles.
"""

from __future__ import annotations

import math
import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quayline.llm.common import WORD, staged

SIZE = 64
WORDS = 5
DIGITS = 12
# Sketches merged by one task at a time.
FAN_IN = 256


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, also where ``body`` uses it in a lambda."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def shingle_hashes(text: Column, words: int = WORDS) -> Column:
    """Hashes of all runs of ``words`` words, A-Z lower-cased.  A text of fewer words is one shingle;
    a null text or one without words has none."""
    lowered = F.translate(
        F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase
    )

    def hashes(found: Column) -> Column:
        shingles = F.sequence(F.lit(1), F.greatest(F.size(found) - (words - 1), F.lit(1)))
        hashed = F.transform(
            shingles,
            lambda i: F.substring(F.md5(F.concat_ws(" ", F.slice(found, i, words))), 1, DIGITS),
        )
        return F.when(F.size(found) > 0, hashed).otherwise(F.array().cast("array<string>"))

    return _let(F.regexp_extract_all(lowered, F.lit(WORD), F.lit(0)), hashes)


def sketch(text: Column, size: int = SIZE, words: int = WORDS) -> Column:
    """The ``size`` smallest distinct shingle hashes, in ascending order."""
    return F.slice(F.sort_array(F.array_distinct(shingle_hashes(text, words))), 1, size)


def merged(a: Column, b: Column, size: int = SIZE) -> Column:
    """The sketch of two sets together."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, size)


def resemblance(a: Column, b: Column, size: int = SIZE) -> Column:
    """Estimate of shared over all distinct shingles; 1 for two empty sets, 0 if one is empty."""
    union = merged(a, b, size)
    shared = F.size(F.array_intersect(F.array_intersect(a, b), union))
    return F.when(F.size(union) == 0, 1.0).otherwise(shared / F.size(union))


def distinct_shingles(a: Column, size: int = SIZE) -> Column:
    """Estimate of the number of distinct shingles: exact below ``size``, else from how far into the
    range of hashes the last one lies."""
    last = F.conv(F.element_at(a, -1), 16, 10).cast("double")
    guess = F.lit(float(size - 1)) * F.lit(float(16**DIGITS)) / F.greatest(last, F.lit(1.0))
    return F.when(F.size(a) < size, F.size(a).cast("double")).otherwise(guess)


def containment(a: Column, b: Column, size: int = SIZE) -> Column:
    """Estimate of the share of the first set's shingles that the second has; 1 for an empty first
    set."""
    alike, first, second = (
        resemblance(a, b, size), distinct_shingles(a, size), distinct_shingles(b, size)
    )
    shared = alike / (1 + alike) * (first + second)
    return F.when(F.size(a) == 0, 1.0).otherwise(F.least(F.lit(1.0), shared / first))


def merge_sketches(
    parts: DataFrame, key: str, column: str = "fingerprint", size: int = SIZE
) -> DataFrame:
    """One sketch per ``key`` from the sketches of its parts (arrays; null counts as empty).

    A group of any size is merged ``FAN_IN`` sketches at a time, over as many rounds as it takes;
    equal sketches of a key count once from the start.  Sketches are dealt by their hash, so that a
    task that is run again deals them as before.  Other columns are ignored; a null key is a key; an
    empty table gives none.
    """
    rows = staged(
        parts.select(
            F.col(key).alias("_key"),
            F.coalesce(column, F.array().cast("array<string>")).alias("_sketch"),
        ).distinct(),
        "sketches",
    )
    largest = rows.groupBy("_key").count().agg(F.max("count")).first()[0] or 1
    rounds = max(1, math.ceil(math.log(largest, FAN_IN)))
    for step in reversed(range(rounds)):
        salts = max(1, math.ceil(2 * largest ** (step / rounds) - 1))
        salt = F.pmod(F.xxhash64(F.lit(step), "_sketch"), F.lit(salts))
        rows = rows.groupBy("_key", (salt if step else F.lit(0)).alias("_salt")).agg(
            F.slice(F.sort_array(F.array_distinct(F.flatten(F.collect_list("_sketch")))), 1, size)
            .alias("_sketch")
        )
    return rows.select(F.col("_key").alias(key), F.col("_sketch").alias(column))


def _neighbours(docs: DataFrame) -> DataFrame:
    """For every distinct ``doc_id`` the one before it (for the first: the last), and how many code
    points that one replaces.  Null is the least id."""
    ids = staged(
        docs.groupBy("doc_id")
        .agg(F.floor(F.max(F.coalesce(F.length("text"), F.lit(0))) / 4).alias("quarter"))
        .repartitionByRange("doc_id")
        .select("doc_id", "quarter", F.spark_partition_id().alias("part")),
        "ids",
    )
    own = F.struct(F.lit(1).alias("there"), "doc_id", "quarter")
    before = F.lag(own).over(Window.partitionBy("part").orderBy("doc_id"))
    # One row per range of ids; the least of a range has its predecessor in the range before.
    lasts = ids.groupBy("part").agg(
        F.max(F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id", "quarter")).alias("last")
    )
    ranges = Window.orderBy("part")
    whole = Window.orderBy("part").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    lasts = lasts.select(
        "part", F.coalesce(F.lag("last").over(ranges), F.last("last").over(whole)).alias("edge")
    )
    return (
        ids.withColumn("before", before)
        .join(F.broadcast(lasts), "part")
        .select(
            "doc_id",
            F.when(F.col("before.there") == 1, F.col("before.doc_id"))
            .otherwise(F.col("edge.doc_id")).alias("previous"),
            F.when(F.col("before.there") == 1, F.col("before.quarter"))
            .otherwise(F.col("edge.quarter")).alias("wanted"),
        )
    )


def edited_fingerprints(docs: DataFrame, size: int = SIZE, words: int = WORDS) -> DataFrame:
    """Fingerprint every text, its edited text, and compare.

    The edited text has its last quarter (rounded down, in code points) replaced by as many of the
    first code points of the next document in ascending id, or all it has; after the last comes the
    first.  Returns ``doc_id``, ``n_chars``, ``edited_sha256``, ``fingerprint``,
    ``edited_fingerprint``, ``near_edited``, ``near_next``, ``kept_share`` (containment of the text
    in its edited text) and ``n_shingles`` (estimated distinct shingles).

    A null text is an empty one; other columns are ignored.  Rows that share an id are documents of
    their own with the same next document; the next document of a repeated id is its least text.
    A single document follows itself.  An empty table gives no rows.
    """
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    # Plain equality on two columns that are never null, so that joins and sums share a partitioning.
    links = _neighbours(texts).select(
        *_never_null("doc_id", "_none", "_id"), *_never_null("previous", "_before_none", "_before"),
        "wanted",
    )
    placed = (
        texts.select(*_never_null("doc_id", "_none", "_id"), "text")
        .withColumn("_own", _packed(sketch(F.col("text"), size, words)))
        .join(links, ["_none", "_id"])
    )
    start = F.expr("substring(text, 1, cast(wanted as int))")
    following = (
        placed.select(
            F.col("_before_none").alias("_none"),
            F.col("_before").alias("_id"),
            F.struct(start.alias("start"), "_own").alias("_next"),
        )
        .groupBy("_none", "_id")
        .agg(F.min("_next").alias("_next"))
    )
    quarter = F.floor(F.length("text") / 4).cast("int")
    pairs = placed.join(following, ["_none", "_id"]).select(
        F.when(~F.col("_none"), F.col("_id")).alias("doc_id"),
        F.length("text").cast("long").alias("n_chars"),
        _unpacked(F.col("_own")).alias("_own"),
        F.concat(
            F.substring("text", F.lit(1), F.length("text") - quarter),
            F.substring(F.col("_next.start"), F.lit(1), quarter),
        ).alias("_edited"),
        _unpacked(F.col("_next._own")).alias("_next"),
    )
    drawn = pairs.select("*", sketch(F.col("_edited"), size, words).alias("_changed"))
    return drawn.select(
        "doc_id",
        "n_chars",
        F.sha2("_edited", 256).alias("edited_sha256"),
        F.concat_ws("", "_own").alias("fingerprint"),
        F.concat_ws("", "_changed").alias("edited_fingerprint"),
        resemblance(F.col("_own"), F.col("_changed"), size).alias("near_edited"),
        resemblance(F.col("_own"), F.col("_next"), size).alias("near_next"),
        containment(F.col("_own"), F.col("_changed"), size).alias("kept_share"),
        distinct_shingles(F.col("_own"), size).alias("n_shingles"),
    )


def _never_null(column: str, none: str, value: str) -> list[Column]:
    return [
        F.col(column).isNull().alias(none),
        F.coalesce(F.col(column), F.lit(0)).cast("long").alias(value),
    ]


def _packed(hashes: Column) -> Column:
    """A sketch as bytes, half as long as its digits, to be moved."""
    return F.unhex(F.concat_ws("", hashes))


def _unpacked(packed: Column) -> Column:
    def parts(digits: Column) -> Column:
        numbers = F.sequence(F.lit(0), F.floor(F.length(digits) / DIGITS).cast("int") - 1)
        cut = F.transform(numbers, lambda i: F.substring(digits, i * DIGITS + 1, F.lit(DIGITS)))
        return F.when(F.length(digits) > 0, cut).otherwise(F.array().cast("array<string>"))

    return _let(F.lower(F.hex(packed)), parts)
