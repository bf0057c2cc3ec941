"""Secret scanning in DataFrame functions only: known shapes, and a battery of randomness tests.

Known shapes are regular expressions.  Beside them, every long token of key-like characters is put
through three tests in the alphabet its encoding suggests.  The null hypothesis of each is *written
or structured text*, so that small p-values speak for random keys:

* chi-squared: the symbols are as uneven as letters of text (their chance of coincidence is at least
  ``COINCIDENCE``, or one and a half times that of the alphabet);
* runs: the kind of symbol (lower case, upper case, digit, mark) changes as seldom as in words;
* serial correlation: neighbouring symbols are correlated by at least ``CORRELATION``.

Each p-value is bounded by the Gaussian tail bound exp(-z²/2)/2, and the three are combined by
Fisher's method.  Which combined p-values count is decided by a Benjamini-Hochberg step in each class
of lengths, over all distinct tokens of the corpus: a histogram of p-values, rounded up to the edge
of their bin, stands for the sorted list, so that only a few hundred counts are gathered.
"""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quayline.llm.bottomk import _let
from quayline.llm.common import staged

# The base shapes, in the order of their kinds.
ASSIGN = (
    r"(?i)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS = "AKIA[A-Z0-9]{16,}"
HEX = "[0-9a-f]{24,}"
ASSIGN_LEAST = 6
KINDS = ("assign", "access", "hex", "random")

# Tokens put through the tests.
TOKEN = "[A-Za-z0-9+/_=-]{20,}"
COINCIDENCE = 0.065
CHANGES = 0.15
CORRELATION = 0.3
# Length classes begin here; bins of -log10(p), and the last of them.
CLASSES = (20, 32, 48, 64)
BINS_PER_DECADE = 20
LAST_BIN = 1200
FALSE_DISCOVERIES = 0.01

MARKS = "+/-_="
ALPHABETS = (
    ("^[0-9]+$", string.digits),
    ("^[0-9a-f]+$", "0123456789abcdef"),
    ("^[0-9A-F]+$", "0123456789ABCDEF"),
    ("^[a-z]+$", string.ascii_lowercase),
    ("^[A-Z]+$", string.ascii_uppercase),
    ("^[A-Z2-7=]+$", string.ascii_uppercase + "234567"),
    ("^[a-z0-9]+$", string.ascii_lowercase + string.digits),
    ("^[A-Z0-9]+$", string.ascii_uppercase + string.digits),
)
WIDEST = string.ascii_uppercase + string.ascii_lowercase + string.digits + "+/"


# Values folded at a time: an array that grows by one is copied each time.
FOLD = 256


def _running(values: Column, join: Callable[[Column, Column], Column]) -> Column:
    """Each of the integers joined with all before it, as sums or maxima: block by block, then what the
    blocks before add.  The work grows with the number of values, but for a small square."""
    empty = F.array().cast("array<int>")

    def fold(block: Column) -> Column:
        def step(done: Column, value: Column) -> Column:
            last = F.get(done, F.size(done) - 1)
            one = F.when(last.isNull(), value).otherwise(join(last, value))
            return F.concat(done, F.array(one))

        return F.aggregate(block, empty, step)

    def joined(blocks: Column) -> Column:
        def carry(before: Column) -> Column:
            def whole(block: Column, number: Column) -> Column:
                last = F.get(before, number - 1)
                return F.when(number == 0, block).otherwise(
                    F.transform(block, lambda value: join(last, value))
                )

            return F.flatten(F.transform(blocks, whole))

        return _let(fold(F.transform(blocks, lambda b: F.element_at(b, -1))), carry)

    numbers = F.sequence(F.lit(0), F.floor((F.size(values) - 1) / FOLD).cast("int"))
    blocks = F.transform(numbers, lambda i: fold(F.slice(values, i * FOLD + 1, F.lit(FOLD))))
    return F.when(F.size(values) > 0, _let(blocks, joined)).otherwise(empty)


def located(text: Column, pattern: str, last: int | None = None) -> Column:
    """Matches of ``pattern``, which must not match nothing, as structs ``start``, ``end`` (code
    points, end exclusive) and ``value`` (of group ``last``, or the whole match)."""

    def place(found: Column) -> Column:
        # What lies between matches is as long as the text between them: split at the same pattern.
        gaps = F.split(text, pattern, -1)
        values = found if last is None else F.regexp_extract_all(text, F.lit(pattern), F.lit(last))
        empty = F.array().cast("array<struct<start:int,end:int,value:string>>")
        sizes = F.zip_with(
            F.slice(gaps, F.lit(1), F.size(found)), found, lambda g, h: F.length(g) + F.length(h)
        )
        ends = _let(sizes, lambda s: _running(s, lambda a, b: a + b))
        steps = F.arrays_zip(ends.alias("end"), found.alias("hit"), values.alias("value"))
        places = F.transform(
            steps,
            lambda s: F.struct(
                (s["end"] - F.length(s["hit"])).alias("start"),
                s["end"].alias("end"),
                s["value"].alias("value"),
            ),
        )
        return F.when(F.size(found) > 0, places).otherwise(empty)

    return _let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), place)


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda s, v: s + v)


def _tail(z: Column) -> Column:
    """An upper bound of the chance of a Gaussian beyond ``z``."""
    return F.when(z > 0, 0.5 * F.exp(-z * z / 2)).otherwise(1.0)


def randomness(token: Column) -> Column:
    """The combined p-value of *written text*, as its negative decimal logarithm."""
    alphabet = F.lit(WIDEST)
    for pattern, symbols in reversed(ALPHABETS):
        alphabet = F.when(token.rlike(pattern), F.lit(symbols)).otherwise(alphabet)
    body = F.translate(F.rtrim(F.translate(token, "=", " ")), "-_ ", "+/")

    def of_body(b: Column) -> Column:
        return _let(alphabet, lambda symbols: _battery(b, symbols))

    return _let(body, of_body)


def _battery(body: Column, symbols: Column) -> Column:
    n = F.length(body).cast("double")
    size = F.length(symbols).cast("double")
    counts = F.transform(
        F.split(symbols, ""),
        lambda s: F.pow((F.length(body) - F.length(F.replace(body, s, F.lit("")))).cast("double"), 2.0),
    )
    chi = size / n * _total(counts) - n
    alike = F.greatest(F.lit(COINCIDENCE), 1.5 / size)
    mean = size * (1 + (n - 1) * alike) - n
    spread = F.sqrt(2 * (size - 1) + 4 * n * (size * alike - 1))
    uneven = _tail((mean - chi) / spread)

    kinds = F.translate(
        body,
        string.ascii_lowercase + string.ascii_uppercase + string.digits + MARKS,
        "a" * 26 + "A" * 26 + "0" * 10 + "+" * len(MARKS),
    )
    changes = F.length(F.regexp_replace(kinds, r"(.)\1*", "r")).cast("double") - 1
    expected = (n - 1) * CHANGES
    runs = _tail((changes - expected) / F.sqrt(expected * (1 - CHANGES)))

    def correlated(v: Column) -> Column:
        mid = _total(v) / n
        square = _total(F.transform(v, lambda x: x * x)) - n * mid * mid
        steps = F.zip_with(
            F.slice(v, F.lit(1), F.size(v) - 1),
            F.slice(v, F.lit(2), F.size(v) - 1),
            lambda a, b: (a - mid) * (b - mid),
        )
        return F.when(square > 0, _total(steps) / square).otherwise(1.0)

    values = F.transform(F.split(body, ""), lambda c: F.instr(symbols, c).cast("double"))
    serial = _let(values, correlated)
    paired = _tail((CORRELATION - F.abs(serial)) * F.sqrt(n))
    # Fisher: the chance of chi-squared with six degrees beyond -2 times the sum of logarithms.
    x = -(F.log(uneven) + F.log(runs) + F.log(paired))
    return F.when(n < 2, 0.0).otherwise(
        F.greatest(F.lit(0.0), (x - F.log(1 + x + x * x / 2)) / F.log(F.lit(10.0)))
    )


def _class_of(length: Column) -> Column:
    return sum(((length >= c).cast("int") for c in CLASSES[1:]), F.lit(0))


def base_spans(text: Column) -> Column:
    """Spans of the known shapes, by start and kind."""

    def kept(number: int, spans: Column, least: int = 0) -> Column:
        return F.transform(
            F.filter(spans, lambda s: F.length(s["value"]) >= least),
            lambda s: F.struct(
                s["start"].alias("start"), F.lit(number).alias("kind"), s["end"].alias("end")
            ),
        )

    return F.sort_array(
        F.concat(
            kept(0, located(text, ASSIGN, 2), ASSIGN_LEAST),
            kept(1, located(text, ACCESS)),
            kept(2, located(text, HEX)),
        )
    )


def tested_tokens(text: Column) -> Column:
    """Long tokens with their class of length and the bin of their combined p-value."""
    return F.transform(
        located(text, TOKEN),
        lambda s: F.struct(
            s["start"].alias("start"),
            s["end"].alias("end"),
            _class_of(F.length(s["value"])).alias("class"),
            F.least(
                F.floor(randomness(s["value"]) * BINS_PER_DECADE), F.lit(LAST_BIN)
            ).cast("int").alias("bin"),
            F.xxhash64(s["value"]).alias("token"),
        ),
    )


def random_spans(tokens: Column, bins: dict[int, int]) -> Column:
    """Spans of the tokens that count as random under ``discovery_bins``."""

    def beyond(t: Column) -> Column:
        limit = F.lit(LAST_BIN + 1)
        for number, least in sorted(bins.items()):
            limit = F.when(t["class"] == number, F.lit(least)).otherwise(limit)
        return t["bin"] >= limit

    return F.transform(
        F.filter(tokens, beyond),
        lambda t: F.struct(t["start"].alias("start"), F.lit(3).alias("kind"), t["end"].alias("end")),
    )


def find_spans(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``base`` and ``tokens``, written to the shared folder without the texts."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return staged(
        docs.select("doc_id", base_spans(text).alias("base"), tested_tokens(text).alias("tokens")),
        "spans",
    )


def discovery_bins(found: DataFrame, rate: float = FALSE_DISCOVERIES) -> dict[int, int]:
    """The least bin that counts as random in each class of lengths, over distinct tokens: the
    largest p-value p with p * tokens <= rate * (tokens with a p-value up to p)."""
    tested = found.select(F.explode("tokens").alias("t")).select("t.class", "t.bin", "t.token")
    bins = tested.distinct().groupBy("class", "bin").agg(F.count(F.lit(1)).alias("n"))
    # A few hundred rows from here on.
    smaller = Window.partitionBy("class").orderBy(F.desc("bin"))
    counted = bins.select(
        "class",
        "bin",
        F.sum("n").over(smaller).alias("up_to"),
        F.sum("n").over(Window.partitionBy("class")).alias("all"),
    )
    chance = F.pow(F.lit(10.0), -F.col("bin") / F.lit(float(BINS_PER_DECADE)))
    passed = counted.filter(chance * F.col("all") <= rate * F.col("up_to"))
    return {r["class"]: r["bin"] for r in passed.groupBy("class").agg(F.min("bin").alias("bin")).collect()}


def scan_secrets(docs: DataFrame, rate: float = FALSE_DISCOVERIES) -> DataFrame:
    """``docs`` (``doc_id``, ``text``; other columns are ignored) to ``doc_id``, ``n_assign``,
    ``n_access``, ``n_hex``, ``n_random``, ``base`` and ``spans``: arrays of structs ``start``,
    ``kind`` (place in ``KINDS``) and ``end``, ordered by start and kind.

    Positions count code points.  A null text is an empty one, with no spans.  Repeated rows give
    repeated results; a token that repeats is tested once for the rate.  An empty table gives none.
    """
    found = find_spans(docs)
    random = random_spans(F.col("tokens"), discovery_bins(found, rate))

    def count(number: int) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == number)).cast("long")

    spans = found.select(
        "doc_id", "base", F.sort_array(F.concat("base", random)).alias("spans")
    )
    return spans.select(
        "doc_id", *[count(i).alias(f"n_{kind}") for i, kind in enumerate(KINDS)], "base", "spans"
    )


def written_spans(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(
                ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string")
            ),
        ),
        ",",
    )


def redacted(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """``text`` with each span, or run of overlapping ones, replaced by ``mark``; ``spans`` are
    ordered by start.

    Pieces are cut from the text in units of four bytes, where a position needs no walk through the
    text: the work grows with the text and the spans, not with their product, and a text with spans
    takes four bytes a code point for the while.
    """

    def cut(starts: Column, tops: Column, units: Column) -> Column:
        def piece(start: Column, stop: Column) -> Column:
            # The mark in front keeps a piece's own first character from being taken for one.
            part = F.substring(units, 4 * start + 1, 4 * (stop - start))
            return F.decode(F.concat(F.unhex(F.lit("0000FEFF")), part), "UTF-32")

        def top(i: Column) -> Column:
            return F.coalesce(F.get(tops, i - 1), F.lit(0))

        # A run begins where a span starts beyond the greatest end so far.
        numbers = F.sequence(F.lit(0), F.size(starts) - 1)
        heads = F.filter(numbers, lambda i: (i == 0) | (F.get(starts, i) >= top(i)))
        pieces = F.transform(heads, lambda i: piece(top(i), F.get(starts, i)))
        rest = piece(F.element_at(tops, -1), F.floor(F.length(units) / 4).cast("int"))
        return F.array_join(F.concat(pieces, F.array(rest)), mark)

    starts = F.transform(spans, lambda s: s["start"])
    tops = _running(F.transform(spans, lambda s: s["end"]), F.greatest)
    changed = _let(
        starts, lambda a: _let(tops, lambda b: _let(F.encode(text, "UTF-32"), lambda u: cut(a, b, u)))
    )
    return F.when(F.size(spans) > 0, changed).otherwise(text)


def redact_secrets(docs: DataFrame, rate: float = FALSE_DISCOVERIES) -> DataFrame:
    """``docs`` with every span in ``text`` replaced by a mark, and ``n_chars``, if it is there, set
    to the new length; all rows and columns stay.  A null text stays null.

    The texts are read twice, first for what counts as random in the corpus; nothing is moved."""
    tokens = staged(
        docs.select(tested_tokens(F.coalesce(F.col("text"), F.lit(""))).alias("tokens")), "tokens"
    )
    bins = discovery_bins(tokens, rate)

    def mark(text: Column) -> Column:
        spans = F.sort_array(F.concat(base_spans(text), random_spans(tested_tokens(text), bins)))
        return _let(spans, lambda found: redacted(text, found))

    changed = docs.withColumn("text", F.when(F.col("text").isNotNull(), mark(F.col("text"))))
    if "n_chars" not in docs.columns:
        return changed
    kind = docs.schema["n_chars"].dataType
    return changed.withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast(kind)).select(
        *docs.columns
    )
