"""Periodic runs of words.

A run is a stretch of consecutive words that repeats with a smallest period, at least three times and
over at least 24 words, and that no neighbouring word goes on.  Every task looks through the words of
some documents at a time, as one array of integers.  Periods up to ``DIRECT`` are found by comparing
the array with itself at each lag.  Longer ones are found scale by scale: a scale takes the grams of K
words and, of each window of W of them, the one with the least hash.  Inside a run windows one
period apart are equal, so their minimizers are equal grams one period apart, and such pairs are what
is extended, word by word, to both sides.

Scale (lo, hi] is for the periods q with lo < q <= hi = 1.5 lo, with K = hi and W = 2 (lo + 1) - hi + 1:
the first W grams of a run lie within 2 q words, so that the same window one period later lies in
the run, too; and equal grams of q or more words of a run are whole periods apart, so that no equal
one lies between the two.  Hence no run is missed unless two different grams of a text have the same
64-bit hash.  What is found is compared word by word, so nothing else is reported.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayline.llm.common import slices

LEAST_WORDS = 24
LEAST_PERIODS = 3
DIRECT = 16
# Words compared at first when a seed is extended; each further step is twice as long.
STEP = 64

# Odd multipliers of a mixing function, drawn at random.
MIX = [np.uint64(m) for m in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]


def least_length(period: int) -> int:
    return max(LEAST_WORDS, LEAST_PERIODS * period)


def split_words(texts: pa.Array) -> tuple[pa.LargeStringArray, np.ndarray]:
    """The words of all texts in a row, and how many each text has.  A null text has none."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset :][: len(texts) + 1]
    if len(texts) == 0 or bounds[-1] == bounds[0]:
        return pa.array([], pa.large_string()), np.zeros(len(texts), np.int64)
    data = np.frombuffer(texts.buffers()[2], np.uint8)[bounds[0] : bounds[-1]]
    bounds = bounds - bounds[0]
    solid = ~((data == 0x20) | ((data >= 0x09) & (data <= 0x0D)))
    begins, ends = solid.copy(), solid.copy()
    begins[1:] &= ~solid[:-1]
    ends[:-1] &= ~solid[1:]
    # Words of two texts that touch are two words.
    edges = bounds[1:-1]
    edges = edges[(edges > 0) & (edges < len(data))]
    begins[edges] = solid[edges]
    ends[edges - 1] = solid[edges - 1]
    begins, ends = np.flatnonzero(begins), np.flatnonzero(ends)
    offsets = np.zeros(len(begins) + 1, np.int64)
    np.cumsum(ends - begins + 1, out=offsets[1:])
    words = pa.LargeStringArray.from_buffers(
        len(begins), pa.py_buffer(offsets), pa.py_buffer(data[solid])
    )
    return words, np.diff(np.searchsorted(begins, bounds))


def _mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A hash of two hashes each; not symmetric."""
    z = a * MIX[0]
    z ^= z >> np.uint64(31)
    z += b * MIX[1]
    z ^= z >> np.uint64(29)
    z *= MIX[2]
    z ^= z >> np.uint64(32)
    return z


def _minimizers(grams: np.ndarray, window: int) -> np.ndarray:
    """Places that hold the least hash of some ``window`` grams in a row, the leftmost of equal ones.
    The low bits of a hash give way to the place."""
    bits = np.uint64(len(grams).bit_length())
    least = grams >> bits << bits
    least |= np.arange(len(grams), dtype=np.uint64)
    span = 1
    while span < window:
        step = min(span, window - span)
        least = np.minimum(least[:-step], least[step:])
        span += step
    chosen = np.zeros(len(grams), bool)
    chosen[least & ((np.uint64(1) << bits) - np.uint64(1))] = True
    return np.flatnonzero(chosen)


def _same_from(x: np.ndarray, at: int, lag: int) -> int:
    """The first place from ``at`` on where ``x`` differs from itself ``lag`` later, or where it ends."""
    end, step = len(x) - lag, STEP
    while at < end:
        stop = min(end, at + step)
        other = x[at:stop] != x[at + lag : stop + lag]
        found = int(other.argmax())
        if other[found]:
            return at + found
        at, step = stop, 2 * step
    return end


def _same_until(x: np.ndarray, at: int, lag: int) -> int:
    """The last place up to ``at`` from which ``x`` is the same as itself ``lag`` later, up to ``at``."""
    step = STEP
    while at > 0:
        start = max(0, at - step)
        other = x[start:at][::-1] != x[start + lag : at + lag][::-1]
        found = int(other.argmax())
        if other[found]:
            return at - found
        at, step = start, 2 * step
    return 0


def _at_lag(x: np.ndarray, lag: int, least: int) -> Iterator[tuple[int, int]]:
    """Start and length of the stretches of at least ``least`` words with period ``lag``."""
    if len(x) < least:
        return
    other = np.flatnonzero(x[lag:] != x[:-lag])
    bounds = np.concatenate([[-1], other, [len(x) - lag]])
    equal = np.diff(bounds) - 1
    for i in np.flatnonzero(equal >= least - lag):
        yield int(bounds[i]) + 1, int(equal[i]) + lag


def _at_scale(
    x: np.ndarray, grams: np.ndarray, window: int, low: int, high: int
) -> Iterator[tuple[int, int, int]]:
    """Start, length and period of stretches with a period in (low, high], from pairs of minimizers."""
    places = _minimizers(grams, window)
    order = places[np.argsort(grams[places], kind="stable")]
    lags = np.diff(order)
    pairs = (grams[order[1:]] == grams[order[:-1]]) & (lags > low) & (lags <= high)
    firsts, lags = order[:-1][pairs], lags[pairs]
    done_lag, done = -1, -1
    for i in np.lexsort((firsts, lags)):
        at, lag = int(firsts[i]), int(lags[i])
        # A seed inside the stretch that was found last has that one's extent.
        if lag == done_lag and at < done:
            continue
        stop = _same_from(x, at, lag)
        done_lag, done = lag, stop
        if stop == at:
            continue
        start = _same_until(x, at, lag)
        if stop - start + lag >= least_length(lag):
            yield start, stop - start + lag, lag


def find_runs(ids: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The runs of texts, given as integers for words in a row and words per text: rows of text, start,
    length and period, by text, start and period."""
    ends = np.cumsum(counts)
    order = np.argsort(counts, kind="stable")
    order = order[counts[order] >= LEAST_WORDS]
    if not len(order):
        return np.zeros((0, 4), np.int64)
    # Texts from short to long, so that those long enough for a period are the end of the array, each
    # with a number of its own behind it, so that no stretch of equal words leaves a text.
    above = int(ids.max()) + 1
    parts, begins, at = [], [], 0
    for i, text in enumerate(order):
        begins.append(at)
        parts += [ids[ends[text] - counts[text] : ends[text]], [above + i]]
        at += int(counts[text]) + 1
    x = np.concatenate(parts).astype(np.int64)
    begins, sizes = np.asarray(begins), counts[order]
    found: dict[tuple[int, int], int] = {}

    def add(start: int, length: int, period: int) -> None:
        # A stretch that also has a shorter period is the run of that one.
        key = (start, length)
        found[key] = min(period, found.get(key, period))

    def long_enough(words: int) -> int | None:
        first = int(np.searchsorted(sizes, words))
        return int(begins[first]) if first < len(sizes) else None

    for lag in range(1, DIRECT + 1):
        begin = long_enough(least_length(lag))
        if begin is not None:
            for start, length in _at_lag(x[begin:], lag, least_length(lag)):
                add(begin + start, length, lag)
    low, size, level, level_from = DIRECT, 1, None, 0
    while (begin := long_enough(least_length(low + 1))) is not None:
        high = low + low // 2
        if level is None:
            level = _mixed(x[begin:].astype(np.uint64), np.full(len(x) - begin, 7, np.uint64))
            level_from = begin
        level, level_from = level[begin - level_from :], begin
        # ``level`` has the hashes of ``size`` words; two of them that overlap make a gram.
        while 2 * size <= high and len(level) > size:
            level, size = _mixed(level[:-size], level[size:]), 2 * size
        shift = high - size
        window = 2 * (low + 1) - high + 1
        if len(level) - shift >= window:
            grams = _mixed(level[: len(level) - shift], level[shift:])
            for start, length, period in _at_scale(x[begin:], grams, window, low, high):
                add(begin + start, length, period)
        low = high
    if not found:
        return np.zeros((0, 4), np.int64)
    runs = np.array([(s, n, q) for (s, n), q in found.items()], np.int64)
    place = np.searchsorted(begins, runs[:, 0], side="right") - 1
    runs = np.column_stack([order[place], runs[:, 0] - begins[place], runs[:, 1], runs[:, 2]])
    return runs[np.lexsort((runs[:, 3], runs[:, 1], runs[:, 0]))]


def _collapsed(words: pa.Array, counts: np.ndarray, runs: np.ndarray) -> pa.Array:
    """Each text's words but those that repeat a run's first period, joined by one space."""
    ends = np.cumsum(counts)
    marks = np.zeros(len(words) + 1, np.int64)
    begins = (ends - counts)[runs[:, 0]] + runs[:, 1]
    np.add.at(marks, begins + runs[:, 3], 1)
    np.add.at(marks, begins + runs[:, 2], -1)
    kept = np.cumsum(marks[:-1]) == 0
    left = np.concatenate([[0], np.cumsum(kept)])[np.concatenate([[0], ends])]
    lists = pa.LargeListArray.from_arrays(pa.array(left), words.filter(pa.array(kept)))
    return pc.binary_join(lists, pa.scalar(" ", pa.large_string()))


def periodic_runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_words``, ``runs`` (an array of start, length and period,
    counted in words, by start and period) and ``collapsed``, the words joined by one space without
    those that a run contains behind its first period.

    Words are runs of anything but space and the characters 9 to 13, compared as they are.  A null or
    empty text has no words, no runs and an empty collapsed text.  Rows are taken each by itself,
    whatever ids they share; ids may be null; an empty table gives no rows; other columns are ignored.
    A task holds the words of 128 texts, or of one that is longer, some 60 bytes a word.
    """
    schema = T.StructType(
        [
            T.StructField("doc_id", docs.schema[doc_id].dataType),
            *T.StructType.fromDDL(
                "n_words long, runs array<struct<start: long, length: long, period: long>>, "
                "collapsed string"
            ).fields,
        ]
    )

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            words, counts = split_words(batch.column("text"))
            ids = words.dictionary_encode().indices.to_numpy() if len(words) else np.zeros(0, int)
            runs = find_runs(ids, counts)
            per_text = np.bincount(runs[:, 0], minlength=len(counts))
            places = np.concatenate([[0], np.cumsum(per_text)]).astype(np.int32)
            fields = [pa.array(np.ascontiguousarray(runs[:, i])) for i in (1, 2, 3)]
            spans = pa.StructArray.from_arrays(fields, ["start", "length", "period"])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(counts.astype(np.int64)),
                    pa.ListArray.from_arrays(pa.array(places), spans),
                    _collapsed(words, counts, runs).cast(pa.string()),
                ],
                names=["doc_id", "n_words", "runs", "collapsed"],
            )

    texts = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return texts.mapInArrow(look, schema)


def greatest_run(runs: Column) -> Column:
    """Of an array of runs the one with the greatest length by period, compared exactly; of equal ones
    the first.  Null where there is none."""

    def better(best: Column, run: Column) -> Column:
        more = run["length"] * best["period"] > best["length"] * run["period"]
        return F.when(more, run).otherwise(best)

    return F.aggregate(runs, F.get(runs, F.lit(0)), better)
