"""Periodic runs against comparing every word with every later one."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
from quayline.llm.queries import QUERIES
from quayline.llm.runs import find_runs, least_length, periodic_runs, split_words

from llm.llm_support import DATA

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute(words: list) -> list[tuple[int, int, int]]:
    found: dict = {}
    for q in range(1, len(words) // 3 + 1):
        i = 0
        while i < len(words) - q:
            j = i
            while j < len(words) - q and words[j] == words[j + q]:
                j += 1
            if j - i + q >= least_length(q):
                # Periods come in ascending order: the smallest is entered first.
                found.setdefault((i, j - i + q), q)
            i = max(j, i + 1)
    return sorted((start, length, q) for (start, length), q in found.items())


def collapsed(words: list[str], runs: list) -> list[str]:
    gone = {i for start, length, q in runs for i in range(start + q, start + length)}
    return [w for i, w in enumerate(words) if i not in gone]


def random_text(rng: random.Random) -> list[int]:
    n, kinds = rng.choice([0, 5, 23, 24, 30, 100, 300, 700]), rng.choice([1, 2, 3, 5, 50, 1000])
    words = [rng.randrange(kinds) for _ in range(n)]
    for _ in range(rng.randint(0, 3) if n >= 24 else 0):
        a, p, size = rng.randrange(n), rng.randint(1, n // 3), rng.randint(0, n)
        for i in range(a, min(n, a + size)):
            words[i] = words[a + (i - a) % p]
    return words


def found_in(texts: list[list[int]]) -> list[list[tuple]]:
    ids = np.array([w for t in texts for w in t], np.int64)
    runs = find_runs(ids, np.array([len(t) for t in texts]))
    return [[tuple(map(int, r[1:])) for r in runs if r[0] == i] for i in range(len(texts))]


def test_random_texts_together():
    rng = random.Random(1)
    for _ in range(250):
        texts = [random_text(rng) for _ in range(rng.randint(1, 6))]
        assert found_in(texts) == [brute(t) for t in texts]


def test_every_period_at_its_least_length():
    """A run of exactly three periods among words that occur once, for all periods up to 400."""
    rng = random.Random(2)
    for q in range(1, 401):
        size, before = least_length(q), rng.randint(0, 40)
        words = [-1 - i for i in range(before)] + [i % q for i in range(size)]
        words += [10_000 + i for i in range(rng.randint(0, 40))]
        assert found_in([words]) == [[(before, size, q)]]
        assert found_in([words[: before + size - 1]]) == [[]]


def test_nested_and_overlapping_runs():
    inner = [1] * 30 + [2] * 30 + [3]
    fib = [0]
    other = [1]
    while len(fib) < 1500:
        fib, other = fib + other, fib
    thue = [bin(i).count("1") % 2 for i in range(256)]
    for words in (inner * 4, fib, [*range(20)] * 3 + [*range(19)] * 4, thue * 4, [7] * 24, [7] * 23):
        assert found_in([words]) == [brute(words)]


def test_long_periods():
    rng = random.Random(3)
    block = [rng.randrange(50) for _ in range(20_000)]
    words = [99] * 5 + block * 3 + block[:77]
    assert (5, 60_077, 20_000) in found_in([words])[0]


def test_words():
    texts = ["", " a  b\tc\n", None, "zz", "é\x0bü\x0cx\r", "   "]
    words, counts = split_words(pa.array(texts * 2, pa.string())[1:])
    expected = [WORD.findall(t or "") for t in (texts * 2)[1:]]
    assert words.to_pylist() == [w for t in expected for w in t]
    assert counts.tolist() == [len(t) for t in expected]
    assert len(split_words(pa.array([], pa.string()))[1]) == 0


def test_odd_rows(odd):
    found = periodic_runs(odd).collect()
    rows = odd.collect()
    for got, row in zip(found, rows, strict=True):
        words = WORD.findall(row.text or "")
        assert (got.doc_id, got.n_words) == (row.doc_id, len(words))
        if len(words) < 20_000:
            runs = brute(words)
            assert [tuple(r) for r in got.runs] == runs
            assert got.collapsed.split(" ") == (collapsed(words, runs) or [""])
    # Three words again and again, and a long word behind them.
    long = next(r for r in found if r.doc_id == 6)
    assert [tuple(r) for r in long.runs] == [(0, 36_000, 3)]
    assert long.collapsed == "lorem ipsum dolor " + "x" * 40_000


def test_no_rows(none):
    assert periodic_runs(none).collect() == []


def test_query(spark, docs):
    """The whole query by brute force."""
    found = {r.doc_id: r for r in QUERIES["op12_runs"](spark, DATA).collect()}
    some = 0
    for row in docs.collect():
        words = WORD.findall(row.text or "")
        h = zlib.crc32(str(row.doc_id).encode())
        g, n = h // 10, len(words)
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        runs = brute(words)
        got = found.pop(row.doc_id)
        assert got.n_runs == len(runs)
        best = max(runs, key=lambda r: (r[1] * 10**9 // r[2], -r[0], -r[2]), default=None)
        if best is None:
            assert got.start is got.length is got.period is got.exponent_milli is None
        else:
            assert (got.start, got.length, got.period) == best
            assert got.exponent_milli == 1000 * best[1] // best[2]
            some += 1
        listed = "".join(f"{s},{size},{q}\n" for s, size, q in runs)
        assert got.runs_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        left = " ".join(collapsed(words, runs))
        assert got.collapsed_sha256 == hashlib.sha256(left.encode()).hexdigest()
    assert not found and some > 10
