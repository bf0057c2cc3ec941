"""Toxicity of texts, scored after undoing obfuscation by noisy-channel decoding.

Letters are written as digits and signs, spaced out or drawn out, words are cut in pieces.  What may
be such a stretch of a text becomes a lattice: each character can stand for itself, for the letters it imitates, for a gap
between words, or for nothing where it separates or repeats.  A character language model (trigrams
of all documents, smoothed) weighs the readings, the channel charges for each change, and Viterbi's
algorithm picks the cheapest path.  Logistic regression over the words, as written and as restored, and their
beginnings gives the score, with weights learned from a bounded sample of labelled documents.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from os.path import commonprefix

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayline.llm.common import held_out, slices, staged

# Letters of the language model, and what digits and signs imitate.
LETTERS = "abcdefghijklmnopqrstuvwxyzàáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿ"
IMITATED = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b",
    "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "€": "e", "£": "l",
}
# Characters without width, which part nothing that is seen.
HIDDEN = "\u00ad\u200b\u200c\u200d\u2060\ufeff"

SYMBOLS = len(LETTERS) + 1  # 0 is the gap around words
# Costs, in natural logarithms: a sign for a letter, a sign as a gap, dropping a separator, dropping
# a repetition, ending a word at a separator.
IMITATION, SIGN, JOINED, REPEATED, PARTED = 1.0, 6.0, 0.5, 0.5, 4.5
# What is common in clean texts is kept unless the language model says much else: a sign after the
# last letter as a gap, dropping one letter of two, joining two pieces of a word.
TRAILING, DOUBLED, PIECED = 1.0, 6.0, 4.0
PIECE = 5  # letters of a piece at most
WINDOW = 256  # characters decoded before what all readings so far share is put away

_L, _S = f"[{LETTERS}]", "[0-9@$!|+€£]"
_LS = f"[{LETTERS}0-9@$!|+€£]"
_GAP = r"(?:[^\w@$!|+€£]|_)"
SPACED = re.compile(rf"(?<!{_LS}){_LS}(?:{_GAP}+{_LS}(?!{_LS})){{2,}}")
GAPS = re.compile(rf"{_GAP}+")
TOKENS = re.compile(rf"{_LS}{{2,}}")
# A sign next to a letter, or a letter three times.
NOISY = re.compile(rf"{_S}{_L}|{_L}{_S}|({_L})\1\1")
WIDTHLESS = re.compile(rf"[\w@$!|+€£]+(?:[{HIDDEN}]+[\w@$!|+€£]+)+")
DELETED = dict.fromkeys(map(ord, HIDDEN))
TRAILED = re.compile(rf"{_LS}*{_L}{_S}+(?!{_LS})")
WORDS = re.compile(r"[^\W\d_]+")
BEGINNINGS = (3, 4, 5, 6)
CACHED = 200_000


def _classes() -> tuple[np.ndarray, np.ndarray]:
    """For each code point its symbol in the language model, and whether it is an imitating sign."""
    symbols = np.zeros(0x110000, np.uint8)
    symbols[[ord(c) for c in LETTERS]] = np.arange(1, SYMBOLS)
    signs = np.zeros(0x110000, bool)
    signs[[ord(c) for c in IMITATED]] = True
    return symbols, signs


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


# The language model


def trigram_counts(docs: DataFrame) -> np.ndarray:
    """Counts of letter trigrams over all documents, words bordered by gaps.  Tasks send what they
    have met; the sums are as many numbers at most as there are trigrams of the alphabet."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        symbols, _ = _classes()
        total = np.zeros(SYMBOLS**3, np.int64)
        for batch in slices(batches, 64):
            text = "\n".join(t for t in batch.column("text").to_pylist() if t).lower()
            found = np.concatenate([[0, 0], symbols[_points(text)], [0]]).astype(np.int32)
            first, second, third = found[:-2], found[1:-1], found[2:]
            # After a gap a word begins anew, whatever was before it.
            key = (np.where(second > 0, first, 0) * SYMBOLS + second) * SYMBOLS + third
            total += np.bincount(key[(second > 0) | (third > 0)], minlength=len(total))
        met = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(met.astype(np.int32)), pa.array(total[met])], names=["gram", "n"]
        )

    rows = (
        docs.select("text").mapInArrow(run, "gram int, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    ).collect()
    counts = np.zeros(SYMBOLS**3)
    for row in rows:
        counts[row["gram"]] = row["n"]
    return counts.reshape(SYMBOLS, SYMBOLS, SYMBOLS)


def trigram_costs(counts: np.ndarray, weight: float = 5.0) -> np.ndarray:
    """-log P(third | first, second), each order smoothed by the next shorter one."""
    single = (counts.sum((0, 1)) + 1) / (counts.sum() + SYMBOLS)
    pairs = counts.sum(0)
    double = (pairs + weight * single) / (pairs.sum(1, keepdims=True) + weight)
    triple = (counts + weight * double[None]) / (counts.sum(2, keepdims=True) + weight)
    return -np.log(triple).astype(np.float32)


# Decoding


class Decoder:
    """Restores noisy stretches under a language model."""

    def __init__(self, costs: np.ndarray) -> None:
        self.costs = costs.tolist()
        self.symbol = {c: i for i, c in enumerate(LETTERS, 1)}
        self.known: dict[str, str] = {}
        self.ended: dict[str, str] = {}
        self.symbols, self.signs = _classes()
        # What dropping one letter of two gains, by the letters before, twice and after.
        twice = np.diagonal(costs, axis1=1, axis2=2)
        self.gains = twice[:, :, None] + np.diagonal(costs).T[None] - costs
        self.table = costs

    def _readings(
        self, char: str, last: str, sign: float = SIGN, repeated: float = REPEATED
    ) -> list[tuple[int | None, float]]:
        """Symbols a character may stand for (None: nothing) and what the channel charges."""
        if char in self.symbol:
            found = [(self.symbol[char], 0.0)]
        elif char in IMITATED:
            found = [(self.symbol[c], IMITATION) for c in IMITATED[char]] + [(0, sign)]
        else:
            return [(None, JOINED), (0, PARTED)]
        return [*found, (None, repeated)] if char == last else found

    def stretch(self, text: str) -> str:
        """The cheapest reading of a lower-case stretch, in letters and single spaces."""
        if text not in self.known:
            if len(self.known) > CACHED:
                self.known = {}
            found = self._decode(text)
            # Signs after a word that are no letters of it stay what they are.
            self.known[text] = text if found == text.rstrip("".join(IMITATED)) else found
        return self.known[text]

    def token(self, text: str) -> str:
        """The reading of a lower-case run of letters and signs; most runs are read as they stand."""
        found = self.known.get(text)
        if found is None:
            if NOISY.search(text):
                return self.stretch(text)
            if len(self.known) > CACHED:
                self.known = {}
            found = self.known[text] = text
        return found

    def ending(self, text: str) -> str:
        """The readings of a token whose last signs are letters, whatever the language model says:
        with a repeated one as one letter, and as two."""
        if text not in self.ended:
            if len(self.ended) > CACHED:
                self.ended = {}
            self.ended[text] = " ".join(self._decode(text, np.inf, r) for r in (REPEATED, np.inf))
        return self.ended[text]

    def _decode(self, text: str, trailing: float = TRAILING, again: float = REPEATED) -> str:
        costs, said, last = self.costs, [], ""
        best = {(0, 0): (0.0, ())}  # by the last two symbols: cost, and symbols as nested pairs
        end = len(text.rstrip("".join(IMITATED)))
        for start in range(0, len(text), WINDOW):
            for at, char in enumerate(text[start : start + WINDOW], start):
                after: dict = {}
                thrice = char * 3 in text[max(at - 2, 0) : at + 2]
                if at >= end:
                    readings = self._readings(char, last, trailing, again)
                else:
                    drawn = thrice or char not in self.symbol
                    readings = self._readings(char, last, SIGN, REPEATED if drawn else DOUBLED)
                for (a, b), (cost, path) in best.items():
                    for symbol, charge in readings:
                        if symbol is None or (symbol == 0 and b == 0):
                            state, total, way = (a, b), cost + charge, path
                        else:
                            state = (b, symbol) if symbol else (0, 0)
                            total = cost + charge + costs[a][b][symbol]
                            way = (path, symbol)
                        if state not in after or total < after[state][0]:
                            after[state] = (total, way)
                best, last = after, char
            if start + WINDOW < len(text):
                # What the cheapest readings of all states have in common is settled.
                ways = {state: self._symbols(path) for state, (_, path) in best.items()}
                shared = commonprefix(list(ways.values()))
                said += shared
                for state, (cost, _) in best.items():
                    open_path: tuple = ()
                    for symbol in ways[state][len(shared) :]:
                        open_path = (open_path, symbol)
                    best[state] = (cost, open_path)
        # A reading ends with a gap.
        state = min(
            best, key=lambda s: (best[s][0] + (costs[s[0]][s[1]][0] if s[1] else 0.0), s)
        )
        said += self._symbols(best[state][1])
        return "".join(LETTERS[s - 1] if s else " " for s in said).strip()

    @staticmethod
    def _symbols(path: tuple) -> list[int]:
        found = []
        while path:
            path, symbol = path
            found.append(symbol)
        return found[::-1]

    @staticmethod
    def _tokens(inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where runs of letters and signs start and end."""
        edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
        return edges[::2], edges[1::2]

    def _suspect(self, text: str) -> tuple[bool, bool]:
        """Whether three lone characters may follow each other, and whether a sign is next to a
        letter or a letter stands three times."""
        points = _points(text)
        symbols, signs = self.symbols[points], self.signs[points]
        letters = symbols > 0
        starts, ends = self._tokens(letters | signs)
        lone = ends - starts == 1
        mixed = (signs[:-1] & letters[1:]) | (letters[:-1] & signs[1:])
        same = (symbols[1:] == symbols[:-1]) & letters[1:]
        return (
            bool((lone[2:] & lone[1:-1] & lone[:-2]).any()),
            bool(mixed.any() or (same[1:] & same[:-1]).any()),
        )

    def _tightened(self, text: str) -> tuple[str, int]:
        """The text without one of two letters and without gaps between pieces of a word, where the
        language model gains more than either is charged.  Each such choice leaves the letters that
        the others depend on as they are, so that they need no lattice."""
        points = _points(text)
        symbols = self.symbols[points].astype(np.intp)
        letters = symbols > 0
        starts, ends = self._tokens(letters | self.signs[points])
        if not len(starts):
            return text, 0
        padded = np.concatenate([[0, 0], symbols, [0, 0]])
        place = np.flatnonzero((symbols[1:] == symbols[:-1]) & letters[1:])
        gone = np.zeros(len(points), bool)
        if len(place):
            # Words whose letters all stand twice are written so on purpose.
            covered = np.zeros(len(points), bool)
            covered[place] = covered[place + 1] = True
            token = np.searchsorted(starts, place, "right") - 1
            lengths = ends - starts
            all_twice = (np.add.reduceat(covered, starts, dtype=np.int64) == lengths) & (lengths > 5)
            gain = self.gains[padded[place + 1], symbols[place], padded[place + 4]]
            drop = gain > np.where(all_twice[token], REPEATED, DOUBLED)
            gone[place[drop]] = True
            changed = len(set(token[drop].tolist()))
        else:
            changed = 0
        short = ends - starts <= PIECE
        near = np.flatnonzero(short[:-1] & short[1:])
        first, second = ends[near] - 1, starts[near + 1]
        # The symbol before a lone letter is a gap, as the one after it.
        a, b = padded[first + 1], symbols[first]
        c, d = symbols[second], padded[second + 3]
        two = self.table[a, b, 0] + self.table[0, 0, c] + self.table[0, c, d]
        one = self.table[a, b, c] + self.table[b, c, d]
        for i in np.flatnonzero((b > 0) & (c > 0) & (two - one > PIECED)):
            low, high = int(first[i]) + 1, int(second[i])
            if GAPS.fullmatch(text, low, high):
                gone[low:high] = True
                changed += 1
        if not changed:
            return text, 0
        return points[~gone].tobytes().decode("utf-32-le", "surrogatepass"), changed

    def restore(self, text: str) -> tuple[str, int]:
        """The text in lower case with its stretches restored, and how many have changed."""
        text = text.lower()
        changed = 0

        def reader(read):
            def run(found: re.Match) -> str:
                nonlocal changed
                restored = read(found[0])
                changed += restored != found[0]
                return restored

            return run

        if any(c in text for c in HIDDEN):
            text = WIDTHLESS.sub(reader(lambda t: t.translate(DELETED)), text)
        spaced, mixed = self._suspect(text)
        if spaced:
            # Any gap is as good as a space.
            text = SPACED.sub(reader(lambda t: self.stretch(GAPS.sub(" ", t))), text)
        if mixed:
            text = TOKENS.sub(reader(self.token), text)
        text, more = self._tightened(text)
        return text, changed + more

    def words(self, text: str) -> tuple[set[str], int]:
        """Words of the text as written, as restored and with the signs after a word for letters,
        and the number of stretches changed."""
        restored, changed = self.restore(text)
        text = text.lower()
        found = set(WORDS.findall(text))
        if changed:
            found.update(WORDS.findall(restored))
        if not self.sign_free(text):
            found.update(w for t in set(TRAILED.findall(text)) for w in self.ending(t).split())
        return found, changed

    def sign_free(self, text: str) -> bool:
        """Whether no letter is followed by a sign."""
        points = _points(text)
        return not ((self.symbols[points[:-1]] > 0) & self.signs[points[1:]]).any()


def restore_texts(docs: DataFrame, costs: np.ndarray) -> DataFrame:
    """``docs`` (``doc_id``, ``text``; other columns are ignored) to ``doc_id``, ``restored`` and
    ``n_restored`` (stretches changed).  A null text stays null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(costs)
        for batch in slices(batches):
            found = [
                decoder.restore(t) if t is not None else (None, 0)
                for t in batch.column("text").to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([f[0] for f in found], pa.string()),
                    pa.array([f[1] for f in found], pa.int64()),
                ],
                names=["doc_id", "restored", "n_restored"],
            )

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, restored string, n_restored long"
    )


# Scoring


def word_features(word: str) -> list[int]:
    """A word and its beginnings, as 32-bit numbers."""
    found = [zlib.crc32(word.encode("utf-8", "surrogatepass"))]
    for n in BEGINNINGS:
        if len(word) > n:
            found.append(zlib.crc32(f"{word[:n]}-".encode("utf-8", "surrogatepass")))
    return found


@dataclass(frozen=True)
class ToxicityModel:
    costs: np.ndarray
    weights: dict[int, float]
    bias: float


class Scorer:
    def __init__(self, model: ToxicityModel) -> None:
        self.model = model
        self.decoder = Decoder(model.costs)
        self.known: dict[str, tuple[int, ...]] = {}

    def features(self, text: str | None) -> tuple[set[int], int]:
        """Features of the text, as written and as restored, that have a weight, and the number of stretches changed."""
        words, changed = self.decoder.words(text or "")
        if len(self.known) > CACHED:
            self.known = {}
        known, weights, found = self.known, self.model.weights, set()
        for word in words:
            own = known.get(word)
            if own is None:
                own = known[word] = tuple(f for f in word_features(word) if f in weights)
            if own:
                found.update(own)
        return found, changed

    def score(self, features: set[int]) -> float:
        total = self.model.bias + sum(self.model.weights[f] for f in sorted(features))
        return float(1 / (1 + np.exp(-np.clip(total, -50, 50))))


def train_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    trainable: Column,
    per_class: int = 2500,
    least: int = 4,
    by_chance: float = 0.01,
    seed: int = 13,
) -> ToxicityModel:
    """Learn from ``labels`` (``doc_id``, ``toxic``) where ``trainable`` holds, and the texts of
    ``docs``.

    The language model counts all documents.  The classifier sees a sample bounded by ``per_class``
    documents of either label, drawn by a hash of the id, repeated texts once.  A feature counts if more
    of the toxic ones have it than chance explains (``significant``): of all that count, a share of
    about ``by_chance`` may do so without reason.  Features that fewer than ``least`` documents of the
    sample have are not looked at.  Null labels are left out; an id with several labels counts as
    toxic if any says so.  Without labels of both kinds every score is 0.
    """
    costs = trigram_costs(trigram_counts(docs))
    known = labels.filter(trainable).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = known.filter("toxic is not null")
    sizes = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if not sizes.get(0) or not sizes.get(1):
        return ToxicityModel(costs, {}, -50.0)
    draw = F.xxhash64(F.lit(seed), "doc_id").bitwiseAND(0x7FFFFFFF) / 0x7FFFFFFF
    share = F.when(F.col("toxic") == 1, per_class / sizes[1]).otherwise(per_class / sizes[0])
    # At most about twice per_class rows, by their share.
    drawn = F.broadcast(known.filter(draw <= share))
    sample = staged(
        docs.select("doc_id", "text")
        .join(drawn, "doc_id")
        .filter("text is not null")
        .groupBy(F.xxhash64("text").alias("key"))
        .agg(F.max("toxic").alias("toxic"), F.first("text").alias("text")),
        "sample",
    ).repartition(max(1, min(16, docs.sparkSession.sparkContext.defaultParallelism)), "key")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(costs)
        tallies = (Counter(), Counter())
        for batch in slices(batches):
            for text, toxic in zip(
                batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), strict=True
            ):
                words = decoder.words(text)[0]
                tallies[toxic > 0].update({f for w in words for f in word_features(w)})
        features = sorted(tallies[0].keys() | tallies[1].keys())
        for start in range(0, len(features), 100_000):
            run = features[start : start + 100_000]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(run, pa.int64()),
                    pa.array([tallies[1][f] for f in run], pa.int64()),
                    pa.array([tallies[0][f] for f in run], pa.int64()),
                ],
                names=["feature", "toxic", "clean"],
            )

    total = sample.agg(F.sum((F.col("toxic") > 0).cast("int")), F.count("*")).first()
    bad, good = total[0], total[1] - total[0]
    odds = F.log((F.col("toxic") + 0.1) / bad) - F.log((F.col("clean") + 0.5) / good)
    tested = staged(
        sample.select("text", "toxic").mapInArrow(count, "feature long, toxic long, clean long")
        .groupBy("feature")
        .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
        .filter(F.col("toxic") + F.col("clean") >= least),
        "tested",
    )
    # As many as the sample has words at most, however large the corpus is.
    likely = tested.filter(odds > 2).orderBy("feature").collect()
    tails = np.array([chance(r["toxic"], r["clean"], bad, good) for r in likely])
    limit = significant(tails, tested.count(), by_chance)
    chosen = [r for r, tail in zip(likely, tails, strict=True) if tail <= limit]
    start = ToxicityModel(costs, {r["feature"]: 0.0 for r in chosen}, 0.0)

    def select(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(start)
        for batch in slices(batches):
            found = [sorted(scorer.features(t)[0]) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("toxic"), batch.column("key"), pa.array(found, pa.list_(pa.int64()))],
                names=["toxic", "key", "features"],
            )

    rows = sample.select("text", "toxic", "key").mapInArrow(
        select, f"toxic {sample.schema['toxic'].dataType.simpleString()}, key long, features array<long>"
    ).collect()
    rows.sort(key=lambda r: r["key"])
    weights, bias = _regress(rows, list(start.weights), seed)
    # The sample holds more toxic documents than the corpus: its odds are set back.
    bias += np.log(sizes[1] / sizes[0]) - np.log(bad / max(good, 1))
    return ToxicityModel(costs, weights, float(bias))


def chance(toxic: int, clean: int, bad: int, good: int) -> float:
    """The chance that of ``toxic + clean`` documents, drawn from ``bad`` toxic and ``good`` clean ones,
    ``toxic`` or more are toxic."""

    def ways(n: int, k: int) -> float:
        return math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1)

    drawn, total = toxic + clean, 0.0
    for k in range(max(toxic, drawn - good), min(drawn, bad) + 1):
        total += math.exp(ways(bad, k) + ways(good, drawn - k) - ways(bad + good, drawn))
    return min(total, 1.0)


def significant(tails: np.ndarray, tested: int, by_chance: float) -> float:
    """The greatest of ``tails`` up to which, of ``tested`` in all, an expected share of ``by_chance`` is
    there by chance (Benjamini and Hochberg); below 0 if there is none."""
    ranked = np.sort(tails)
    passed = ranked <= by_chance * np.arange(1, len(ranked) + 1) / max(tested, 1)
    return float(ranked[np.flatnonzero(passed)[-1]]) if passed.any() else -1.0


def _regress(
    rows, features: list[int], seed: int, epochs: int = 30, decay: float = 1e-4, shown: float = 0.75
):
    """Logistic regression by stochastic gradient descent over sparse rows.

    Each step shows a random part of a document's features, at least one: long documents hold many
    that say the same, and a short one with a single of them must be told by that one.
    """
    place = {f: i for i, f in enumerate(features)}
    examples = [
        (np.array([place[f] for f in r["features"]], np.int64), float(r["toxic"] > 0)) for r in rows
    ]
    weights, bias, rng = np.zeros(len(features)), 0.0, np.random.default_rng(seed)
    for epoch in range(epochs):
        rate = 0.5 / (1 + 0.2 * epoch)
        for i in rng.permutation(len(examples)):
            own, label = examples[i]
            if len(own) > 1:
                seen = own[rng.random(len(own)) < shown]
                own = seen if len(seen) else own[rng.integers(len(own), size=1)]
            guess = 1 / (1 + np.exp(-np.clip(weights[own].sum() + bias, -50, 50)))
            step = rate * (label - guess) / np.sqrt(max(1, len(own)))
            weights[own] += step - rate * decay * weights[own]
            bias += step
    return {f: float(w) for f, w in zip(features, weights, strict=True) if w}, bias


def score_toxicity(docs: DataFrame, model: ToxicityModel, least: float = 0.3) -> DataFrame:
    """``docs`` (``doc_id``, ``text``; other columns are ignored) to ``doc_id``, ``held_out``,
    ``score``, ``predicted`` (1 if the score is ``least`` or more) and ``n_restored``.

    A null text is an empty one, whose score is that of a text without any known feature.  Repeated
    rows give repeated results; an empty table gives none.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in slices(batches):
            found = [scorer.features(t) for t in batch.column("text").to_pylist()]
            scores = np.array([scorer.score(f) for f, _ in found], np.float64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("held_out"),
                    pa.array(scores),
                    pa.array((scores >= least).astype(np.int32)),
                    pa.array([n for _, n in found], pa.int64()),
                ],
                names=["doc_id", "held_out", "score", "predicted", "n_restored"],
            )

    return docs.select("doc_id", held_out().alias("held_out"), "text").mapInArrow(
        run, "doc_id long, held_out boolean, score double, predicted int, n_restored long"
    )
