"""Language identification by averaged hashed subword embeddings and a linear softmax.

A text is lower-cased; every run of one to three code points that begins with a letter, or with the
gap before one, is hashed into one of ``buckets`` rows of an embedding.  A text is the mean of its
rows, and a softmax over the mean gives the languages.  Embedding and softmax are trained by
stochastic gradient descent in numpy on the driver, from a sample of at most ``per_language`` texts
of each language (their bucket counts, made in tasks from the whole texts).  One in five of them is
kept back to set the temperature of the softmax and the score below which a text is rejected.

The softmax has one class more, for what is no language: of each sampled text the model also learns
a made one: its letters drawn anew without order, or characters of base64 or hex.  That class takes the mass
of such texts, so that no language scores high; it is never a prediction.

Once trained, embedding and softmax fold into one table of ``buckets`` rows with a column for each
language, so that a text's score is a mean of table rows: no work per dimension at prediction.
"""

from __future__ import annotations

import string
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayline.llm.common import held_out, slices

ORDERS = 3
WINDOW = 1 << 19  # code points handled at a time
# Added to the number of subwords of a text, so that a few of them are never taken for certainty.
PRIOR = 24
UNKNOWN = "und"
# Code points of a made text: fewer than the least are too few to tell from a short clean text.
MADE_LEAST, MADE_MOST = 80, 2000
ENCODINGS = (string.ascii_letters + string.digits + "+/", string.hexdigits[:16])


@dataclass(frozen=True)
class LanguageModel:
    """``table``: one row per bucket, bucket 0 is empty; a column of logits per language,
    and a last one for what is no language."""

    labels: tuple[str, ...]
    table: np.ndarray
    bias: np.ndarray
    temperature: float
    reject_below: float

    @property
    def buckets(self) -> int:
        return len(self.table)


_made: dict[str, np.ndarray] = {}


def _letters() -> np.ndarray:
    """Whether each code point is a letter; made once per task."""
    if "letters" not in _made:
        _made["letters"] = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return _made["letters"]


def _codes(text: str) -> np.ndarray:
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.where(_letters()[codes], codes, np.uint32(0))


def _hashes(codes: np.ndarray, buckets: int) -> Iterator[np.ndarray]:
    """Buckets of the subwords that begin at each code point but the last two, for each length.
    Subwords of gaps alone go to bucket 0."""
    n = len(codes) - (ORDERS - 1)
    key = np.zeros(n, np.uint32)
    some = np.zeros(n, bool)
    for order in range(ORDERS):
        part = codes[order : order + n]
        key = (key ^ part) * np.uint32(0x9E3779B1) + np.uint32(order + 1)
        key ^= key >> np.uint32(15)
        if order < 2:
            some = some | (part != 0)
        yield np.where(some, (key >> np.uint32(3)) % np.uint32(buckets - 1) + np.uint32(1), 0)


def _pieces(texts: list[str | None]) -> Iterator[tuple[list[int], list[np.ndarray]]]:
    """Groups of windows of texts, with the text each belongs to.  A window ends with the two code
    points after it, or two gaps, so that no subword is lost or met twice."""
    pad = np.zeros(ORDERS - 1, np.uint32)
    owners, parts, size = [], [], 0
    for i, text in enumerate(texts):
        if not text:
            continue
        codes = np.concatenate([pad[:1], _codes(text.lower()), pad])
        for start in range(0, len(codes) - len(pad), WINDOW):
            part = codes[start : start + WINDOW + len(pad)]
            owners.append(i)
            parts.append(part)
            size += len(part)
            if size >= WINDOW:
                yield owners, parts
                owners, parts, size = [], [], 0
    if owners:
        yield owners, parts


def mean_logits(model: LanguageModel, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Logits before the temperature, and the number of subwords, of each text."""
    classes = model.table.shape[1]
    rows = np.hstack([model.table, np.ones((model.buckets, 1), np.float32)]).astype(np.float32)
    rows[0] = 0
    sums = np.zeros((len(texts), classes + 1))
    for owners, parts in _pieces(texts):
        codes = np.concatenate(parts)
        # The last two code points of a window belong to the next one: each segment stops there.
        ends = np.cumsum([len(p) for p in parts])
        starts = ends - [len(p) for p in parts]
        edges = np.stack([starts, ends - (ORDERS - 1)], 1).reshape(-1)[:-1]
        for buckets in _hashes(codes, model.buckets):
            per_window = np.add.reduceat(rows[buckets], edges, axis=0)[::2]
            np.add.at(sums, owners, per_window)
    counts = sums[:, -1]
    return sums[:, :-1] / (counts + PRIOR)[:, None] + model.bias, counts


def _softmax(logits: np.ndarray) -> np.ndarray:
    powers = np.exp(logits - logits.max(axis=-1, keepdims=True))
    return powers / powers.sum(axis=-1, keepdims=True)


def no_language(text: str, draw: float) -> str:
    """A text of no language, the same for the same ``text`` and ``draw``: code points drawn from all
    of ``text``, so that only their order is lost, or characters of an encoding."""
    rng = np.random.default_rng(int(draw * (1 << 53)))
    size = int(rng.integers(MADE_LEAST, MADE_MOST))
    kind = int(rng.integers(0, 2 * len(ENCODINGS)))
    drawn_from = text if text and kind >= len(ENCODINGS) else ENCODINGS[kind % len(ENCODINGS)]
    own = np.frombuffer(drawn_from.encode("utf-32-le", "surrogatepass"), np.uint32)
    return own[rng.integers(0, len(own), size)].tobytes().decode("utf-32-le", "surrogatepass")


def _bucket_counts(buckets: int):
    """Sparse bucket counts of whole texts, at most ``buckets`` entries for a text of any length, and
    of a made text for each, whose language is null."""

    def counted(text: str) -> tuple[bytes, bytes]:
        counts = np.zeros(buckets, np.float32)
        for _, parts in _pieces([text]):
            for part in parts:
                for hashed in _hashes(part, buckets):
                    counts += np.bincount(hashed, minlength=buckets)
        counts[0] = 0
        kept = np.flatnonzero(counts).astype(np.uint32)
        return kept.tobytes(), counts[kept].tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 32):
            texts = batch.column("text").to_pylist()
            draws = batch.column("draw").to_pylist()
            made = [no_language(text, draw) for text, draw in zip(texts, draws, strict=True)]
            found = [counted(text) for text in (*texts, *made)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(batch.column("lang").to_pylist() + [None] * len(made), pa.string()),
                    pa.array(draws + draws, pa.float64()),
                    pa.array([f[0] for f in found], pa.binary()),
                    pa.array([f[1] for f in found], pa.binary()),
                ],
                names=["lang", "draw", "buckets", "counts"],
            )

    return run


def _sample(labelled: DataFrame, per_language: int, seed: int) -> DataFrame:
    """At most about ``per_language`` rows of each language, drawn by a hash of the row."""
    sizes = labelled.groupBy("lang").count()
    share = F.broadcast(
        sizes.select("lang", (F.lit(1.2 * per_language) / F.col("count")).alias("share"))
    )
    draw = (F.xxhash64(F.lit(seed), "doc_id", "text").bitwiseAND(0x7FFFFFFF) / 0x7FFFFFFF)
    drawn = labelled.withColumn("draw", draw).join(share, "lang")
    return drawn.filter("draw < share").select("lang", "draw", "text")


def train_language(
    docs: DataFrame,
    trainable: Column,
    per_language: int = 400,
    buckets: int = 1 << 14,
    dimensions: int = 12,
    epochs: int = 12,
    rejected: float = 0.002,
    expected: float = 0.01,
    seed: int = 7,
) -> LanguageModel:
    """Train on rows of ``docs`` (``doc_id``, ``text``, ``lang``) where ``trainable`` holds.

    Rows with a null language, a null text or a text without letters teach nothing.  The sample is
    bounded by ``per_language`` rows of each language, drawn by hash, and as many made texts of no
    language; ``rejected`` is the share of rightly labelled calibration texts that the rejection
    score may give up.  ``expected`` is the share of texts of no language that prediction reckons
    with, in place of their share in training, so that a short clean text is not taken for one.
    """
    labelled = docs.filter(trainable).select("doc_id", "lang", "text").dropna(subset=["lang", "text"])
    drawn = _sample(labelled, per_language, seed).mapInArrow(
        _bucket_counts(buckets), "lang string, draw double, buckets binary, counts binary"
    )
    found = sorted(drawn.collect(), key=_place)
    kept, taken = [], {}
    for row in found:
        if row["buckets"] and taken.get(row["lang"], 0) < per_language:
            taken[row["lang"]] = taken.get(row["lang"], 0) + 1
            kept.append(row)
    labels = tuple(sorted(lang for lang in taken if lang is not None))
    if not labels:
        empty = np.zeros((2, 0), np.float32)
        return LanguageModel((), empty, np.zeros(0), 1.0, 0.0)
    rows = [
        (np.frombuffer(r["buckets"], np.uint32), np.frombuffer(r["counts"], np.float32))
        for r in kept
    ]
    rows = [(b, c / (c.sum() + PRIOR)) for b, c in rows]
    target = np.array(
        [len(labels) if r["lang"] is None else labels.index(r["lang"]) for r in kept]
    )
    rng = np.random.default_rng(seed)
    shuffled = rng.permutation(len(rows))
    checking = shuffled[: len(rows) // 5] if len(rows) >= 10 * len(labels) else shuffled
    learning = shuffled[len(rows) // 5 :] if len(rows) >= 10 * len(labels) else shuffled
    embedding, output, bias = _descend(
        rows, target, learning, len(labels) + 1, buckets, dimensions, epochs, rng
    )
    folded = (embedding @ output).astype(np.float32)
    folded[0] = 0
    logits = np.stack([w @ folded[b] for b, w in (rows[i] for i in checking)]) + bias
    temperature = _temperature(logits, target[checking])
    share = (target == len(labels)).mean()
    shift = temperature * np.log(expected * (1 - share) / (share * (1 - expected)))
    bias[-1] += shift
    logits[:, -1] += shift
    scores = _softmax(logits / temperature)
    right = (scores.argmax(1) == target[checking]) & (target[checking] < len(labels))
    best = scores.max(1)[right]
    # Never above an even chance between two languages: short clean texts must pass.
    floor = min(float(np.quantile(best, rejected)), 0.5) if len(best) else 0.0
    return LanguageModel(labels, folded, bias.astype(np.float64), temperature, floor)


def _place(row) -> tuple:
    return row["lang"] is None, row["lang"] or "", row["draw"], bytes(row["buckets"])


def _descend(rows, target, learning, classes, buckets, dimensions, epochs, rng):
    """Stochastic gradient descent, one text at a time, with a falling step."""
    embedding = rng.normal(0, 0.1, (buckets, dimensions))
    output = rng.normal(0, 0.1, (dimensions, classes))
    bias = np.zeros(classes)
    steps, step = epochs * len(learning), 0
    for _ in range(epochs):
        for i in rng.permutation(learning):
            rate = 0.5 * (1 - step / steps)
            step += 1
            bucket, weight = rows[i]
            hidden = weight @ embedding[bucket]
            error = _softmax(hidden @ output + bias)
            error[target[i]] -= 1
            back = output @ error
            output -= rate * np.outer(hidden, error)
            bias -= 0.1 * rate * error
            # A bucket's share of a text is far below 1; scaled so that one step moves the mean.
            embedding[bucket] -= (rate / (weight @ weight) * weight)[:, None] * back
    return embedding, output, bias


def _temperature(logits: np.ndarray, target: np.ndarray) -> float:
    """The temperature with the least mean log loss."""
    grid = np.geomspace(0.1, 20, 60)
    losses = [
        -np.log(np.maximum(_softmax(logits / t)[np.arange(len(target)), target], 1e-12)).mean()
        for t in grid
    ]
    return float(grid[int(np.argmin(losses))])


def _judged(model: LanguageModel, texts: list[str | None]):
    """Language, score and rejection of each text, as arrays."""
    if not model.labels:
        none = np.zeros(len(texts))
        return [UNKNOWN] * len(texts), none, none == 0
    logits, counts = mean_logits(model, texts)
    shares = _softmax(logits / model.temperature)[:, : len(model.labels)]
    some = counts > 0
    pick = [model.labels[p] if s else UNKNOWN for p, s in zip(shares.argmax(1), some, strict=True)]
    score = np.where(some, shares.max(1), 0.0)
    return pick, score, score < model.reject_below if model.reject_below else ~some


def predict_language(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """``docs`` (``doc_id``, ``text``; other columns are ignored) to ``doc_id``, ``held_out``,
    ``lang_pred``, ``score`` and ``rejected``.

    A null or empty text, or one without letters, is ``und`` with score 0 and rejected, as is every
    text under a model that has learned no language.  Texts scoring below the model's bound keep
    their best language and are marked rejected.  Repeated rows give repeated results; an empty
    table gives none.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 256):
            pick, score, rejected = _judged(model, batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("held_out"),
                    pa.array(pick, pa.string()),
                    pa.array(score),
                    pa.array(rejected),
                ],
                names=["doc_id", "held_out", "lang_pred", "score", "rejected"],
            )

    return docs.select("doc_id", held_out().alias("held_out"), "text").mapInArrow(
        run, "doc_id bigint, held_out boolean, lang_pred string, score double, rejected boolean"
    )


def keep_identified(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """The rows of ``docs`` whose ``text`` the model does not reject, with all their columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 256):
            _, _, rejected = _judged(model, batch.column("text").to_pylist())
            yield batch.filter(pa.array(~rejected))

    return docs.mapInArrow(run, docs.schema)
