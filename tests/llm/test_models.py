"""Language identification and toxicity: held-out accuracy, decoding, odd rows."""

from __future__ import annotations

import string

import numpy as np
import pytest
from pyspark.sql import functions as F

from quayline.llm.common import in_training
from quayline.llm.language import (
    MADE_LEAST,
    MADE_MOST,
    keep_identified,
    no_language,
    predict_language,
    train_language,
)
from quayline.llm.queries import QUERIES
from quayline.llm.toxicity import (
    LETTERS,
    Decoder,
    chance,
    restore_texts,
    score_toxicity,
    significant,
    train_toxicity,
    trigram_costs,
    trigram_counts,
)

BIGGER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def bigger(spark):
    return spark.read.parquet(f"{BIGGER}/documents.parquet")


@pytest.fixture(scope="module")
def languages(bigger):
    return train_language(bigger, in_training(), per_language=100, epochs=6)


def test_language_query(spark, bigger):
    found = QUERIES["op6_language"](spark, BIGGER).join(bigger.select("doc_id", "lang"), "doc_id")
    unseen = found.filter("held_out")
    right = unseen.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert found.count() == bigger.count() and unseen.count() > 200
    assert right > 0.97
    assert found.filter("score < 0 or score > 1 or score is null").count() == 0
    # Clean texts are not rejected.
    assert found.filter("rejected").count() <= 0.005 * found.count()


def test_fold(spark, bigger):
    folds = {
        r.doc_id: r.held_out for r in QUERIES["op6_language"](spark, BIGGER).collect()
    }
    import zlib

    assert folds == {i: zlib.crc32(str(i).encode()) % 4 == 2 for i in folds}


def test_language_of_odd_rows(odd, none, languages):
    rows = predict_language(odd, languages).collect()
    assert len(rows) == odd.count()
    for r in rows:
        if r.doc_id in (3, 4, 5, 9):
            assert (r.lang_pred, r.score, r.rejected) == ("und", 0.0, True)
        assert r.lang_pred in (*languages.labels, "und")
    assert predict_language(none, languages).collect() == []
    kept = keep_identified(odd, languages)
    assert kept.schema == odd.schema
    assert {r.doc_id for r in kept.collect()}.isdisjoint({3, 4, 5, 9})


def _drawn(letters, size, seed, texts=100):
    rng = np.random.default_rng(seed)
    return ["".join(rng.choice(list(letters), size)) for _ in range(texts)]


@pytest.mark.parametrize(
    "letters",
    [
        string.ascii_letters + string.digits + "+/",
        string.hexdigits[:16],
        string.ascii_lowercase,
        string.ascii_uppercase + "   ",
        "αβγδεζηθικλμνξοπρστυ  ",
    ],
)
def test_rejects_what_is_no_language(spark, languages, letters):
    rows = [(i, t) for i, t in enumerate(_drawn(letters, 300, seed=5))]
    found = predict_language(spark.createDataFrame(rows, "doc_id long, text string"), languages)
    assert found.filter("rejected").count() >= 95
    assert {r.lang_pred for r in found.collect()} <= set(languages.labels)


def test_one_language_rejects_too(spark, bigger):
    model = train_language(bigger.filter("lang = 'en'"), in_training(), per_language=100, epochs=6)
    assert model.labels == ("en",)
    rows = [(i, t) for i, t in enumerate(_drawn(string.ascii_letters + string.digits, 300, seed=6))]
    made = predict_language(spark.createDataFrame(rows, "doc_id long, text string"), model)
    assert made.filter("rejected").count() >= 95
    own = bigger.filter("lang = 'en'")
    assert predict_language(own, model).filter("rejected").count() <= 0.02 * own.count()


def test_made_texts():
    made = {no_language("some text of words", draw / 50) for draw in range(50)}
    assert len(made) == 50 and all(MADE_LEAST <= len(t) < MADE_MOST for t in made)
    assert any(set(t) <= set("some text of words") for t in made)
    assert no_language("a", 0.25) == no_language("a", 0.25)
    assert no_language("", 0.9)


def test_nothing_to_learn(odd, none):
    for docs in (none, odd):
        model = train_language(docs, F.lit(False))
        assert {r.lang_pred for r in predict_language(odd, model).collect()} == {"und"}
    # Texts without letters teach nothing; a single language is still a model.
    model = train_language(odd, F.col("lang") == "fr")
    assert model.labels == ("fr",)


def test_windows_of_long_texts(languages, monkeypatch):
    from quayline.llm import language

    text = "the of and to in is that it for on " * 400
    whole, counts = language.mean_logits(languages, [text, "x", None, text])
    monkeypatch.setattr(language, "WINDOW", 97)
    pieces, again = language.mean_logits(languages, [text, "x", None, text])
    assert (counts == again).all()
    assert np.allclose(whole, pieces, atol=1e-4)


@pytest.fixture(scope="module")
def decoder(bigger):
    return Decoder(trigram_costs(trigram_counts(bigger)))


@pytest.mark.parametrize(
    ("noisy", "restored"),
    [
        ("what an 1D10T", "what an idiot"),
        ("i d i o t you", "idiot you"),
        ("an idiooooot", "an idiot"),
        ("s.t.u.p.i.d clown", "stupid clown"),
        ("tr@sh and $cum", "trash and scum"),
        ("p a t h e t i c l0s3r", "pathetic loser"),
        ("", ""),
        ("nothing to undo here, 12 May", "nothing to undo here, 12 may"),
        ("the end&&& or$$$ not!!", "the end&&& or$$$ not!!"),
    ],
)
def test_restored(decoder, noisy, restored):
    assert decoder.restore(noisy)[0] == restored


@pytest.fixture(scope="module")
def blunt(spark, bigger):
    """A decoder that has met some more words, among clean ones with doubled letters."""
    words = "kill hell ass all too see off good class till well tell pass is as his in to"
    more = spark.createDataFrame([(-i, words) for i in range(1, 400)], "doc_id long, text string")
    return Decoder(trigram_costs(trigram_counts(bigger.select("doc_id", "text").unionByName(more))))


@pytest.mark.parametrize(
    ("noisy", "restored"),
    [
        ("ki11", "kill"),
        ("idio7", "idiot"),
        ("ttrraasshh", "trash"),
        ("iidiot", "idiot"),
        ("sscumm", "scum"),
        ("lo ser", "loser"),
        ("mo ron", "moron"),
        ("id iot", "idiot"),
        ("i,d,i,o,t", "idiot"),
        ("i/d/i/o/t", "idiot"),
        ("s\nc\nu\nm", "scum"),
        ("i    d     i    o    t", "idiot"),
        ("i\u200bd\u200bi\u200bo\u200bt", "idiot"),
        ("sc\u200bum", "scum"),
        # What only looks like noise.
        ("an idiot!", "an idiot!"),
        ("take 2 a day", "take 2 a day"),
        ("all is too good, see his class", "all is too good, see his class"),
        ("漢字 to 漢字 be, in the end", "漢字 to 漢字 be, in the end"),
    ],
)
def test_restored_wherever_the_noise_is(blunt, noisy, restored):
    found, changed = blunt.restore(noisy)
    assert found == restored
    assert (changed > 0) == (noisy != restored)


def test_letters_dropped_and_pieces_joined_as_in_the_lattice(blunt):
    """Doubled letters are told without Viterbi, with its result."""
    for word in ("iidiot", "sscumm", "worthless", "class", "goodd", "ttoo", "passes", "mmoronn"):
        assert blunt._tightened(word)[0] == blunt._decode(word), word


def test_words_as_written_and_restored(blunt):
    found, changed = blunt.words("lo ser and more")
    assert {"lo", "ser", "loser", "and", "more"} <= found and changed == 1
    # A clean word before signs hides what they may stand for.
    for noisy, word in (("he11", "hell"), ("a55", "ass"), ("a$$", "ass"), ("ki11", "kill")):
        assert word in blunt.words(noisy)[0], noisy


def test_viterbi_finds_the_cheapest_reading(decoder):
    """Against every reading of short stretches."""
    import itertools

    costs, symbol = decoder.costs, {c: i for i, c in enumerate(LETTERS, 1)}

    def price(readings):
        total, a, b, said = 0.0, 0, 0, []
        for s, charge in readings:
            total += charge
            if s is None or (s == 0 and b == 0):
                continue
            total += costs[a][b][s]
            a, b = (b, s) if s else (0, 0)
            said.append(s)
        return total + (costs[a][b][0] if b else 0.0), said

    for text in ("1d10t", "i d i", "aaab", "l0$er", "x.y", "5cum"):
        options = [
            decoder._readings(c, text[i - 1] if i else "") for i, c in enumerate(text)
        ]
        best = min(price(r)[0] for r in itertools.product(*options))
        found = "".join(LETTERS[s - 1] if s else " " for s in min(
            (price(r) for r in itertools.product(*options)), key=lambda p: p[0])[1]).strip()
        assert decoder._decode(text) == found, (text, best)
    assert symbol["a"] == 1


def test_windows_change_no_reading(decoder, monkeypatch):
    """However often settled letters are put away, the reading is that of the whole lattice."""
    import random

    from quayline.llm import toxicity

    rng = random.Random(4)
    texts = ["".join(rng.choices("aeio1035$!stlrn .-", k=rng.randint(20, 120))) for _ in range(60)]
    texts += [" ".join(rng.choices("abe1o$", k=60)) for _ in range(20)]
    whole = [decoder._decode(t) for t in texts]
    for window in (1, 7, 16):
        monkeypatch.setattr(toxicity, "WINDOW", window)
        assert [decoder._decode(t) for t in texts] == whole


def test_features_by_chance():
    # Of 10 toxic and 30 clean documents four are drawn; all of them, or three, are toxic.
    assert np.isclose(chance(4, 0, 10, 30), 210 / 91390)
    assert np.isclose(chance(3, 1, 10, 30), (210 + 120 * 30) / 91390)
    assert chance(0, 4, 10, 30) == pytest.approx(1.0)
    tails = np.array([0.2, 0.0001, 0.004, 0.03])
    assert significant(tails, 10, 0.05) == 0.004
    assert significant(tails, 10_000, 0.05) == -1.0
    assert significant(np.array([]), 0, 0.05) == -1.0


def test_long_stretches(decoder):
    assert decoder.restore("a" * 100_000)[0].strip("a") == ""
    assert len(decoder.restore("1a" * 5_000)[0]) > 0


def test_toxicity_of_held_out_documents(spark, bigger):
    labels = spark.read.parquet(f"{BIGGER}/labels.parquet")
    found = QUERIES["op1_toxicity"](spark, BIGGER)
    assert found.count() == bigger.count()
    unseen = found.filter("held_out").join(labels, "doc_id").collect()
    hit = sum(r.predicted and r.toxic for r in unseen)
    assert hit / max(1, sum(r.predicted for r in unseen)) > 0.85
    assert hit / max(1, sum(r.toxic for r in unseen)) > 0.6
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in unseen)


def test_toxicity_of_odd_rows(spark, odd, none, bigger):
    labels = spark.read.parquet(f"{BIGGER}/labels.parquet")
    labels = labels.unionByName(
        spark.createDataFrame([(0, 1, None), (None, 0, 1)], "doc_id long, quality int, toxic int")
    )
    model = train_toxicity(bigger, labels, in_training(), per_class=200)
    rows = score_toxicity(odd, model).collect()
    assert len(rows) == odd.count()
    assert all(r.predicted == 0 for r in rows if r.doc_id in (3, 4, 5))
    assert score_toxicity(none, model).collect() == []
    assert restore_texts(none, model.costs).collect() == []
    restored = {r.doc_id: r.restored for r in restore_texts(odd, model.costs).collect()}
    assert restored[4] is None and restored[3] == ""
    # Obfuscation does not hide what the words would show.
    words = ["you are an idiot and a moron", "you are an 1d10t and a m o r o n", "you are an idiooot"]
    shown = spark.createDataFrame(list(enumerate(words)), "doc_id long, text string")
    assert [r.predicted for r in score_toxicity(shown, model).orderBy("doc_id").collect()] == [1, 1, 1]


def test_no_labels(odd, none, spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = train_toxicity(odd, labels, in_training())
    assert {r.predicted for r in score_toxicity(odd, model).collect()} == {0}
