"""Id files, pieces and edit-aware counts against the libraries."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from quayline.llm.edits import CountedText, Counter, count_edits, edits_by_document, read_ranks
from quayline.llm.idfiles import (
    EliasFano,
    IdFile,
    WordTable,
    id_file_documents,
    pack_file,
    read_tokenizer,
)
from quayline.llm.pieces import (
    ChunkTable,
    chunks_of,
    decode_ids,
    encode_documents,
    encode_rows,
    encoding_digests,
    read_model,
)
from quayline.llm.queries import QUERIES

from llm.llm_support import DATA

SCRAPS = [
    " ", "  ", "\n", "\t", "a", "b", "the", "The", "'s", "'re", "'", "r", "1", "23", "½", "!", "&&.",
    "é", "漢", "😀", "\x00", "\x1c", "\x85", "　", "ﬁ", "é", "Σ", "ΑΣ", "İ", "ß", "_", "▁",
    "<s>", "</s>", "<|endoftext|>", "<|ENDOFTEXT|>", "-", "​", "́",
]


def scraps(rng: random.Random, most: int) -> str:
    return "".join(rng.choice(SCRAPS) for _ in range(rng.randrange(most)))


@pytest.fixture(scope="module")
def model():
    return read_model(public_tokenizers.path("piece_bpe_32k.model"))


@pytest.fixture(scope="module")
def words():
    return read_tokenizer(public_tokenizers.path("word_bpe_49k.json"))


def texts_of(docs):
    return [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]


def test_chunks_are_encoded_as_the_library_encodes_texts(model, docs):
    table = ChunkTable(model, entries=500)
    rng = random.Random(3)
    texts = [scraps(rng, 30) for _ in range(4000)] + [t for _, t in texts_of(docs)]
    for start in range(0, len(texts), 100):
        run = texts[start : start + 100]
        parts = [chunks_of(t) if t else [] for t in run]
        table.add(parts)
        encoded = table.processor.encode(run)
        assert [table.encode(p).tolist() for p in parts] == encoded
        assert [table.decode(p) for p in parts] == table.processor.decode(encoded)


def test_piece_operators(spark, odd, none, model):
    library = ChunkTable(model).processor
    rows = encode_documents(odd, model).collect()
    want = [(i, library.encode(t or "") + [2]) for i, t in texts_of(odd)]
    assert [(r.doc_id, r.ids) for r in rows] == want
    assert [r.decoded for r in rows] == [library.decode(ids) for _, ids in want]
    digests = encoding_digests(odd, model).collect()
    assert [(r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in digests] == [
        (
            len(ids),
            hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
            hashlib.sha256(library.decode(ids).encode()).hexdigest(),
        )
        for _, ids in want
    ]
    decoded = decode_ids(encode_documents(odd, model), model).collect()
    assert [r.text for r in decoded] == [r.decoded for r in rows]
    whole = encode_rows(odd, model)
    assert set(odd.columns) - {"text"} <= set(whole.columns)
    # Only the marker character itself is not given back.
    assert [r.doc_id for r in whole.filter("not exact").collect()] == [8]
    for made in (encode_documents(none, model), encoding_digests(none, model), encode_rows(none, model)):
        assert made.collect() == []


def test_piece_query(spark, docs, model):
    library = ChunkTable(model).processor
    rows = {r.doc_id: r for r in QUERIES["op4_pieces"](spark, DATA).collect()}
    assert len(rows) == docs.count()
    for i, text in texts_of(docs):
        ids = library.encode(text) + [2]
        assert rows[i].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()


@pytest.mark.parametrize(
    ("count", "top"), [(0, 1), (1, 0), (1, 10**12), (5, 3), (700, 10**9), (3000, 10)]
)
def test_elias_fano(count, top):
    values = np.sort(np.random.default_rng(1).integers(0, top + 1, count))
    data = EliasFano.to_bytes(values)
    read = EliasFano(data)
    assert [read.select(i) for i in range(count)] == values.tolist()
    for first, some in ((0, count), (0, 7), (3, 300), (255, 2), (count - 1, 5), (count, 4)):
        first = max(first, 0)
        assert read.run(first, some).tolist() == values[first : first + some].tolist()
    # About 2 + log2(top / count) bits a value, and the samples.
    if count:
        bits = 3 + max(0, np.log2(max(top, 1) / count))
        assert len(data) <= 48 + count * bits / 8 + 8 * (count // 256 + 1)
    with pytest.raises(IndexError):
        read.select(count)


def test_file_of_ids():
    names = [None, None, -5, 0, 3, 3]
    ids = [bytes(range(0, 2 * n)) for n in (0, 3, 1, 0, 40, 2)]
    file = IdFile(pack_file(names, ids, 2))
    assert file.doc_ids(0, 6) == names == [file.doc_id(i) for i in range(6)]
    for first in range(6):
        for count in range(7 - first):
            assert file.doc_ids(first, count) == names[first : first + count]
    assert [file.document(i).tobytes() for i in range(6)] == ids
    with pytest.raises(ValueError, match="not a file"):
        IdFile(b"x" * 200)


def test_words_are_encoded_as_the_library_encodes_texts(words, docs):
    table = WordTable(Tokenizer.from_str(words), 2, entries=2000)
    assert table.parted
    rng = random.Random(4)
    texts = [scraps(rng, 30) for _ in range(8000)] + [t for _, t in texts_of(docs)]
    for start in range(0, len(texts), 200):
        run = texts[start : start + 200]
        library = table.tokenizer.encode_batch(run, add_special_tokens=False)
        for own, found in zip(table.encode(run), library, strict=True):
            assert np.frombuffer(own, "<u2").tolist() == found.ids


def expected_files(rows, words):
    tokenizer, at = Tokenizer.from_str(words), 0
    for doc_id, text in rows:
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [1], "<u4")
        yield doc_id, at, len(ids), zlib.crc32(ids.tobytes())
        at += len(ids)


def test_id_files(spark, odd, none, docs, words):
    rows = [tuple(r) for r in QUERIES["op2_id_files"](spark, DATA).orderBy("doc_id").collect()]
    assert rows == list(expected_files(sorted(texts_of(docs)), words))
    assert id_file_documents(none, words).collect() == []
    # Rows that share an id may stand in either order.
    found = id_file_documents(odd, words).orderBy("start").collect()
    assert [r.doc_id for r in found] == sorted(
        (i for i, _ in texts_of(odd)), key=lambda i: (i is not None, i or 0)
    )
    tokens = sorted((i is not None, i, n, c) for i, _, n, c in expected_files(texts_of(odd), words))
    assert sorted((r.doc_id is not None, r.doc_id, r.n_tokens, r.ids_crc32) for r in found) == tokens
    assert [r.start for r in found] == [sum(r.n_tokens for r in found[:i]) for i in range(len(found))]


@pytest.fixture(scope="module")
def ranks():
    return read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))


def test_counts_follow_edits(ranks):
    counter = Counter(ranks, public_tokenizers.PATTERN)
    count = lambda t: len(counter.encoding.encode_ordinary(t))
    rng = random.Random(5)
    for _ in range(600):
        counted = CountedText(scraps(rng, 400), counter)
        text = counted.text
        assert counted.n_tokens == count(text)
        for _ in range(rng.randrange(1, 10)):
            start, deleted = rng.randrange(-2, len(text) + 4), rng.choice([0, 0, 1, 2, 5, 50, 400])
            inserted = scraps(rng, rng.choice([1, 2, 4, 150]))
            at = min(max(start, 0), len(text))
            text = text[:at] + inserted + text[at + deleted :]
            counted.edit(start, deleted, inserted)
            assert counted.text == text
            assert counted.n_tokens == count(text)


def test_edits_touch_little(ranks):
    counter = Counter(ranks, public_tokenizers.PATTERN)
    counted = CountedText("some words of a long text " * 5000, counter)
    assert counted.edit(60_000, 4, "changed") < 8
    assert counted.n_pieces > 29_000


def test_edit_operator(spark, odd, none, ranks):
    edits = spark.createDataFrame(
        [(1, 2, 0, 3, ""), (1, 1, 4, 0, "NEW "), (2, 0, 10**9, 5, " end"), (3, 0, 0, 0, "a b"),
         (4, 0, 3, 1, None), (6, 0, 100_000, 7, "!"), (8, 0, None, None, "x")],
        "doc_id long, seq long, start long, deleted long, inserted string",
    )
    joined = odd.join(edits_by_document(edits), "doc_id", "left")
    counter = Counter(ranks, public_tokenizers.PATTERN)
    rows = count_edits(joined, ranks, public_tokenizers.PATTERN, with_text=True).collect()
    assert len(rows) == odd.count()
    for r in rows:
        assert r.n_tokens_edited == len(counter.encoding.encode_ordinary(r.edited))
    texts = {r.doc_id: r.edited for r in rows}
    assert texts[1].startswith(" NEW quick")
    assert texts[2].endswith("bank end") and texts[3] == "a b" and texts[4] == ""
    assert count_edits(none.selectExpr("*", "CAST(NULL AS array<struct<start:int,deleted:int,inserted:string>>) AS edits"),
                       ranks, public_tokenizers.PATTERN).collect() == []


def test_edit_query(spark, docs, ranks):
    counter = Counter(ranks, public_tokenizers.PATTERN)
    count = lambda t: len(counter.encoding.encode_ordinary(t))
    rows = {r.doc_id: r for r in QUERIES["op7_edits"](spark, DATA).collect()}
    for d in docs.collect():
        text, n = d.text, len(d.text)
        text = text[: n // 3] + d.source + text[n // 3 + 7 :]
        text = text[: 2 * n // 3] + f" {d.lang}\n" + text[2 * n // 3 :]
        assert (rows[d.doc_id].n_tokens, rows[d.doc_id].n_tokens_edited) == (
            count(d.text), count(text[3:])
        )
