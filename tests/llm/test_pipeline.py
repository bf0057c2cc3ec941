"""The pipeline, stage by stage, against brute force on each stage's own input."""

from __future__ import annotations

import re
from collections import Counter

import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor

import corpus_pipeline
from quayline.llm.language import predict_language, train_language
from quayline.llm.common import in_training, staged
from quayline.llm.mixing import source_targets

from llm.test_duplicates import expected
from llm.llm_support import DATA


@pytest.fixture(scope="module")
def stages(spark, docs):
    """Inputs and outputs of the stages over the small table and some rows of junk."""
    junk = spark.createDataFrame(
        [(10**6, "12345 !!! ???", "en", "src0", 13), (10**6 + 1, None, "en", "src1", 0),
         (10**6 + 2, "", None, None, 0)],
        docs.schema,
    )
    now, found = docs.unionByName(junk), []
    for name, stage in corpus_pipeline.STAGES:
        after = staged(stage(spark, now, DATA), f"test-{name}")
        found.append((name, now, after))
        now = after
    return {name: (before, after) for name, before, after in found}


def bag(table):
    return Counter(map(tuple, table.collect()))


def test_names():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "language", "near_duplicates", "secrets", "mixing", "pieces",
    ]


def test_columns(stages, docs):
    for name, (_, after) in stages.items():
        if name != "pieces":
            assert after.columns == docs.columns
            assert [f.dataType for f in after.schema] == [f.dataType for f in docs.schema]


def test_language(stages):
    before, after = stages["language"]
    model = train_language(before, in_training())
    gone = {r.doc_id for r in predict_language(before, model).filter("rejected").collect()}
    assert {10**6, 10**6 + 1, 10**6 + 2} <= gone
    assert bag(after) == bag(before.filter(~before.doc_id.isin(*gone)))
    assert after.count() >= 0.97 * (before.count() - 3)


def test_near_duplicates(stages):
    before, after = stages["near_duplicates"]
    kept = {i for i, _, _, k in expected([(r.doc_id, r.text) for r in before.collect()], 5, 80) if k}
    assert bag(after) == bag(before.filter(before.doc_id.isin(*kept)))


def test_secrets(stages):
    before, after = stages["secrets"]
    texts = {r.doc_id: r for r in after.collect()}
    assert len(texts) == before.count() == after.count()
    for r in before.collect():
        own = texts[r.doc_id]
        assert own.n_chars == len(own.text)
        assert not re.search("[0-9a-f]{24,}", own.text)
        if "[SECRET]" not in own.text:
            assert own.text == r.text


def test_mixing(stages):
    before, after = stages["mixing"]
    size = {r.doc_id: len(re.findall(r"[^\x20\x09-\x0D]+", r.text)) for r in before.collect()}
    source = {r.doc_id: r.source for r in before.collect()}
    sizes, taken = Counter(), Counter()
    for i, n in size.items():
        sizes[source[i]] += n
    rows = after.collect()
    for r in rows:
        taken[r.source] += size[r.doc_id]
    assert max(Counter(r.doc_id for r in rows).values()) <= 2
    assert set(bag(after)) <= set(bag(before))
    for s, target in source_targets(dict(sizes)).items():
        largest = max(n for i, n in size.items() if source[i] == s)
        assert abs(taken[s] - target) <= largest


def test_pieces(stages):
    before, after = stages["pieces"]
    library = SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    want = Counter((r.doc_id, tuple(library.encode(r.text) + [2])) for r in before.collect())
    assert Counter((r.doc_id, tuple(r.ids)) for r in after.collect()) == want
    assert after.filter("not exact").count() == 0


@pytest.fixture(params=["in files", "in memory"])
def shared(request, spark, docs):
    """Rows that share an id, or have none: copies and texts of their own."""
    one, two, three = (" ".join(f"{w}{i}" for i in range(60)) for w in ("one", "two", "three"))
    rows = [(1, one), (2, one), (2, two), (3, three), (3, three), *[(None, one)] * 3]
    rows += [(None, "alone " * 9 + "without copies"), *[(None, "no id " * 9 + "but copies")] * 40]
    rows = [(i, t, "en", "src0", len(t)) for i, t in rows]
    found = spark.createDataFrame(rows, docs.schema)
    return staged(found.repartition(3), "shared") if request.param == "in files" else found


def test_near_duplicates_that_share_ids(spark, shared):
    after = corpus_pipeline.drop_near_duplicates(spark, shared, DATA).collect()
    found = Counter((r.doc_id, r.text.split()[0]) for r in after)
    assert found == Counter([(1, "one0"), (2, "two0"), (3, "three0"), (None, "alone"), (None, "no")])


def test_mixing_of_rows_that_share_ids(spark, docs):
    text = "ten words " * 5
    for i in (None, 7):
        rows = [(i, text, "en", f"src{k % 3}", len(text)) for k in range(300)]
        before = staged(spark.createDataFrame(rows, docs.schema), "mixed")
        after = corpus_pipeline.mix(spark, before, DATA)
        taken = Counter(r.source for r in after.collect())
        for s, target in source_targets({f"src{k}": 1000 for k in range(3)}).items():
            assert abs(10 * taken[s] - target) <= 10, (i, s)


def test_run(spark):
    assert corpus_pipeline.run(spark, DATA).count() > 0
    assert corpus_pipeline.ORACLE_SQL is None


def test_empty(spark, docs):
    now = docs.limit(0)
    for name, stage in corpus_pipeline.STAGES:
        now = staged(stage(spark, now, DATA), f"empty-{name}")
    assert now.count() == 0
