"""Exact duplicates against grouping by the text itself."""

from __future__ import annotations

import hashlib
import random
from collections import defaultdict

from quayline.llm import naming
from quayline.llm.naming import exact_duplicates
from quayline.llm.queries import QUERIES

from llm.llm_support import DATA


def expected(rows) -> dict:
    """For each row: size of its group and the id that stays, by comparing texts."""
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[text or ""].append(doc_id)
    out = defaultdict(list)
    for text, ids in groups.items():
        stays = max((i for i in ids if i is not None), default=None)
        for i in ids:
            out[i].append((stays, len(ids), hashlib.sha256(text.encode()).hexdigest()))
    return {i: sorted(v, key=str) for i, v in out.items()}


def check(found, rows) -> None:
    got = defaultdict(list)
    kept = defaultdict(int)
    for r in found:
        got[r.doc_id].append((r.keep_id, r.group_size, r.text_sha256))
        kept[r.text_sha256] += r.kept
        assert not r.kept or r.doc_id == r.keep_id
    assert {i: sorted(v, key=str) for i, v in got.items()} == expected(rows)
    # One row of each group stays.
    assert set(kept.values()) <= {1}


def test_odd_rows(odd):
    check(exact_duplicates(odd).collect(), [(r.doc_id, r.text) for r in odd.collect()])


def test_no_rows(none):
    assert exact_duplicates(none).count() == 0


def test_texts_that_differ_by_a_block(spark, monkeypatch):
    """Texts of up to forty blocks that share blocks, orders of blocks, beginnings and ends."""
    monkeypatch.setattr(naming, "BLOCK_BYTES", 4)
    rng = random.Random(5)
    pieces = ["aaaa", "aaab", "\x00\x00\x00\x00", "éé", "abca"]
    texts = ["".join(rng.choices(pieces, k=rng.choice([1, 2, 3, 7, 8, 9, 40]))) for _ in range(80)]
    texts += [t[:-1] for t in texts[:20]] + [t + "a" for t in texts[:20]] + texts[:30] * 2
    texts += ["aaaa" * n for n in range(1, 20)] * 2
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    check(exact_duplicates(docs).collect(), rows)


def test_frequent_and_rare_keys_agree(spark, monkeypatch):
    """Groups meet in a task or are combined first: which, changes nothing."""
    rows = [(i, f"text {i % 7 if i % 3 else i}") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    for frequent in (2, 1000):
        monkeypatch.setattr(naming, "FREQUENT", frequent)
        check(exact_duplicates(docs).collect(), rows)


def test_repeated_and_missing_ids(spark):
    rows = [(1, "a"), (1, "a"), (1, "b"), (None, "a"), (None, "c"), (None, "c"), (2, None), (3, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    check(exact_duplicates(docs).collect(), rows)


def test_long_text(spark):
    long = "lorem ipsum " * 100_000
    rows = [(1, long), (2, long + "x"), (3, long), (4, long[:-1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    check(exact_duplicates(docs).collect(), rows)


def test_no_python_in_the_plan(spark):
    plan = QUERIES["op11_naming"](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "ExistingRDD" not in plan
