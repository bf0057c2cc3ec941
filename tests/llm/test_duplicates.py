"""Near-duplicates, components and fingerprints against brute force."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import quayline.llm.minmax as minmax
from quayline.llm.bottomk import (
    containment,
    distinct_shingles,
    edited_fingerprints,
    merge_sketches,
    merged,
    resemblance,
    sketch,
)
from quayline.llm.components import connected_components
from quayline.llm.minmax import bands_for, band_keys, min_max, multipliers, near_duplicates
from quayline.llm.queries import QUERIES

from llm.llm_support import DATA

LOWER = {c: c + 32 for c in range(65, 91)}


def shingles(text, words):
    found = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if not found:
        return set()
    return {tuple(found[i : i + words]) for i in range(max(1, len(found) - words + 1))}


def components(n, links):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in links:
        root[find(a)] = find(b)
    return [find(i) for i in range(n)]


def expected(rows, words, percent):
    """(doc_id, shingles, component, kept) of each row, comparing every pair that shares a shingle."""
    sets = [shingles(t, words) for _, t in rows]
    places, links = defaultdict(list), []
    for i, own in enumerate(sets):
        shared = Counter(j for s in own for j in places[s])
        links += [
            (i, j) for j, n in shared.items() if 100 * n >= percent * (len(own) + len(sets[j]) - n)
        ]
        for s in own:
            places[s].append(i)
    root = components(len(rows), links)
    least = {}
    for (i, _), r in zip(rows, root, strict=True):
        if i is not None:
            least[r] = min(i, least.get(r, i))
    return Counter(
        (i, len(s), least.get(r), i == least.get(r))
        for (i, _), s, r in zip(rows, sets, root, strict=True)
    )


def check(docs, words, percent):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    found = Counter(tuple(r) for r in near_duplicates(docs, words, percent).collect())
    assert found == expected(rows, words, percent)


def test_odd_rows(odd, none):
    check(odd, 3, 85)
    check(odd, 5, 80)
    assert near_duplicates(none).collect() == []


def test_query(spark, docs):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    found = Counter(tuple(r) for r in QUERIES["op5_minmax"](spark, DATA).collect())
    assert found == expected(rows, 3, 85)


@pytest.fixture(scope="module")
def family(spark):
    """Copies of one text with words changed: chains of links in which few pairs are linked."""
    rng = random.Random(9)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(150):
        if i % 10 == 0:
            base = list(base)
            base[rng.randrange(60)] = f"n{i}"
        own = list(base)
        for _ in range(rng.randrange(3)):
            own[rng.randrange(60)] = f"v{rng.randrange(40)}"
        rows.append((1000 - i, " ".join(own)))
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_family(family):
    check(family, 3, 85)


def test_chunks_lose_no_link(family, monkeypatch):
    # Buckets of the family are cut into many chunks, and each two of them walked together.
    monkeypatch.setattr(minmax, "CHUNK_SETS", 8)
    check(family, 3, 85)
    check(family, 5, 80)


@pytest.fixture
def texts_moved(monkeypatch):
    """How many rows carry a text to a comparison."""
    moved, links = [], minmax._links

    def counted(members, *others):
        moved.append(members.count())
        return links(members, *others)

    monkeypatch.setattr(minmax, "_links", counted)
    return moved


def test_rows_without_ids_are_told_apart(spark, texts_moved):
    """Null and repeated ids: a text is moved once for each of its buckets, not once for every row."""
    words = [f"w{i}" for i in range(40)]
    rows = [(None if i % 2 else 7, " ".join([*words[: i % 3], f"x{i % 50}", *words])) for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    check(df, 3, 85)
    check(df.withColumn("doc_id", F.lit(None).cast("long")), 3, 85)
    # 150 different texts in at most as many buckets as there are bands.
    assert max(texts_moved) <= 150 * bands_for(0.85)


def test_families_grow_in_proportion(spark, texts_moved, monkeypatch):
    """Twice the near copies, in buckets of many chunks, move about twice the texts."""
    monkeypatch.setattr(minmax, "CHUNK_SETS", 16)
    words = [f"w{i}" for i in range(200)]
    sizes = []
    for n in (200, 400):
        rows = [(i, " ".join([*words, f"x{i}"])) for i in range(n)]
        texts_moved.clear()
        check(spark.createDataFrame(rows, "doc_id long, text string"), 5, 80)
        sizes.append(sum(texts_moved))
    assert sizes[1] <= 2.6 * sizes[0]


def test_signature_agrees_as_often_as_sets_resemble():
    import numpy as np

    rng = np.random.default_rng(2)
    shared = rng.integers(0, 1 << 63, 900, np.uint64)
    a = np.unique(np.concatenate([shared, rng.integers(0, 1 << 63, 100, np.uint64)]))
    b = np.unique(np.concatenate([shared, rng.integers(0, 1 << 63, 100, np.uint64)]))
    factors = multipliers(2000)
    one, two = min_max(a, factors), min_max(b, factors)
    for part in (slice(0, 2000), slice(2000, 4000)):
        assert abs((one[part] == two[part]).mean() - 900 / 1100) < 0.04
    # Runs of any length give the same extremes.
    assert (min_max(a, factors[:5], run=7) == min_max(a, factors[:5])).all()


def test_bands_find_pairs_at_the_limit():
    import numpy as np

    rng = np.random.default_rng(3)
    bands = bands_for(0.85)
    factors = multipliers(bands * minmax.ROWS // 2)
    missed = 0
    for _ in range(200):
        shared = rng.integers(0, 1 << 63, 340, np.uint64)
        sets = [np.concatenate([shared, rng.integers(0, 1 << 63, 30, np.uint64)]) for _ in "ab"]
        keys = [band_keys(min_max(s, factors), bands) for s in sets]
        missed += not (keys[0] == keys[1]).any()
    assert missed == 0


def test_components(spark):
    rng = random.Random(1)
    links = [(i, i + 1) for i in range(60)]  # a long path
    links += [(100, i) for i in range(101, 160)]  # a star
    links += [(rng.randrange(200, 400), rng.randrange(200, 400)) for _ in range(120)]
    links += [(5, 5), (7, 3), (3, 7)]
    table = spark.createDataFrame([*links, (None, 3), (9, None)], "a long, b long")
    found = {r.vertex: r.root for r in connected_components(table).collect()}
    root = components(400, links)
    least = {r: min(i for i in range(400) if root[i] == r) for r in set(root)}
    met = {v for a, b in links if a != b for v in (a, b)}
    assert found == {v: least[root[v]] for v in met}
    assert connected_components(table.limit(0)).collect() == []


# Fingerprints


def test_fingerprints_of_odd_rows(odd, none):
    rows = edited_fingerprints(odd).collect()
    assert len(rows) == odd.count()
    by_text = defaultdict(set)
    texts = {}
    for r in odd.collect():
        texts.setdefault(r.doc_id, set()).add(r.text or "")
    for r in rows:
        assert r.n_chars in {len(t) for t in texts[r.doc_id]}
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 and 0 <= r.kept_share <= 1
        if r.doc_id is not None:
            by_text[next(iter(texts[r.doc_id]))].add(r.fingerprint)
    assert all(len(prints) == 1 for prints in by_text.values())
    assert edited_fingerprints(none).collect() == []


def test_single_document_follows_itself(spark):
    docs = spark.createDataFrame([(7, "a b c d e f g h")], "doc_id long, text string")
    row = edited_fingerprints(docs).first()
    assert row.near_next == 1.0 and row.n_shingles == 4.0


def test_estimates(spark):
    words = [f"w{i}" for i in range(3000)]
    rows = [(1, " ".join(words)), (2, " ".join(words[:1500])), (3, " ".join(words[1000:]))]
    table = spark.createDataFrame(rows, "doc_id long, text string").select(
        "doc_id", sketch(F.col("text"), 400).alias("s")
    )
    a, b = table.alias("a"), table.alias("b")
    got = a.join(b, F.col("a.doc_id") < F.col("b.doc_id")).select(
        "a.doc_id", F.col("b.doc_id").alias("other"),
        resemblance(F.col("a.s"), F.col("b.s"), 400).alias("alike"),
        containment(F.col("b.s"), F.col("a.s"), 400).alias("inside"),
        distinct_shingles(F.col("a.s"), 400).alias("n"),
    ).collect()
    want = {(1, 2): (0.5, 1.0), (1, 3): (0.667, 1.0), (2, 3): (0.167, 0.25)}
    for r in got:
        alike, inside = want[r.doc_id, r.other]
        assert abs(r.alike - alike) < 0.08 and abs(r.inside - inside) < 0.12
        assert abs(r.n / {1: 2996, 2: 1496}[r.doc_id] - 1) < 0.15


def test_sketches_merge(spark):
    rng = random.Random(2)
    parts = [(k, " ".join(rng.choices("abcdefgh", k=30))) for k in (1, 2, None) for _ in range(300)]
    table = spark.createDataFrame(parts, "k long, text string").select(
        "k", sketch(F.col("text")).alias("fingerprint")
    )
    found = {r.k: r.fingerprint for r in merge_sketches(table, "k").collect()}
    whole = defaultdict(set)
    for r in table.collect():
        whole[r.k].update(r.fingerprint)
    assert found == {k: sorted(v)[:64] for k, v in whole.items()}
    assert merge_sketches(table.limit(0), "k").collect() == []
    # Copies of one part, more than a task merges at a time, are one part.
    copies = table.filter("k = 1").limit(1).crossJoin(spark.range(700)).select("k", "fingerprint")
    assert merge_sketches(copies, "k").collect() == copies.distinct().collect()
    two = table.limit(2).collect()
    pair = spark.createDataFrame([(two[0][1], two[1][1])], "a array<string>, b array<string>")
    assert pair.select(merged(F.col("a"), F.col("b"))).first()[0] == sorted(
        {*two[0][1], *two[1][1]}
    )[:64]
