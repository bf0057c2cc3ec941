"""Files made of the documents against the SQL of the queries that read them."""

from __future__ import annotations

from collections import Counter

import duckdb
import pytest

from quayline.plans.queries import ORACLES, QUERIES

FILED = ["slots_source_scan", "slots_split_scan", "slots_read_metrics", "slots_hadoop_scan",
         "slots_payload_scan", "slots_stream_scan", "slots_batch_scan", "stream_report"]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Three documents, one of them without a language."""
    base = tmp_path_factory.mktemp("feeds")
    rows = [(1, "one\ntwo", "en"), (2, "drei", "de"), (1003, "four\nfive\nsix", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    docs.write.parquet(f"{base}/documents.parquet")
    return base


@pytest.mark.parametrize("key", FILED)
def test_documents_without_a_language(spark, folder, key):
    result = QUERIES[key](spark, str(folder))
    columns = sorted(result.columns)
    found = Counter(tuple(r) for r in result.select(*columns).collect())
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet/*.parquet'")
    wanted = con.execute(f"SELECT {', '.join(columns)} FROM ({ORACLES[key]})").fetchall()
    assert found == Counter(wanted) and any("other" in r for r in wanted)
