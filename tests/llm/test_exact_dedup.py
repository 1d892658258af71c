"""Exact duplicates against a dictionary of normalised texts."""

import hashlib
import re

import pytest

from tests.compare import compare, connect
from tidemark.llm.catalog import EXPECTED, QUERIES
from tidemark.llm.exact_dedup import exact_dedup


@pytest.mark.parametrize("name", sorted(EXPECTED))
def test_same_rows_as_sql(spark, name):
    sf = "/root/testdata/sf0.01"
    assert compare(spark, connect(sf), QUERIES[name], EXPECTED[name], sf) is None


@pytest.mark.parametrize("partitions, fan_in", [(1, 16), (9, 2)])
def test_odd_rows(spark, partitions, fan_in):
    texts = [None, "", " \t\n", "a  b", "a\r\nb", "a b", " a b", "a\x0bb", "a b", "A b", "x" * 200_000]
    rows = [(i, t) for i, t in enumerate(texts)] + [(50 - i, "hot copy") for i in range(40)]
    rows += [(None, "hot copy"), (None, "only nameless"), (None, "only nameless"), (3, "a  b"), (3, "a  b")]
    docs = spark.createDataFrame([(*r, 1, "x", b"y") for r in rows],
                                 "doc_id long, text string, run int, keep string, digest binary")
    got = exact_dedup(docs.repartition(partitions), fan_in=fan_in).collect()
    groups = {}
    for doc_id, text in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", text or ""), []).append(doc_id)
    assert len(got) == len(rows)
    assert sum(r["kept"] for r in got) == len(groups)
    facts = {hashlib.sha256(t.encode()).hexdigest(): (
        len(ids), min((i for i in ids if i is not None), default=None)) for t, ids in groups.items()}
    for r in got:
        assert (r["group_size"], r["keep_id"]) == facts[r["text_sha256"]]
        assert not r["kept"] or r["doc_id"] == r["keep_id"]
    assert exact_dedup(docs.limit(0)).count() == 0
