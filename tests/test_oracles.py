"""Every registered query against its SQL, and all of them again with salted lookup joins."""

import pytest
from oracle import compare, connect

import __spark_entry__ as entry
from lexgraph.plans import lookup, stage
from lexgraph.workload.oracles import ORACLES
from lexgraph.workload.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
LOOKUPS = [
    "tag_cooccur", "tag_kept", "tag_paths", "tag_paths_for_terms", "classify_terms", "nature_label",
    "tokens_with_nature", "drop_stopwords", "read_lenient",
]


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("key", list(QUERIES))
def test_query(spark, duck, key):
    assert compare(entry.queries()[key](spark, SF_DIR), duck, entry.oracle_sql()[key]) == ""


@pytest.mark.parametrize("key", LOOKUPS)
def test_query_without_broadcast(spark, duck, key, monkeypatch):
    monkeypatch.setattr(stage, "MAX_BROADCAST_ROWS", -1)
    monkeypatch.setattr(lookup, "HOT_KEYS", 64)
    assert compare(entry.queries()[key](spark, SF_DIR), duck, entry.oracle_sql()[key]) == ""


def test_entry(spark):
    assert entry.entry(spark).columns == ["tag1", "tag2", "tag1num", "tag2num", "twotagnum"]
