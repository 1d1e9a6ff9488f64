"""Every registered query against its DuckDB answer over whole tables."""

from __future__ import annotations

import pytest
from compare import catalogue, connect, differences

import __spark_entry__ as entry

QUERIES, ORACLE = catalogue(entry.queries()), catalogue(entry.oracle_sql())


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, sf_dir, name):
    assert differences(QUERIES[name](spark, sf_dir), duck, ORACLE[name]) == ""


def test_known_totals(spark):
    """Totals of whole pairs and rows counted independently on the larger sample."""
    sf_dir = "/root/testdata/sf0.01"

    def total(name):
        return QUERIES[name](spark, sf_dir).selectExpr("sum(occurrences)").first()[0]

    assert total("lineitem_sequence_gaps") == 28_978
    assert total("orders_same_customer_date") == 32
    assert total("lineitem_ship_inversions") == 51_400
    assert QUERIES["orders_without_lineitem"](spark, sf_dir).count() == 257
    assert QUERIES["documents_without_label"](spark, sf_dir).count() == 601
    assert QUERIES["documents_canonical"](spark, sf_dir).where("doc_id <> first_id").count() == 73
    assert QUERIES["events_numbered"](spark, sf_dir).where("seq = 0").count() == 0
    assert QUERIES["conversations_last_turn"](spark, sf_dir).count() == 100
