"""Registered queries of the subpackage against their SQL, and the pipeline end to end."""

from __future__ import annotations

import pytest
from compare import compare, oracle_connection

from tablecheck.llm.oracle import ORACLE
from tablecheck.llm.queries import QUERIES

BY_BRUTE_FORCE = {
    "op2_decontamination",
    "op4_byte_bpe",
    "op5_html_text",
    "op6_quality_classifier",
    "op10_quality_rules",
    "op13_simhash_dedup",
}


@pytest.fixture(scope="module")
def connection(sf_dir):
    with oracle_connection(sf_dir) as opened:
        yield opened


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_rows_as_sql(spark, connection, sf_dir, name):
    compare(spark, connection, sf_dir, QUERIES[name], ORACLE[name])


def test_the_others_have_brute_force_tests():
    assert set(QUERIES) - set(ORACLE) == BY_BRUTE_FORCE
