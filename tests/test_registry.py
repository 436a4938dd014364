"""The registered keys of the reference's operators and their SQL."""

from cabflow.oracle import oracle_sql
from cabflow.registry import QUERIES


def test_every_key_has_sql():
    assert set(QUERIES) == set(oracle_sql())
