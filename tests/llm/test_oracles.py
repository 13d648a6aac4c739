"""The operators that SQL can express equal it on the smallest given tables."""

from __future__ import annotations

import pytest
from oracle_harness import digest, duck

from shelfguard.llm.queries import ORACLE_SQL, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_its_sql(spark, small, name):
    df = QUERIES[name](spark, small)
    found = duck(small).execute(ORACLE_SQL[name])
    assert digest(df.columns, [tuple(r) for r in df.collect()])[:3] == digest([c[0] for c in found.description], found.fetchall())[:3]


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
