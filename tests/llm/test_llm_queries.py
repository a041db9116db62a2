"""Registered queries of the training-data operators against DuckDB on the given tables."""

import pytest

from mercato.llm.queries import build_llm_oracle, build_llm_queries
from tests.llm.conftest import SF

TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


def ordered(rows):
    return sorted(rows, key=lambda r: [(v is None, str(v)) for v in r])


@pytest.mark.parametrize("name", sorted(build_llm_oracle()))
def test_query_equals_duckdb(llm, duck, name):
    df = build_llm_queries()[name](llm, SF)
    columns = sorted(df.columns)
    got = ordered(tuple(r[c] for c in columns) for r in df.collect())
    result = duck.execute(build_llm_oracle()[name])
    kinds = {d[0]: str(d[1]) for d in result.description}
    assert {c: TYPES[t] for c, t in df.dtypes} == kinds
    at = [[d[0] for d in result.description].index(c) for c in columns]
    assert got == ordered(tuple(r[i] for i in at) for r in result.fetchall())


def test_every_operator_is_registered_once():
    names = [n.split("_")[0] for n in build_llm_queries() if n != "pipeline"]
    assert sorted(names) == sorted(f"op{n}" for n in range(1, 14))


def test_chat_formatting_runs_no_python(llm):
    plan = build_llm_queries()["op3_chat_format"](llm, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
