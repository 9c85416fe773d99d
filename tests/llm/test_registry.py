import __spark_entry__ as E

from starloom.llm import queries as Q


def test_every_operator_is_registered():
    names = set(E.queries())
    assert set(Q.QUERIES) <= names and "pipeline" in names
    assert {int(n[2:].split("_")[0]) for n in Q.QUERIES} == set(range(1, 14))
    assert set(Q.ORACLE_SQL) <= set(E.oracle_sql())
