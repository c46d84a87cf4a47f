"""Every registered query, and those with an oracle against it."""

from roadpulse.llm.oracle import oracle_sql
from roadpulse.llm.queries import queries
from tests.llm.conftest import SMALL
from tools.parity import compare


def test_queries_match_their_sql(spark):
    names = sorted(oracle_sql())
    report = compare(spark, SMALL, names)
    assert {n: report[n].get("match") for n in names} == dict.fromkeys(names, True)


def test_thirteen_queries_are_registered():
    import __spark_entry__ as entry

    assert sorted(int(n[2:].split("_")[0]) for n in queries()) == list(range(1, 14))
    assert queries().keys() | {"pipeline"} <= entry.queries().keys()
