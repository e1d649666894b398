"""Driver contract: every oracle entry has a registered plan, every plan of
this library has an oracle, and entry() runs on the smoke tables."""

import __spark_entry__ as entry
from cathlake.plans.oracle import ORACLE
from cathlake.plans.queries import QUERIES


def test_plans_and_oracles_pair_up():
    q, o = entry.queries(), entry.oracle_sql()
    assert set(ORACLE) <= set(q), sorted(set(ORACLE) - set(q))
    assert set(QUERIES) <= set(q) and set(QUERIES) <= set(o)
    assert len(QUERIES) >= 52


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns[-1] == "diagnostic_data"
    assert df.count() > 0
