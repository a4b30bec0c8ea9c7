"""Every core query against its SQL, and some against themselves with other partitionings."""

import pytest
from compare import differences, rows_of

from quotaloom.plans import load_all
from quotaloom.plans.registry import ORACLES, QUERIES

load_all()
SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, name):
    said = differences(spark, name, QUERIES[name], ORACLES.get(name), SF)
    assert said.startswith(("equal", "rows only")), said


@pytest.mark.parametrize("name", ["p5_found", "quota_plan", "plan_joined_pool", "generate_samples", "duplicate_names_topk"])
def test_partitioning_changes_nothing(spark, name):
    got = []
    for n in ("1", "7"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        df = QUERIES[name](spark, SF)
        got.append(rows_of(df.columns, df.collect()))
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert got[0] == got[1] and got[0]


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
