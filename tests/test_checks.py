"""Every report over the test tables gives the rows of its SQL."""

import pytest

import __spark_entry__ as contract
from compare import compare, duck
from placewise.checks import oracle, reports

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_report_has_its_sql():
    assert reports.REPORTS.keys() == oracle.SQL.keys()
    assert contract.queries().keys() >= reports.REPORTS.keys() and contract.oracle_sql().keys() >= oracle.SQL.keys()


@pytest.mark.parametrize("name", reports.REPORTS)
def test_report_equals_sql(spark, con, name):
    same, note = compare(spark, con, SF, name)
    assert same, note


@pytest.mark.parametrize("name", ["stream_by_location", "stream_sorted_location", "stream_handles"])
def test_live_rankings_are_read_in_their_order(spark, name):
    counts = [r[1] for r in contract.queries()[name](spark, SF).collect()]
    assert len(set(counts)) > 1 and counts == sorted(counts, reverse=True)


def test_regions_keep_every_post(spark):
    shares = contract.queries()["share_by_region"](spark, SF)
    assert shares.agg({"posts": "sum"}).first()[0] == spark.read.parquet(f"{SF}/events.parquet").count()


def test_flagship(spark):
    df = contract.entry(spark)
    assert df.columns == ["source", "Tot_Tweets_By_Device", "ratio"] and df.count() == 5
