"""The shape of the plans: what is scanned, what is shuffled, what stays in the JVM."""

import io
import re
from contextlib import redirect_stdout

import pytest
from pyspark.sql import functions as F

from placewise.checks.reports import REPORTS
from placewise.operators import joining

SF = "/root/testdata/sf0.001"
# Reports about a run or a schema hand a few rows over from the driver; what they ran is not in their plan.
TOLD = ("torn_lines_by_batch", "post_schema_drift")
BATCH = [name for name in REPORTS if not name.startswith(("stream_", "landed_", "record_", *TOLD))]


def plan(df, mode="formatted"):
    text = io.StringIO()
    with redirect_stdout(text):
        df.explain(mode)
    return text.getvalue()


def tree(df):
    return plan(df).split("\n\n\n")[0]


@pytest.mark.parametrize("name", BATCH)
def test_no_report_needs_python_cross_joins_or_one_task_windows(spark, name):
    text = plan(REPORTS[name](spark, SF))
    for bad in ("NestedLoopJoin", "CartesianProduct", "Python", "Pandas", "WindowExec", "Window [", "Window ("):
        assert bad not in text


@pytest.mark.parametrize("name,scans", [("hourly_geo", 1), ("positive_hourly", 1), ("top_hours", 1),
                                        ("by_location", 1), ("share_by_region", 1), ("hourly_geo_join", 2)])
def test_events_are_scanned_once(spark, name, scans):
    text = plan(REPORTS[name](spark, SF))
    assert len(re.findall(r"Location: .*events\.parquet", text)) == scans


def test_scans_read_only_what_is_used(spark):
    text = plan(REPORTS["device_share"](spark, SF))
    assert "ReadSchema: struct<event_type:string,props:string>" in text
    assert "documents.parquet" not in text and "customer.parquet" not in text


def test_top_hours_are_ranked_without_a_full_sort(spark):
    text = tree(REPORTS["top_hours"](spark, SF))
    assert "TakeOrderedAndProject" in text and "rangepartitioning" not in text


def test_the_total_of_a_share_reuses_the_counts(spark):
    df = REPORTS["device_share"](spark, SF)
    df.collect()
    assert "ReusedExchange" in plan(df)


def test_the_hour_is_worked_out_once(spark):
    text = plan(REPORTS["hourly_geo"](spark, SF), "simple")
    assert text.count("unix_seconds") == 1


def test_generated_code_covers_the_counting(spark):
    df = REPORTS["hourly_geo"](spark, SF)
    df.collect()
    final = plan(df, "simple").split("== Initial Plan ==")[0]
    assert re.search(r"\*\(\d+\) HashAggregate\(keys=\[Time_In_EST", final)


def test_the_spread_join_reads_and_shuffles_each_side_once_beside_its_sketch(spark, tmp_path):
    """Twice in all: once for the sketch, which reads keys alone, and once for the join."""
    for name in ("left", "right"):
        spark.range(3000).select(F.when(F.col("id") < 900, "hot").otherwise(F.concat(F.lit("k"), "id")).alias("k"), F.col("id").alias(name),
                                 F.lit("long text").alias(f"{name}_text")).write.parquet(str(tmp_path / name))
    l, r = (spark.read.parquet(str(tmp_path / name)) for name in ("left", "right"))
    sketch = plan(joining._heavy(l, r, "k", 10_000, 1 << 20))
    assert len(re.findall(r"Location: .*/left", sketch)) == len(re.findall(r"Location: .*/right", sketch)) == 1
    assert set(re.findall("ReadSchema: (.*)", sketch)) == {"struct<k:string>"}
    joined = joining.spread_join(l, r, "k", F.col("left"), F.col("right"), cell_pairs=10_000, partitions=16)
    assert joined.count() == 900 * 900 + 2100
    text = plan(joined)
    assert len(re.findall(r"Location: .*/left", text)) == len(re.findall(r"Location: .*/right", text)) == 1
    assert text.count("REPARTITION_BY_NUM") == 2 and "SortMergeJoin" in text and "ENSURE_REQUIREMENTS" not in tree(joined).split("Initial Plan")[0]


def test_without_heavy_keys_the_join_is_the_plain_one(spark):
    text = plan(REPORTS["place_vs_profile_rows"](spark, SF), "simple")
    assert "_counter" not in text and not re.search(r"hashpartitioning\(.*REPARTITION_BY_NUM", text)


def test_texts_are_digested_before_the_spread_join(spark):
    """Only the digest of a text is kept; the text itself must not be copied into the cells of its author."""
    text = plan(REPORTS["place_vs_profile_spread"](spark, SF), "simple")
    physical = text.split("== Physical Plan ==")[-1]
    assert re.search(r"Join", physical) and physical.index("md5(") > re.search(r"Join", physical).start()


def test_long_texts_join_the_posts_last(spark):
    """With a customer table too large to broadcast, the author join must not shuffle rows that carry their texts."""
    from placewise.sources import tables
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        physical = plan(tables.posts(spark, SF, "text", "author", "place"), "simple").split("== Physical Plan ==")[-1]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    joins = [line for line in physical.splitlines() if "Join " in line]
    assert "doc_id" in joins[0]
