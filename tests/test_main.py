import json

import pytest

from placewise.__main__ import main
from placewise.jobs import JOBS
from placewise.sources.posts import read_gender_records, read_posts, torn_lines
from placewise.streaming.sinks import landed_batches, latest


@pytest.fixture(scope="module")
def extra(tmp_path_factory):
    folder = tmp_path_factory.mktemp("extra")
    for name, rows in (("lookup", [{"username": "nell", "gender": "female", "probability": 98}]),
                       ("regions", [{"location": "Rivertown", "attribute": "x"}])):
        (folder / name).mkdir()
        (folder / name / "rows.json").write_text("\n".join(map(json.dumps, rows)))
    return {name: str(folder / name) for name in ("lookup", "regions")}


@pytest.fixture(scope="module")
def records_dir(tmp_path_factory):
    folder = tmp_path_factory.mktemp("records")
    rows = [{"q": q, "gender": g} for q, g in (("nell", "female"), ("omar", "male"), ("zz", "null"), ("nell", "female"))]
    (folder / "rows.json").write_text("\n".join(map(json.dumps, rows)))
    return str(folder)


def inputs(spark, job, traps_dir, records_dir, extra):
    more = {"profiles": lambda: read_posts(spark, traps_dir), "lookup": lambda: spark.read.json(extra["lookup"]),
            "regions": lambda: spark.read.json(extra["regions"])}
    first = read_posts(spark, traps_dir) if job.reads == "posts" else read_gender_records(spark, records_dir)
    return first, *(more[need]() for need in job.needs)


def call(name, traps_dir, records_dir, extra, *more):
    folder = traps_dir if JOBS[name].reads == "posts" else records_dir
    return [name, "--posts", folder, "--lookup", extra["lookup"], "--regions", extra["regions"], *more]


def rows(df):
    return sorted(map(repr, df.collect()))


@pytest.mark.parametrize("name", JOBS)
def test_narrow_scan_gives_the_report_of_the_full_one(spark, traps_dir, records_dir, extra, tmp_path, name):
    out = str(tmp_path / "out")
    main(call(name, traps_dir, records_dir, extra, "--out", out), spark)
    want = JOBS[name].batch(*inputs(spark, JOBS[name], traps_dir, records_dir, extra))
    got = spark.read.parquet(out)
    assert got.columns == want.columns and want.count() > 0 and rows(got) == rows(want)


@pytest.mark.parametrize("name", [n for n in JOBS if JOBS[n].live])
def test_live_form_ends_like_the_batch(spark, traps_dir, records_dir, extra, tmp_path, name):
    job, out = JOBS[name], str(tmp_path / "out")
    main(call(name, traps_dir, records_dir, extra, "--live", "--out", out, "--checkpoint", str(tmp_path / "cp")), spark)
    want = job.live(*inputs(spark, job, traps_dir, records_dir, extra))
    got = spark.read.schema(want.schema).format(job.appends).load(out) if job.appends else latest(spark, out, want.schema)
    assert rows(job.ordered(got)) == rows(job.ordered(want))
    assert job.appends or not job.rank or [r[job.rank[0]] for r in job.ordered(got).collect()] == [r[job.rank[0]] for r in job.ordered(want).collect()]


@pytest.mark.parametrize("name,option,argument", [("by_location", "--each-user", "each_user"), ("top_handles", "--every-handle", "every"),
                                                  ("positive_hourly", "--ignore-case", "ignore_case"), ("positive_hourly", "--whole-word", "whole_word"),
                                                  ("place_vs_profile", "--strict", "strict"), ("place_vs_profile_counts", "--strict", "strict")])
def test_options_reach_the_report(spark, traps_dir, records_dir, extra, tmp_path, name, option, argument):
    out = str(tmp_path / "out")
    main(call(name, traps_dir, records_dir, extra, "--out", out, option), spark)
    want = JOBS[name].batch(*inputs(spark, JOBS[name], traps_dir, records_dir, extra), **{argument: True})
    assert rows(spark.read.schema(want.schema).parquet(out)) == rows(want)


def test_the_zone_of_the_session(spark, traps_dir, tmp_path):
    out = str(tmp_path / "out")
    main(["hourly_geo", "--posts", traps_dir, "--tz", "session", "--out", out], spark)
    assert rows(spark.read.parquet(out)) == rows(JOBS["hourly_geo"].batch(read_posts(spark, traps_dir), tz=None))


@pytest.mark.parametrize("name", ["device_share", "by_location", "top_handles"])
def test_live_windows(spark, traps_dir, records_dir, extra, tmp_path, name):
    out = str(tmp_path / "out")
    main(call(name, traps_dir, records_dir, extra, "--live", "--window", "1 hour", "--watermark", "1 hour", "--out", out, "--checkpoint", str(tmp_path / "cp")), spark)
    got = spark.read.parquet(out)
    assert got.columns[0] == "window" and got.columns[-1] == "count" and got.agg({"count": "sum"}).first()[0] == 10


def test_live_tops_of_windows(spark, traps_dir, records_dir, extra, tmp_path):
    out = str(tmp_path / "out")
    main(call("device_share", traps_dir, records_dir, extra, "--live", "--window", "1 hour", "--top", "1", "--out", out, "--checkpoint", str(tmp_path / "cp")), spark)
    assert [(r["rank"], r["value"], r["count"], r["posts"]) for r in spark.read.parquet(out).collect()] == [(1, "web", 9, 10)]


def test_live_genders_with_a_fresh_lookup(spark, traps_dir, records_dir, extra, tmp_path, capsys):
    out = str(tmp_path / "out")
    main(call("enriched_genders", traps_dir, records_dir, extra, "--live", "--fresh", "--torn", "--out", out, "--checkpoint", str(tmp_path / "cp")), spark)
    want = JOBS["enriched_genders"].batch(*inputs(spark, JOBS["enriched_genders"], traps_dir, records_dir, extra))
    assert rows(landed_batches(spark, out, want.schema).drop("batch")) == rows(want)
    assert "batch 0: 1 of 13 lines are no posts" in capsys.readouterr().out


def test_feeds_to_the_console_are_appended(spark, traps_dir):
    main(["text_feed", "--posts", traps_dir, "--live"], spark)


def test_torn_lines_are_told(spark, traps_dir, capsys):
    main(["text_feed", "--posts", traps_dir, "--torn"], spark)
    assert f"{torn_lines(spark, traps_dir).count()} of 13 lines read are no posts" in capsys.readouterr().out


def test_live_to_the_console_is_ranked(spark, traps_dir, records_dir, extra, capfd):
    main(call("by_location", traps_dir, records_dir, extra, "--live", "--max-files", "1"), spark)


def test_printing(spark, traps_dir, capsys):
    main(["hourly_geo", "--posts", traps_dir, "--tz", "America/New_York", "--schema"], spark)
    out = capsys.readouterr().out
    assert "Time_In_EST" in out and "created_at: string" in out and "text" not in out


@pytest.mark.parametrize("argv", [["nothing", "--posts", "x"], ["gender_share", "--posts", "x"],
                                  ["top_hours", "--posts", "x", "--live"], ["device_share", "--posts", "x", "--strict"], ["by_location", "--posts", "x", "--window", "1 day"],
                                  ["by_location", "--posts", "x", "--live", "--top", "3"], ["device_share", "--posts", "x", "--fresh"],
                                   ["device_share", "--posts", "x", "--live", "--out", "y"]])
def test_wrong_calls_are_refused(spark, argv):
    with pytest.raises(SystemExit):
        main(argv, spark)


def test_drift_is_printed(spark, traps_dir, capsys):
    main(["text_feed", "--posts", traps_dir, "--drift"], spark)
    assert "drift" in capsys.readouterr().out
