import gzip

import pytest
from pyspark.errors import IllegalArgumentException
from pyspark.sql import types as T

from conftest import TRAPS, post, write_lines
from placewise.checks.reports import REPORTS
from placewise.plans import feeds
from placewise.sources import landing, tables
from placewise.sources.posts import infer_schema, read_gender_records, read_posts, stream_posts, torn_lines
from placewise.sources.schemas import POST, post_schema


def test_blank_and_torn_lines_are_no_posts(traps):
    assert traps.count() == len(TRAPS)
    assert sorted(r.id for r in traps.select("data.id").collect()) == sorted(p["data"]["id"] for p in TRAPS)


def test_torn_lines_are_dropped_by_every_narrow_schema(spark, traps_dir):
    assert read_posts(spark, traps_dir, "data.source").count() == len(TRAPS)
    assert read_posts(spark, traps_dir, "includes.places").count() == len(TRAPS)
    assert read_posts(spark, traps_dir, "includes.places").filter("includes.places is null").count() == 7


def test_narrow_schema_keeps_only_what_is_asked_for():
    assert post_schema() == POST
    narrow = post_schema("data.source", "includes.users.location")
    assert narrow["data"].dataType.names == ["id", "source"]
    assert narrow["includes"].dataType.names == ["users"]
    assert narrow["includes"].dataType["users"].dataType.elementType.names == ["location"]
    assert post_schema("includes.places")["includes"].dataType["places"].dataType == POST["includes"].dataType["places"].dataType
    with pytest.raises(ValueError):
        post_schema("data.nothing")


def test_declared_schema_needs_no_placed_sample(spark, tmp_path):
    path = write_lines(tmp_path / "bare", [post("1")])
    assert "includes" not in infer_schema(spark, path).names
    assert feeds.place_text(read_posts(spark, path)).count() == 0


def test_streams_refuse_to_infer(spark, traps_dir):
    with pytest.raises(IllegalArgumentException):
        spark.readStream.json(traps_dir)
    assert stream_posts(spark, traps_dir).isStreaming


def test_several_directories_and_formats(spark, traps, traps_dir, tmp_path):
    other = write_lines(tmp_path / "more", [post("20"), post("21")])
    assert read_posts(spark, [traps_dir, other]).count() == len(TRAPS) + 2
    landing.land_posts(traps, str(tmp_path / "pq"), format="parquet")
    back = read_posts(spark, str(tmp_path / "pq"), "data.source", "includes.places", format="parquet")
    assert back.count() == len(TRAPS)


def test_gender_records(spark, tmp_path):
    (tmp_path / "g.json").write_text(
        '{"q":"nell","name":"nell","gender":"female","probability":98,"total_names":12,"status":true,"userInfo":{"location":"x"}}\n'
        '{"q":"zz","name":"zz","gender":"null","probability":0,"total_names":0,"status":true}\n')
    rows = read_gender_records(spark, str(tmp_path)).orderBy("q").collect()
    assert [r.gender for r in rows] == ["female", "null"] and rows[0].probability == 98 and rows[0].status is True


def test_landing_bounds_rows_per_file_and_reads_back(spark, tmp_path):
    df = spark.range(2500).selectExpr("named_struct('id', cast(id as string), 'text', 'é\\n' || id) AS data").coalesce(1)
    out = tmp_path / "landed"
    landing.land_posts(df, str(out))
    sizes = sorted(len(f.read_text(encoding="utf-8").splitlines()) for f in out.glob("*.json"))
    assert sizes == [500, 1000, 1000]
    back = read_posts(spark, str(out)).select("data.id", "data.text")
    assert back.exceptAll(df.select("data.id", "data.text")).count() == 0 and back.count() == 2500


def test_landing_raw_lines_and_partitions(spark, traps, traps_dir, tmp_path):
    lines = spark.read.text(traps_dir)
    landing.land_posts(lines, str(tmp_path / "raw"), rows_per_file=3, format="text")
    assert read_posts(spark, str(tmp_path / "raw")).count() == len(TRAPS)
    dated = traps.selectExpr("*", "left(data.created_at, 10) AS day")
    landing.land_posts(dated, str(tmp_path / "days"), partition_by=("day",))
    assert (tmp_path / "days" / "day=2024-01-15").is_dir()
    assert read_posts(spark, str(tmp_path / "days")).count() == len(TRAPS)


def test_landing_a_stream(spark, traps_dir, tmp_path):
    query = landing.land_stream(stream_posts(spark, traps_dir), str(tmp_path / "out"), str(tmp_path / "cp"), rows_per_file=5)
    query.awaitTermination(120)
    files = list((tmp_path / "out").glob("*.json"))
    assert max(len(f.read_text().splitlines()) for f in files) == 5
    assert read_posts(spark, str(tmp_path / "out")).count() == len(TRAPS)


def words(spark, seed):
    """Posts of invented words that don't repeat as a whole."""
    return spark.range(2000).repartition(1).selectExpr(
        f"named_struct('id', cast(id as string), 'text', concat_ws(' ', transform(sequence(1, 60), i -> hex(xxhash64(id, i, {seed}) % 3000)))) AS data")


def landed_bytes(out):
    """Bytes of the compressed files, and those of their lines at the default level."""
    files = list(out.glob("*.json.gz"))
    assert files and not list(out.glob("*.json"))
    return sum(f.stat().st_size for f in files), sum(len(gzip.compress(gzip.decompress(f.read_bytes()), 6)) for f in files)


def test_a_stream_lands_compressed_files_of_bounded_rows(spark, tmp_path):
    level = spark.conf.get("zlib.compress.level", None)
    words(spark, 1).write.parquet(str(tmp_path / "in"))
    posts = stream_posts(spark, str(tmp_path / "in"), "data.text", format="parquet")
    landing.land_stream(posts, str(tmp_path / "out"), str(tmp_path / "cp"), rows_per_file=700, compression="gzip").awaitTermination(120)
    assert spark.conf.get("zlib.compress.level", None) == level
    assert sorted(len(gzip.decompress(f.read_bytes()).splitlines()) for f in (tmp_path / "out").glob("*.json.gz")) == [600, 700, 700]
    back = read_posts(spark, str(tmp_path / "out"), "data.text")
    assert back.count() == 2000 and back.select("data.*").exceptAll(words(spark, 1).select("data.*")).count() == 0
    fast, usual = landed_bytes(tmp_path / "out")
    assert fast > usual * 1.02


def test_compressed_landing_bounds_rows_per_file_and_reads_back(spark, tmp_path):
    landing.land_posts(words(spark, 2), str(tmp_path / "out"), rows_per_file=700, compression="gzip")
    assert sorted(len(gzip.decompress(f.read_bytes()).splitlines()) for f in (tmp_path / "out").glob("*.json.gz")) == [600, 700, 700]
    back = read_posts(spark, str(tmp_path / "out"), "data.text")
    assert back.count() == 2000 and back.select("data.*").exceptAll(words(spark, 2).select("data.*")).count() == 0
    fast, usual = landed_bytes(tmp_path / "out")
    assert fast > usual * 1.02


TEXTS = ["two\nlines \u2028 \"quoted\" \\ é \U0001f600", "", None]


@pytest.fixture(scope="module")
def small_tables(spark, tmp_path_factory):
    """Seven events over three documents; of two customers only one is known."""
    out = str(tmp_path_factory.mktemp("tables"))
    events = spark.range(7).selectExpr("id AS event_id", "timestamp_ntz'2024-01-15 10:00:00' + make_dt_interval(0, 0, 0, id) AS ts", "id % 2 AS user_id",
                                       "'click' AS event_type", "0.5D AS value", "concat('{\"k\":', id, '}') AS props")
    documents = spark.createDataFrame([(i, t, "en", "web", 1) for i, t in enumerate(TEXTS)], tables.SCHEMAS["documents"])
    customer = spark.createDataFrame([(1, "Ann", 3, 0.5, "BUILDING")], tables.SCHEMAS["customer"])
    nation = spark.createDataFrame([(0, "ALGERIA", 0), (3, "CANADA", 1), (6, "FRANCE", 3)], tables.SCHEMAS["nation"])
    for name, df in (("events", events), ("documents", documents), ("customer", customer), ("nation", nation)):
        df.coalesce(1).write.parquet(f"{out}/{name}.parquet")
    return out


def check_landed(spark, small_tables, name):
    """Every post comes back with its whole text, from compressed files alone."""
    text = [t if t is None or i % 4 else f"RT @user{i % 2} {t}" for i, t in ((i, TEXTS[i % 3]) for i in range(7))]
    place = {0: "ALGERIA", 3: "CANADA", 6: "FRANCE"}
    want = [(str(i), str(i % 2), f"2024-01-15T10:00:0{i}.000000Z", "click", text[i], place.get(i), *(("Ann", "CANADA") if i % 2 else (None, None))) for i in range(7)]
    got = REPORTS[name](spark, small_tables)
    assert sorted(map(tuple, got.collect()), key=lambda r: r[0]) == want
    assert got.inputFiles() and all(f.endswith(".json.gz") for f in got.inputFiles())


def test_streamed_posts_stay_whole_in_compressed_files(spark, small_tables):
    check_landed(spark, small_tables, "stream_landed_posts")


def test_landed_posts_stay_whole_in_compressed_files(spark, small_tables):
    check_landed(spark, small_tables, "landed_posts")


def test_ids_and_times_are_strings():
    assert {f.dataType for f in POST["data"].dataType} == {T.StringType()}


def test_the_scan_counts_torn_lines_itself(spark, traps_dir):
    from pyspark.sql import Observation
    from placewise.sources.posts import LINES, NO_POSTS
    observed = Observation("seen")
    assert read_posts(spark, traps_dir, "data.text", observed=observed).count() == 12
    assert (observed.get[LINES], observed.get[NO_POSTS]) == (13, 1) and torn_lines(spark, traps_dir).count() == 1


def test_drift_of_the_schema_is_told_by_path(spark, tmp_path):
    from placewise.sources.drift import schema_drift
    lines = ['{"data":{"id":1,"text":"a","lang":"en"},"includes":{"places":[{"full_name":"P","id":"p","geo":{"lat":1.5}}]}}', '{"data":{"id":2,"text":"cut',
             '{"data":{"author_id":"a","created_at":"x","source":"s"},"meta":true}', '{"late":1}']
    (tmp_path / "part.json").write_text("\n".join(lines))
    got = {r["path"]: (r["declared"], r["found"], r["drift"]) for r in schema_drift(spark, str(tmp_path), lines=3).collect()}
    users = {f"includes.users[].{f}": ("string", None, "missing") for f in ("id", "name", "username", "location")}
    assert got == users | {"data.id": ("string", "bigint", "retyped"), "data.lang": (None, "string", "unknown"), "meta": (None, "boolean", "unknown"),
                           "includes.places[].geo.lat": (None, "double", "unknown")}
    assert schema_drift(spark, str(tmp_path), lines=4).where("path = 'late'").count() == 1


def test_files_as_declared_do_not_drift(spark, traps_dir):
    from placewise.sources.drift import schema_drift
    assert {r["path"] for r in schema_drift(spark, traps_dir).collect()} == set()
